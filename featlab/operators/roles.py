"""Column roles resolved from the schema only (P12, P13, data model §1).

The reference decides id / label / numeric / ignored / categorical columns
by name at run time; here a ``ColumnRoles`` value does it once from
``df.schema`` (no data is read) and drives ``select`` / ``drop``, so
Catalyst prunes the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass
class ColumnRoles:
    id_col: str | None = None
    label: str | None = None
    ignore: Sequence[str] = field(default_factory=tuple)
    numeric: Sequence[str] | None = None        # None: every numeric-typed column
    discrete_prefix: str = "ls_"                 # naming convention for discrete columns

    def features(self, df: DataFrame) -> list[str]:
        """Every column except id, label and the ignore list."""
        drop = {c for c in (self.id_col, self.label) if c} | set(self.ignore)
        missing = [c for c in drop if c not in df.columns]
        if missing:
            raise ValueError(f"unknown columns: {missing}")
        return [c for c in df.columns if c not in drop]

    def numeric_features(self, df: DataFrame, allow_discrete: bool = False) -> list[str]:
        """Numeric features; P13: ``ls_``-prefixed (discrete) columns are
        skipped unless ``allow_discrete``."""
        types = {f.name: f.dataType for f in df.schema.fields}
        cols = self.features(df)
        if self.numeric is not None:
            cols = [c for c in cols if c in set(self.numeric)]
        else:
            cols = [c for c in cols if isinstance(types[c], _NUMERIC)]
        if not allow_discrete:
            cols = [c for c in cols if not c.startswith(self.discrete_prefix)]
        return cols

    def discrete_features(self, df: DataFrame) -> list[str]:
        return [c for c in self.features(df) if c.startswith(self.discrete_prefix)]

    def categorical_features(self, df: DataFrame) -> list[str]:
        """Everything that is not numeric (the FM dictionary's categorical
        fields)."""
        num = set(self.numeric_features(df, allow_discrete=True))
        return [c for c in self.features(df) if c not in num]

    def select_features(self, df: DataFrame) -> DataFrame:
        """P12 as a projection: the scan reads only the kept columns."""
        keep = [c for c in (self.id_col, self.label) if c] + self.features(df)
        return df.select(*keep)
