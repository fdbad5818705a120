"""Registered queries: name -> Spark builder, plus the DuckDB oracle SQL.

Every query reads the driver's tables (``sf_dir``) in full. Computed
columns carry the same alias in Spark and in SQL; doubles are rounded to 6
places on both sides so floating summation order cannot flip a hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Decorator registering a Spark builder and (optionally) its oracle."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def md5_mod_sql(expr: str, m: int) -> str:
    """DuckDB SQL for ``featlab.functions.hashing.md5_mod``: the md5 digest
    folded 32 bits at a time, ``acc = (acc * 2^32 + chunk) % m``."""
    acc = "0"
    for i in range(4):
        acc = f"(({acc}) * 4294967296 + ('0x' || substr(md5({expr}), {8 * i + 1}, 8))::BIGINT) % {m}"
    return acc


def load_all() -> None:
    # importing the modules fills the registry
    from featlab.plans import tabular, text, vectors, ordered, metrics_q, misc, models_q, calls, boost_q, sampled, filled  # noqa: F401
