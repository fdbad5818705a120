"""Column scalers and transforms fitted by one aggregation pass.

A fit over many columns is a single ``agg`` (one job, one scan); the fitted
state is a handful of literals per column, applied by ``transform`` as plain
expressions (no join, works on streams too).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class ScalerModel:
    kind: str
    stats: dict            # column -> dict of literals

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = {}
        for c, s in self.stats.items():
            x = F.col(c).cast("double")
            if self.kind == "minmax":
                if s["max"] is None:
                    out[c + suffix] = F.lit(None).cast("double")
                else:
                    rng = s["max"] - s["min"]
                    out[c + suffix] = (x - s["min"]) / rng if rng else x * 0.0
            elif self.kind == "maxabs":
                out[c + suffix] = x / s["maxabs"] if s["maxabs"] else x
            elif self.kind == "standard":
                sd = s["std"] if s["std"] else 1.0
                out[c + suffix] = (x - s["mean"]) / sd
            elif self.kind == "l2":
                out[c + suffix] = x / s["norm"] if s["norm"] else x
        return df.withColumns(out)


class Scaler:
    """``Scaler("minmax" | "maxabs" | "standard" | "l2", cols).fit(df)``.

    standard uses the population std (ddof 0) and divides by 1 when it is 0;
    min-max maps a constant column to 0.
    """

    def __init__(self, kind: str, cols: Sequence[str]):
        if kind not in ("minmax", "maxabs", "standard", "l2"):
            raise ValueError(kind)
        self.kind, self.cols = kind, list(cols)

    def fit(self, df: DataFrame) -> ScalerModel:
        aggs = []
        for c in self.cols:
            x = F.col(c).cast("double")
            aggs += {
                "minmax": [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")],
                "maxabs": [F.max(F.abs(x)).alias(f"{c}__maxabs")],
                "standard": [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")],
                "l2": [F.sqrt(F.sum(x * x)).alias(f"{c}__norm")],
            }[self.kind]
        row = df.agg(*aggs).first().asDict()   # one row of fitted literals
        stats = {c: {k.split("__")[1]: v for k, v in row.items() if k.startswith(c + "__")} for c in self.cols}
        return ScalerModel(self.kind, stats)


def fit_transform(df: DataFrame, kind: str, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Fit on ``df`` and scale it. (A window over the whole frame would
    gather it into one task; fitted literals keep the work distributed.)"""
    return Scaler(kind, cols).fit(df).transform(df, suffix)


# ---- A10: Box-Cox with the likelihood-maximising lambda ---------------------------
def boxcox_llf_grid(df: DataFrame, col: str, lambdas: Sequence[float]) -> DataFrame:
    """Profile log-likelihood of Box-Cox for every lambda in one pass:
    llf(l) = (l - 1) * sum(ln x) - n/2 * ln(var_pop(y_l))."""
    x = F.col(col).cast("double")
    pos = df.select(x.alias("x")).filter(F.col("x") > 0)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.log("x")).alias("slog")]
    for i, lam in enumerate(lambdas):
        y = F.log("x") if lam == 0 else (F.pow("x", F.lit(lam)) - 1) / lam
        aggs.append(F.var_pop(y).alias(f"v{i}"))
    row = pos.agg(*aggs)
    parts = [F.struct(F.lit(float(lam)).alias("lmbda"),
                      ((F.lit(lam) - 1) * F.col("slog") - F.col("n") / 2 * F.log(F.col(f"v{i}"))).alias("llf"))
             for i, lam in enumerate(lambdas)]
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.lmbda", "p.llf")


def boxcox_fit_lambda(df: DataFrame, col: str, lo: float = -2.0, hi: float = 2.0,
                      grid: int = 41, rounds: int = 3) -> float:
    """Maximum-likelihood lambda: a grid per pass, then refine around the
    best point (each pass is one aggregation; only the grid returns)."""
    for _ in range(rounds):
        step = (hi - lo) / (grid - 1)
        lams = [lo + i * step for i in range(grid)]
        best = boxcox_llf_grid(df, col, lams).orderBy(F.col("llf").desc_nulls_last()).first()
        lo, hi = best["lmbda"] - step, best["lmbda"] + step
    return float(best["lmbda"])

