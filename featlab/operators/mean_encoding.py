"""Out-of-fold mean (target) encoding, E11-E14.

For a row in fold ``f`` the encoding of category ``c`` uses only rows
outside ``f``:

    n   = rows of c outside f          mean  = avg(y) of c outside f
    b   = prior_weight(n)              prior = avg(y) outside f
    enc = b * prior + (1 - b) * mean   (prior when c has no y outside f)

Instead of k passes (one per fold), one aggregation gives sums per
(category, fold); totals per category minus the own fold give the
leave-fold-out statistics (``total - own``). The per-(category, fold)
table is an aggregate: its size follows the category cardinality, not the
row count, and AQE picks broadcast or shuffle for the join back at run time.
Only the k-row fold table is broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featlab.operators.folds import kfold, stratified_kfold

PriorWeight = Callable[[Column], Column]


def exp_decay_weight(k: float = 2.0, f: float = 1.0) -> PriorWeight:
    """Default prior weight b(n) = 1 / (1 + exp((n - k) / f))."""
    return lambda n: 1.0 / (1.0 + F.exp((n - F.lit(k)) / F.lit(f)))


def _weight(prior_weight) -> PriorWeight:
    if prior_weight is None:
        return exp_decay_weight()
    if isinstance(prior_weight, dict):
        return exp_decay_weight(prior_weight.get("k", 2.0), prior_weight.get("f", 1.0))
    if isinstance(prior_weight, tuple):
        return exp_decay_weight(*prior_weight)
    if callable(prior_weight):
        return prior_weight
    raise TypeError("prior_weight must be None, a dict(k=, f=), a (k, f) tuple or a callable")


@dataclass
class MeanEncoderModel:
    """Fitted state per output column: the averaged ``(value, enc)`` table
    and the k-row fold-prior table (its mean encodes unseen values)."""
    k: int
    tables: dict = field(default_factory=dict)   # out_col -> (cat_col, DataFrame[value, enc])
    priors: dict = field(default_factory=dict)   # out_col -> DataFrame[prior] with k rows

    def default(self, out_col: str) -> float:
        # k rows: a bounded collect of fitted state, done once on first use
        return sum(r[0] for r in self.priors[out_col].collect()) / self.k

    def transform(self, df: DataFrame) -> DataFrame:
        """Encode new rows with the k fold tables averaged."""
        out = df
        for out_col, (cat, table) in self.tables.items():
            v, e = f"_fl_v_{out_col}", f"_fl_e_{out_col}"
            t = table.select(F.col("value").alias(v), F.col("enc").alias(e))
            out = (out.join(t, out[cat] == t[v], "left")
                   .withColumn(out_col, F.coalesce(F.col(e), F.lit(self.default(out_col))))
                   .drop(v, e))
        return out


class MeanEncoder:
    """``MeanEncoder(["event_type"], "value", id_col="event_id").fit_transform(df)``.

    ``target_type="regression"`` gives ``<col>_pred``; ``"classification"``
    gives ``<col>_pred_<class>`` for every class and uses stratified folds.
    Folds are contiguous blocks of ``id_col`` order (plain or per class)
    unless ``fold_col`` names an existing fold column.
    """

    def __init__(self, categorical_features: Sequence[str], target_col: str, id_col: str,
                 n_splits: int = 5, target_type: str = "regression", prior_weight=None,
                 fold_col: str | None = None):
        self.cats = list(categorical_features)
        self.y = target_col
        self.id_col = id_col
        self.k = n_splits
        self.target_type = "classification" if target_type == "classification" else "regression"
        self.weight = _weight(prior_weight)
        self.fold_col = fold_col

    def _targets(self, df: DataFrame) -> list[tuple[str, Column]]:
        if self.target_type == "regression":
            return [("", F.col(self.y).cast("double"))]
        # one output column per class; ``classification_long`` needs no class list
        classes = [r[0] for r in df.select(self.y).distinct().collect()]
        classes = sorted(c for c in classes if c is not None)
        return [(f"_{c}", F.when(F.col(self.y).isNull(), None)
                 .otherwise((F.col(self.y) == F.lit(c)).cast("double"))) for c in classes]

    def classification_long(self, df: DataFrame, cat: str) -> DataFrame:
        """E12 for any number of classes: one row per (row, class),
        ``id, class, value``, with the numbers of the wide form. Classes are
        rows of a table everywhere; folds as in ``fit_transform``."""
        fold = self.fold_col or "fold"
        if self.fold_col is None:
            df = stratified_kfold(df, self.y, [self.id_col], self.k, fold)
        rows = df.select(F.col(self.id_col).alias("id"), F.col(cat).alias("cat"), F.col(fold).alias("fold"), F.col(self.y).alias("class"))
        per = rows.groupBy("cat", "fold", "class").agg(F.count(F.lit(1)).alias("n"))
        known = per.filter(F.col("class").isNotNull())

        def out_of_fold(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
            """Sum of ``n`` per keys over the other folds, for every (keys, fold)."""
            total = counts.groupBy(*keys).agg(F.sum("n").alias("_t")) if keys else counts.agg(F.sum("n").alias("_t"))
            own = counts.groupBy(*keys, "fold").agg(F.sum("n").alias("_o"))
            folds = F.explode(F.sequence(F.lit(0), F.lit(self.k - 1))).alias("fold")
            return total.select(*keys, "_t", folds).join(own, [*keys, "fold"], "left") \
                .select(*keys, "fold", (F.col("_t") - F.coalesce("_o", F.lit(0))).alias(name))
        prior = out_of_fold(known, ["class"], "c").join(out_of_fold(known, [], "a"), "fold").select("class", "fold", (F.col("c") / F.col("a")).alias("prior"))
        cats = per.filter(F.col("cat").isNotNull())
        size = out_of_fold(cats, ["cat"], "n_out").join(out_of_fold(cats.filter(F.col("class").isNotNull()), ["cat"], "n_known"), ["cat", "fold"], "left")
        hits = out_of_fold(cats.filter(F.col("class").isNotNull()), ["cat", "class"], "n_class")
        b = self.weight(F.col("n_out").cast("double"))
        mean = F.coalesce("n_class", F.lit(0)) / F.col("n_known")
        value = F.when(F.col("n_known") > 0, b * F.col("prior") + (1 - b) * mean).otherwise(F.col("prior"))
        return rows.drop("class").join(prior, "fold").join(size, ["cat", "fold"], "left").join(hits, ["cat", "class", "fold"], "left") \
            .select("id", "class", value.alias("value"))

    def fit_transform(self, df: DataFrame) -> tuple[DataFrame, MeanEncoderModel]:
        fold = self.fold_col or "fold"
        if self.fold_col is None:
            if self.target_type == "classification":
                df = stratified_kfold(df, self.y, [self.id_col], self.k, fold)
            else:
                df = kfold(df, [self.id_col], self.k, fold)
        targets = self._targets(df)
        model = MeanEncoderModel(self.k)
        t_cols = {f"_fl_t{i}": expr for i, (_, expr) in enumerate(targets)}
        base = df.withColumns(t_cols)

        # fold totals: k rows, the only explicit broadcast. They are summed
        # from the first column's (category, fold) aggregate, NULL category
        # included, so the rows are not scanned a third time.
        sums = [F.count(F.lit(1)).alias("_fl_n")]
        for tc in t_cols:
            sums += [F.sum(tc).alias(f"{tc}_s"), F.count(tc).alias(f"{tc}_c")]
        cf_all = {cat: base.groupBy(cat, fold).agg(*sums) for cat in self.cats}
        first = cf_all[self.cats[0]]
        folds = first.groupBy(fold).agg(*[F.sum(f"{tc}_{x}").alias(f"{tc}_{x}") for tc in t_cols for x in ("s", "c")])
        wall = Window.partitionBy()   # k rows
        for tc in t_cols:
            folds = folds.withColumn(
                f"{tc}_prior",
                (F.sum(f"{tc}_s").over(wall) - F.col(f"{tc}_s")) /
                (F.sum(f"{tc}_c").over(wall) - F.col(f"{tc}_c")))
        folds = folds.select(fold, *[f"{tc}_prior" for tc in t_cols])

        out = base
        for cat in self.cats:
            # partial aggregation happens map-side; the table is per (cat, fold)
            cf = cf_all[cat].filter(F.col(cat).isNotNull())
            wc = Window.partitionBy(cat)   # at most k rows per category
            stats = cf.withColumn("_fl_nout", F.sum("_fl_n").over(wc) - F.col("_fl_n"))
            for tc in t_cols:
                stats = (stats.withColumn(f"{tc}_sout", F.sum(f"{tc}_s").over(wc) - F.col(f"{tc}_s"))
                         .withColumn(f"{tc}_cout", F.sum(f"{tc}_c").over(wc) - F.col(f"{tc}_c")))
            stats = stats.join(F.broadcast(folds), fold)
            b = self.weight(F.col("_fl_nout").cast("double"))
            enc_cols = {}
            for tc, (suffix, _) in zip(t_cols, targets):
                name = f"{cat}_pred{suffix}"
                mean = F.col(f"{tc}_sout") / F.col(f"{tc}_cout")
                prior = F.col(f"{tc}_prior")
                enc_cols[name] = F.when(F.col(f"{tc}_cout") > 0, b * prior + (1 - b) * mean)
            stats = stats.select(cat, fold, *[e.alias(n) for n, e in enc_cols.items()],
                                 *[F.col(f"{tc}_prior") for tc in t_cols])
            keep = [c for c in out.columns]
            joined = out.join(stats.drop(*[f"{tc}_prior" for tc in t_cols]), [cat, fold], "left") \
                        .join(F.broadcast(folds), fold, "left")
            sel = [F.col(c) for c in keep]
            for tc, name in zip(t_cols, enc_cols):
                sel.append(F.coalesce(F.col(name), F.col(f"{tc}_prior")).alias(name))
            out = joined.select(*sel)

            # fitted tables for new data: every category against every fold
            # (k copies of the category table, not of the rows); a fold
            # whose training part lacks the category contributes its prior
            tot = cf.groupBy(cat).agg(F.sum("_fl_n").alias("_fl_nt"),
                                      *[F.sum(f"{tc}_{x}").alias(f"{tc}_{x}t")
                                        for tc in t_cols for x in ("s", "c")])
            grid = (tot.withColumn(fold, F.explode(F.sequence(F.lit(0), F.lit(self.k - 1))))
                    .join(F.broadcast(folds), fold)
                    .join(cf, [cat, fold], "left"))
            bt = self.weight((F.col("_fl_nt") - F.coalesce(F.col("_fl_n"), F.lit(0))).cast("double"))
            for tc, name in zip(t_cols, enc_cols):
                sout = F.col(f"{tc}_st") - F.coalesce(F.col(f"{tc}_s"), F.lit(0.0))
                cout = F.col(f"{tc}_ct") - F.coalesce(F.col(f"{tc}_c"), F.lit(0))
                prior = F.col(f"{tc}_prior")
                enc = F.when(cout > 0, bt * prior + (1 - bt) * (sout / cout)).otherwise(prior)
                table = grid.groupBy(cat).agg((F.sum(enc) / self.k).alias("enc")) \
                            .withColumnRenamed(cat, "value")
                model.tables[name] = (cat, table)
                model.priors[name] = folds.select(F.col(f"{tc}_prior"))
        return out.drop(*t_cols), model
