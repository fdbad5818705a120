"""Operator 1, mixing sources to target weights: hierarchical budgets, seeded epochs, token prefixes.

Leaves are (domain, lang, source). The token budget goes down the tree level by
level: among siblings it is shared in proportion to their weights, but nobody
gets more than the tokens below it times ``max_epochs``. What a short child
cannot take goes to its siblings by weight; only when all of them are full is
the parent itself short, and then *its* siblings take over on the level above.
Per level this is one sort of the siblings by capacity per weight and two
running sums (water filling), in exact integer arithmetic.

Every leaf repeats its documents in epochs, each in its own seeded order, and
the budget takes a prefix of that token stream; the document in which the
prefix ends is used in part (``n_used < n_tokens``). The running token sum has
no window over a leaf: documents are dealt to buckets by the leading digits of
their hash (about ``bucket_rows`` each, however large the leaf), the bucket
sums are accumulated, and only rows of one bucket are sorted together.

Defined results: NULL text has no tokens and is never used; NULL lang or
source is the value ''; NULL ids are ordered as ''; rows with the same hash are
ordered by id and tokens; repeated rows are documents of their own; an empty
table or a zero budget gives no rows; other columns are not touched.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featlab.llm.shared import WORD, sized, text_or_empty, without, written

LEVELS = ("domain", "lang", "source")
EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """``budget_permille`` of all tokens, dealt by the integer ``weights``
    (path joined by '/', 1 where not listed)."""
    weights: dict[str, int] = field(default_factory=dict)
    budget_permille: int = 800
    max_epochs: int = 3
    seed: str = "mix-1"
    bucket_rows: int = 1000


WEIGHTS = {
    "odd": 2, "even": 3,
    "odd/en": 4, "odd/de": 2, "odd/fr": 2, "odd/es": 2,
    "even/en": 3, "even/de": 1, "even/fr": 1, "even/es": 2,
    "even/en/src0": 6, "even/de/src0": 5, "even/fr/src0": 5, "even/es/src0": 4, "odd/en/src1": 2}
#: Production mixture of the query: two source families, more weight on the
#: smaller languages, one large source turned down, up to three epochs.
PRODUCTION = Mix(weights=WEIGHTS)
#: In the pipeline every document is used at most once.
ONCE = Mix(weights=WEIGHTS, budget_permille=900, max_epochs=1)


def domain_of(source: Column) -> Column:
    """Domain of a source in the test tables: parity of its trailing number."""
    digit = F.regexp_extract(source, "([0-9])$", 1)
    return F.when(digit.isin("1", "3", "5", "7", "9"), "odd").otherwise("even")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _weight(depth: int, mix: Mix) -> Column:
    listed = {k: w for k, w in mix.weights.items() if k.count("/") == depth}
    path = F.concat_ws("/", *LEVELS[: depth + 1])
    if not listed:
        return F.lit(1).cast(EXACT)
    table = F.create_map(*[F.lit(x) for kv in listed.items() for x in kv])
    return F.coalesce(table[path], F.lit(1)).cast(EXACT)


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens, docs) plus ``budget``, by water filling from the root."""
    nodes = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    total = nodes.agg(F.expr(f"cast(coalesce(sum(tokens), 0) * {mix.budget_permille} div 1000 as {EXACT})").alias("given"))
    above: list[str] = []
    budgets = total.withColumn("_root", F.lit(1))
    for depth, level in enumerate(LEVELS):
        parent = Window.partitionBy(*(above or ["_root"]))
        key = above or ["_root"]
        own = nodes.withColumn("_root", F.lit(1)).groupBy(*key, level).agg(F.sum("cap").cast(EXACT).alias("cap")) \
            .withColumn("w", _weight(depth, mix)).filter("w > 0").join(F.broadcast(budgets) if depth == 0 else budgets, key)
        order = parent.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), level)
        before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(EXACT)
        rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(EXACT)
        own = own.withColumn("rest", rest).withColumn("left", F.greatest(F.col("given") - before, F.lit(0).cast(EXACT)))
        # full: the share by weight of what is left reaches the capacity
        own = own.withColumn("full", F.col("cap") * F.col("rest") <= F.col("w") * F.col("left"))
        # the first that is not full fixes the level that all later siblings share
        own = own.withColumn("share", F.max(F.when(~F.col("full"), F.struct("rest", "left"))).over(parent))
        upto = F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("w"))).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast(EXACT)
        own = own.withColumn("upto", upto)
        part = lambda w: F.expr(f"({w}) * share.left div share.rest").cast(EXACT)
        given = F.when(F.col("full"), F.col("cap")).otherwise(part("upto") - part("upto - w"))
        above = [*above, level]
        budgets = own.select(*above, given.cast(EXACT).alias("given"))
    return nodes.join(budgets, above).select(*LEVELS, "tokens", "docs", F.col("given").cast("long").alias("budget"))


def select_prefixes(items: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``items`` (doc_id, domain, lang, source, n_tokens) to the selected
    (document, epoch) rows with ``position`` (tokens of the leaf's stream
    before it) and ``n_used`` (tokens of it inside the prefix)."""
    items = written(items.filter("n_tokens > 0"), "mix-items")  # the texts are read once
    leaves = items.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    budgets = written(leaf_budgets(leaves, mix).filter("budget > 0"), "mix-budgets")
    # epochs that the budget reaches; all but the last are used whole
    rows = items.join(sized(budgets), list(LEVELS)) \
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.expr("cast((budget - 1) div tokens as int)"))))
    name = F.concat_ws(":", F.lit(mix.seed), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("h", F.md5(name))
    buckets = F.greatest(F.lit(1), F.expr(f"docs div {mix.bucket_rows}"))
    # order-keeping: the leading 48 bits of the hash scaled to 0 .. buckets - 1
    rows = rows.withColumn("bucket", F.floor(F.conv(F.substring("h", 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48)) * buckets).cast("long"))
    key = [*LEVELS, "epoch"]
    sums = rows.groupBy(*key, "bucket").agg(F.sum("n_tokens").alias("s"))
    running = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*key, "bucket", F.coalesce(F.sum("s").over(running), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*key, "bucket").orderBy("h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(bases, [*key, "bucket"]).withColumn(
        "position", F.col("epoch") * F.col("tokens") + F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.filter("position < budget").select(
        "doc_id", *LEVELS, "epoch", "position", "n_tokens", F.least("n_tokens", F.col("budget") - F.col("position")).alias("n_used"))


def items_of(docs: DataFrame) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens) of a documents table; tokens are words."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select("doc_id", domain_of(source).alias("domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       source.alias("source"), word_count(text_or_empty()).alias("n_tokens"))


def drop_unmixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` without the documents that the mixture does not reach (those
    without tokens among them). A document that ends a prefix stays whole; rows
    without an id cannot be named and stay."""
    items = items_of(docs)
    chosen = select_prefixes(items, mix).select("doc_id").distinct()
    left_out = docs.select("doc_id").filter("doc_id is not null").distinct().join(chosen, "doc_id", "left_anti")
    return without(docs, "doc_id", left_out, "mix-dropped")


def _weights_sql(depth: int, mix: Mix) -> str:
    path = " || '/' || ".join(LEVELS[: depth + 1])
    cases = " ".join(f"WHEN '{k}' THEN {w}" for k, w in mix.weights.items() if k.count("/") == depth)
    return f"CAST((CASE {path} {cases} ELSE 1 END) AS HUGEINT)" if cases else "CAST(1 AS HUGEINT)"


def oracle_sql(mix: Mix = PRODUCTION, items: str | None = None) -> str:
    """The same selection as DuckDB SQL, over ``documents``."""
    items = items or r"""
    SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9])$', 1) IN ('1','3','5','7','9') THEN 'odd' ELSE 'even' END AS domain,
      coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
    FROM documents"""
    ctes = [f"items AS (SELECT * FROM ({items}) WHERE n_tokens > 0)",
            f"leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {mix.max_epochs} AS cap FROM items GROUP BY ALL)",
            f"b_ AS (SELECT 1 AS root, sum(tokens) * {mix.budget_permille} // 1000 AS given FROM leaves)"]
    key = ["root"]
    for depth, level in enumerate(LEVELS):
        k, prev = ", ".join(key), f"b_{LEVELS[depth - 1] if depth else ''}"
        ctes += [
            f"n_{level} AS (SELECT {k}, {level}, sum(cap) AS cap, {_weights_sql(depth, mix)} AS w FROM (SELECT 1 AS root, * FROM leaves) GROUP BY {k}, domain, {', '.join([*LEVELS[:depth + 1]])})",
            f"o_{level} AS (SELECT *, sum(w) OVER (p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, "
            f"greatest(given - coalesce(sum(cap) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS rem "
            f"FROM n_{level} JOIN {prev} USING ({k}) WHERE w > 0 WINDOW p AS (PARTITION BY {k} ORDER BY cap::DOUBLE / w::DOUBLE, {level}))",
            f"f_{level} AS (SELECT *, cap * rest <= w * rem AS is_full FROM o_{level})",
            f"s_{level} AS (SELECT *, max(CASE WHEN NOT is_full THEN rest END) OVER (PARTITION BY {k}) AS r, "
            f"sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (PARTITION BY {k} ORDER BY cap::DOUBLE / w::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM f_{level})",
            f"t_{level} AS (SELECT *, max(CASE WHEN NOT is_full AND rest = r THEN rem END) OVER (PARTITION BY {k}) AS x FROM s_{level})",
            f"b_{level} AS (SELECT {k}, {level}, (CASE WHEN is_full THEN cap ELSE upto * x // r - (upto - w) * x // r END)::HUGEINT AS given FROM t_{level})"]
        key.append(level)
    ctes += [
        "budgets AS (SELECT domain, lang, source, tokens::BIGINT AS tokens, given::BIGINT AS budget FROM b_source JOIN leaves USING (domain, lang, source) WHERE given > 0)",
        "epochs AS (SELECT i.*, tokens, budget, unnest(range(0, (budget - 1) // tokens + 1)) AS epoch FROM items i JOIN budgets USING (domain, lang, source))",
        f"p AS (SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY md5('{mix.seed}:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position FROM epochs)"]
    return "WITH " + ",\n".join(ctes) + """
SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, position::BIGINT AS position, n_tokens, least(n_tokens, budget - position)::BIGINT AS n_used
FROM p WHERE position < budget"""
