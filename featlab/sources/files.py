"""File scans and sinks.

Every scan is a Spark reader with an explicit schema (no inference), so a
cluster reads splits in parallel; every sink writes part files in parallel
(no single-file concatenation on the driver).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# ---- S01: CSV feature tables -----------------------------------------------------------
def read_train_test(spark: SparkSession, train: str | DataFrame, test: str | DataFrame,
                    schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Exactly one of path / DataFrame for each side."""
    def load(x):
        if isinstance(x, DataFrame):
            return x
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(x)
    return load(train), load(test)


# ---- S02-S07: text corpora --------------------------------------------------------------
def read_labelled_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Each line ``text1 \\t ... \\t label``: all fields but the last are
    texts split on one blank, the last is the label; lines without a tab
    are skipped."""
    lines = spark.read.text(path).filter(F.instr("value", "\t") > 0)
    parts = F.split("value", "\t")
    texts = F.slice(parts, 1, F.size(parts) - 1)
    return lines.select(F.transform(texts, lambda t: F.split(t, " ")).alias("seqs"),
                        F.element_at(parts, -1).alias("label"))


def read_lines(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One document per line; the id is the line order (file order,
    stable for a fixed input) from ``monotonically_increasing_id``."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias(id_col),
                                        F.trim("value").alias("text"))


def read_token_stream(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace tokens of every line with (line id, position)."""
    lines = read_lines(spark, path, "line")
    toks = F.filter(F.split("text", r"\s+"), lambda t: t != "")
    return lines.select("line", F.posexplode(toks).alias("pos", "token"))


def read_word_list(spark: SparkSession, path: str, col: str = "word") -> DataFrame:
    """Stop-word / dictionary list, one entry per line."""
    return spark.read.text(path).select(F.trim("value").alias(col)).filter(F.col(col) != "").distinct()


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``token[\\tindex]`` lines; the index defaults to the line
    number (0-based), counted through the files of a folder in name order by
    the distributed global rank (no single-task read)."""
    from featlab.operators.ordering import global_rank
    # several files: by name, then by split of the file, then by line within the split (tasks may pack splits in any order)
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("_fl_file"), F.col("_metadata.file_block_start").alias("_fl_start"),
                                       F.monotonically_increasing_id().alias("_fl_mono"), "value")
    lines = global_rank(raw, ["_fl_file", "_fl_start", "_fl_mono"], "line").withColumn("line", F.col("line") - 1)
    parts = F.split(F.col("value"), "\t")
    stop = lines.filter(F.size(parts) > 2).agg(F.min("line")).first()[0]   # the list ends before a line of three fields
    if stop is not None:
        lines = lines.filter(F.col("line") < stop)
    return lines.select(F.trim(F.element_at(parts, 1)).alias("token"),
                        F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("bigint"), F.col("line")).alias("id"))


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """File listing (path, modificationTime, length) without contents."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "modificationTime", "length")


def read_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Whole files as rows (``path, length, text``), bytes that are no
    UTF-8 left out; a file is one value, so it must fit a task. Spark's scan
    passes over files of length 0."""
    from featlab.functions.text import to_unicode
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", to_unicode(F.col("content")).alias("text"))


def labelled_binary(spark: SparkSession, files: str, annotations: DataFrame,
                    path_col: str = "path") -> tuple[DataFrame, DataFrame]:
    """(bytes, label) records by joining the file scan with an
    annotation table on path; also returns the annotations whose file is
    missing (left anti join)."""
    place = lambda c: F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")  # noqa: E731  without scheme and host
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(files) \
        .select(place(F.col("path")).alias("_fl_place"), "content", "length")
    ann = annotations.withColumn("_fl_place", place(F.col(path_col)))
    return scan.join(ann, "_fl_place").drop("_fl_place"), ann.join(scan.select("_fl_place"), "_fl_place", "left_anti").drop("_fl_place")


# ---- sinks ----------------------------------------------------------------------------
def write_lines(df: DataFrame, line: str, path: str, mode: str = "overwrite") -> None:
    """One text line per row (part files are the parallelism)."""
    df.select(F.col(line).alias("value")).write.mode(mode).text(path)


def write_vocab(df: DataFrame, path: str, term: str = "term", id_col: str = "id", with_ids: bool = True, mode: str = "overwrite") -> None:
    """One term a line in the order of ``id_col`` through the part files
    in name order, with ``\\t`` and the id after it unless ``with_ids`` is
    False; :func:`read_vocab` reads both (line number = id when ids are dense from 0)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = F.concat_ws("\t", F.col(term), F.col(id_col).cast("string")) if with_ids else F.col(term)
    (df.repartitionByRange(n, F.col(id_col)).sortWithinPartitions(id_col).select(line.alias("value")).write.mode(mode).text(path))


def write_vectors(df: DataFrame, key: str, vec: str, path: str, mode: str = "overwrite") -> None:
    """A ``n d`` header line, then ``key v1 ... vd`` lines. The header is
    the first part file, so the concatenated parts are one file in the usual
    text form and the rows are still written in parallel. An empty table has
    no header."""
    line = F.concat_ws(" ", F.col(key).cast("string"), F.array_join(F.transform(vec, lambda x: x.cast("string")), " "))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size(vec)), F.lit(0)).alias("d")).first()
    header = df.sparkSession.range(0, 1, 1, 1).select(F.lit(f"{size.n} {size.d}").alias("value"))
    rows = df.select(line.alias("value"))
    (header.union(rows) if size.n else rows).write.mode(mode).text(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``key v1 ... vd`` lines to (key, vector). A ``n d`` header (two
    integers, the second the length of the vectors) is passed over."""
    parts = F.split(F.trim("value"), " +")
    rows = spark.read.text(path).select(parts.alias("p")).filter(F.size("p") > 1)
    dim = rows.agg(F.max(F.size("p")) - 1).first()[0] or 0
    header = (F.size("p") == 2) & F.element_at("p", 1).rlike(r"^\d+$") & (F.element_at("p", 2) == F.lit(str(dim)))
    if dim != 1:   # with one component a header cannot be told from a row by its form
        rows = rows.filter(~header)
    return rows.select(F.element_at("p", 1).alias("key"), F.transform(F.slice("p", 2, F.size("p") - 1), lambda x: x.cast("double")).alias("vector"))


def score_file_name(name: str = "submit", mean: float | None = None, std: float | None = None, stamp: str | None = None) -> str:
    """Default name of a score file: the given stamp, or the mean and deviation of the validation scores."""
    tail = stamp if stamp is not None else f"{mean:.6f}-{std or 0.0:.6f}" if mean is not None else ""
    return f"{name}_{tail}.csv" if tail else f"{name}.csv"


def write_scores(df: DataFrame, id_col: str, score_col: str, path: str, name: str = "score", mean: float | None = None,
                 std: float | None = None, stamp: str | None = None) -> str:
    """``id,score`` CSV with a header (part files) at ``path``, or at the
    default name below it when a stamp or the validation scores' mean and
    deviation are given. Returns the place."""
    place = path if mean is None and stamp is None else f"{path.rstrip('/')}/{score_file_name('submit', mean, std, stamp)}"
    df.select(id_col, F.col(score_col).alias(name)).write.mode("overwrite").option("header", True).csv(place)
    return place


def write_sequences(df: DataFrame, path: str, label: str = "label", seqs: Sequence[str] = ()) -> None:
    """int64 label + int64 sequences as Parquet (the portable
    replacement of the record format)."""
    df.select(F.col(label).cast("bigint"), *[F.col(s).cast("array<bigint>") for s in seqs]) \
        .write.mode("overwrite").parquet(path)


def read_sequences(spark: SparkSession, path: str, n_seqs: int) -> DataFrame:
    schema = "label bigint, " + ", ".join(f"seq{i} array<bigint>" for i in range(n_seqs))
    return spark.read.schema(schema).parquet(path)


def write_predictions(confusion: DataFrame, probs: DataFrame, classes: DataFrame, path: str) -> None:
    """Confusion matrix, probabilities and classes as three tables."""
    confusion.write.mode("overwrite").parquet(path + "/confusion")
    probs.write.mode("overwrite").parquet(path + "/probabilities")
    classes.write.mode("overwrite").parquet(path + "/classes")


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """Parameters as one JSON line in a text file of any store Spark writes to."""
    spark.createDataFrame([(json.dumps(params, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def save_model(model, path: str) -> None:
    """A fitted MLlib model or pipeline."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    return cls.load(path)


def save_table(df: DataFrame, path: str) -> None:
    """Fitted lookup tables (vocabularies, encoders) as Parquet."""
    df.write.mode("overwrite").parquet(path)
