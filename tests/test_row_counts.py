"""Terms counted inside rows, hashed vectors, written tables."""

import collections
import hashlib
import math

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from featlab.functions.hashing import md5_mod
from featlab.operators import text_features as TF
from featlab.operators import token_windows as TW
from featlab.operators.ordering import dense_rank_ids
from featlab.session import written_table

ROWS = [(1, ["b", "a", "b", "a", "b"]), (2, ["a"]), (3, []), (4, None), (5, ["a", "b"]), (5, ["b", "c", "a", "b"]), (None, ["a", "a"]), (None, ["a", "ä"])]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id long, tok array<string>").repartition(3)


def expected(rows, n_min, n_max):
    out = collections.Counter()
    for k, t in rows:
        for n in range(n_min, n_max + 1):
            out.update((k, " ".join(t[i:i + n])) for i in range(len(t or []) - n + 1))
    return {(k, g): n for (k, g), n in out.items()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_by_row_equal_brute_force_with_repeated_and_null_ids(spark, monkeypatch):
    for step in (1, 3, 200_000):
        monkeypatch.setattr(TF, "STEP", step)
        for a, b in ((1, 1), (1, 3), (2, 3)):
            got = [tuple(r) for r in TF.doc_term_counts(frame(spark), "id", "tok", n_range=(a, b)).collect()]
            assert len(got) == len({r[:2] for r in got}) and {r[:2]: r[2] for r in got} == expected(ROWS, a, b)


def test_ids_that_come_once_are_counted_without_a_shuffle(spark):
    df = spark.createDataFrame(ROWS[:5], "id long, tok array<string>")
    assert "Exchange" not in plan(TF.doc_term_counts(df, "id", "tok", n_range=(1, 3)))


def test_a_bounded_vocabulary_writes_no_copy_of_the_counts(spark, monkeypatch):
    written = []
    monkeypatch.setattr(TF, "written_table", lambda df: written.append(df) or df)
    model, rows = TF.NGramBag("id", (1, 2), max_features=2).fit_counts(frame(spark), F.col("tok"))
    assert not written and [r.term for r in model.vocabulary.orderBy("term_id").collect()] == ["a", "b"]
    assert {(r.id, r.term): r["count"] for r in rows.collect()} == {k: n for k, n in expected(ROWS, 1, 1).items() if k[1] in "ab"}


def test_dense_ids_are_written_as_compressed_columns(spark, tmp_path):
    df = spark.createDataFrame([(i, f"some term {i % 50}") for i in range(20_000)], "id long, term string")
    got = dense_rank_ids(df, "term", ["id"])
    files = [f.replace("file:", "", 1) for f in got.inputFiles()]
    assert files and {pq.ParquetFile(f.replace("//", "")).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    order = {t: i for i, t in enumerate(sorted({f"some term {i}" for i in range(50)}))}
    assert all(r.dense_id == order[r.term] for r in got.collect()) and got.count() == 20_000
    assert sorted(tuple(r) for r in written_table(df).collect()) == sorted(tuple(r) for r in df.collect())


def test_hashed_vectors_equal_brute_force(spark):
    df = frame(spark)
    got = {(r.id, r.bucket): r.value for r in TF.hashed_vectors(df, "id", "tok", 8).collect()}
    want = collections.Counter()
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest(), 16)
    for k, t in ROWS:
        for w in t or []:
            want[k, number(w) % 8] += -1 if number("sign-" + w) % 2 == 0 else 1
    norm = collections.Counter()
    for (k, _), v in want.items():
        norm[k] += v * v
    assert set(got) == set(want) and all(math.isclose(got[k], v / math.sqrt(norm[k[0]])) for k, v in want.items())
    for m in (1, 2, 4096, 1 << 30, 1000):
        assert all(r.h == number(str(r.id)) % m for r in spark.range(50).select("id", md5_mod("id", m).alias("h")).collect())


def test_drawn_pairs_need_no_sort_by_lambda(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"])], "id long, tok array<string>")
    text = plan(TW.skipgrams(df, ["id"], "tok", 2, num_skips=2))
    assert "lambda" not in text.replace("sequence", "") and "md5" in text
