"""General dates, whole files, ordered lists, tag filter, row and segment reductions: literal fixtures."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from featlab.functions import dates as D
from featlab.operators import stats as ST
from featlab.operators import vocab as V
from featlab.sources import files as S

AS_OF = dt.datetime(2020, 2, 12, 9, 30)   # a Wednesday
DATES = {
    "2021-03-05": (2021, 3, 5), "due 2021/3/5 at 15:07": (2021, 3, 5, 15, 7), "on 2021.03.05 7:08:09.25 pm": (2021, 3, 5, 19, 8, 9),
    "20210305T070809": (2021, 3, 5, 7, 8, 9), "x 20210305": (2021, 3, 5), "3/5/2021": (2021, 3, 5), "25/5/2021": (2021, 5, 25),
    "12-31-99": (1999, 12, 31), "paid 3/5": (2020, 3, 5), "the 5th of March 2021, 3pm": (2021, 3, 5, 15), "5 Mar": (2020, 3, 5),
    "5-Mar-21": (2021, 3, 5), "March 5th, 2021 12:15 am": (2021, 3, 5, 0, 15), "Sept. 30 2019": (2019, 9, 30), "March 5 15:07": (2020, 3, 5, 15, 7),
    "in June 2021": (2021, 6, 12), "2021-13-05": (2021, 5, 13), "see you Friday at 8:05": (2020, 2, 14, 8, 5), "wednesday": (2020, 2, 12),
    "12 pm": (2020, 2, 12, 12), "10:30": (2020, 2, 12, 10, 30), "Sat, 30 Nov 2019 10:00:01 +0000": (2019, 11, 30, 10, 0, 1),
    "no date": None, "": None, None: None, "2021-02-30": None, "13 pm": None, "25:61": None, "marching on": None,
}


def test_general_dates_anywhere_in_a_text(spark):
    df = spark.createDataFrame([(k,) for k in DATES], "t string").withColumn("ref", F.lit(AS_OF))
    got = {r.t: r.d for r in df.select("t", F.date_format(D.general_datetime("t", "ref"), "yyyy-MM-dd HH:mm:ss").alias("d")).collect()}
    assert got == {k: v and str(dt.datetime(*v)) for k, v in DATES.items()}
    both = df.filter("t in ('5-Mar-21', 'paid 3/5')").select("t", F.date_format(D.parse_cn_datetime("t", "ref"), "yyyy-MM-dd").alias("d")).collect()
    assert {r.t: r.d for r in both} == {"5-Mar-21": "2021-03-05", "paid 3/5": "2020-03-05"}
    leap = spark.createDataFrame([("April", dt.datetime(2020, 1, 31))], "t string, ref timestamp")
    assert leap.select(F.to_date(D.general_datetime("t", "ref"))).first()[0] == dt.date(2020, 4, 30)


def test_whole_files_and_ordered_lists(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_bytes(b"one\ntwo\xff")
    (tmp_path / "in" / "sub" / "b.txt").write_text("b")
    (tmp_path / "in" / "c.bin").write_text("no")
    rows = {pathlib.Path(r.path).name: (r.length, r.text) for r in S.read_files(spark, str(tmp_path / "in"), "*.txt").collect()}
    assert rows == {"a.txt": (8, "one\ntwo"), "b.txt": (1, "b")}
    vocab = spark.range(200).select(F.concat(F.lit("w"), F.repeat(F.lit("x"), (F.col("id") * 7 % 50).cast("int")), F.col("id")).alias("term"), "id").repartition(7)
    want = {r.term: r.id for r in vocab.collect()}
    for with_ids in (True, False):
        place = str(tmp_path / f"vocab{with_ids}")
        S.write_vocab(vocab, place, with_ids=with_ids)
        assert {r.token: r.id for r in S.read_vocab(spark, place).collect()} == want
        text = [line for f in sorted(pathlib.Path(place).glob("part-*")) for line in f.read_text().splitlines()]
        assert [line.split("\t")[0] for line in text] == sorted(want, key=want.get)


def test_vector_header_and_score_names(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.5])], "k string, v array<double>").repartition(2)
    S.write_vectors(df, "k", "v", str(tmp_path / "vec"))
    lines = [line for f in sorted((tmp_path / "vec").glob("part-*")) for line in f.read_text().splitlines()]
    assert lines[0] == "2 2" and sorted(lines[1:]) == ["a 1.0 2.0", "b 3.0 4.5"]
    assert {r.key: r.vector for r in S.read_vectors(spark, str(tmp_path / "vec")).collect()} == {"a": [1.0, 2.0], "b": [3.0, 4.5]}
    S.write_vectors(df.limit(0), "k", "v", str(tmp_path / "none"))
    assert S.read_vectors(spark, str(tmp_path / "none")).count() == 0
    scores = spark.createDataFrame([(1, 0.5)], "id long, p double")
    place = S.write_scores(scores, "id", "p", str(tmp_path), "score", mean=0.25, std=0.125)
    assert place.endswith("/submit_0.250000-0.125000.csv") and spark.read.option("header", True).csv(place).first().score == "0.5"
    assert S.write_scores(scores, "id", "p", str(tmp_path), stamp="20200212").endswith("/submit_20200212.csv")
    S.write_lines(spark.createDataFrame([("x y",), ("z",)], "l string"), "l", str(tmp_path / "lines"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ["x y", "z"]
    S.write_predictions(scores, scores, scores, str(tmp_path / "pred"))
    assert [spark.read.parquet(str(tmp_path / "pred" / t)).count() for t in ("confusion", "probabilities", "classes")] == [1, 1, 1]


def test_word_filter_with_tags(spark):
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(["cat", "a", "runs", "the", "dog", None, "", "zzz", "cat"])], "pos int, term string")
    stop = spark.createDataFrame([("the",), ("dog",)], "w string")
    tags = spark.createDataFrame([("cat", "n"), ("cat", "ns"), ("a", "n"), ("runs", "v"), ("dog", "n"), ("the", "n"), ("zzz", None)], "word string, tag string")
    pick = lambda df: sorted(r.pos for r in df.collect())
    assert pick(V.keep_words(rows)) == [0, 2, 3, 4, 7, 8]
    assert pick(V.keep_words(rows, stop_words=stop)) == [0, 2, 7, 8]
    assert pick(V.keep_words(rows, stop_words=stop, tags=tags)) == [0, 8]


def test_lookups_broadcast_only_what_fits_the_bound(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "x")], "pos int, term string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "term string, id long")
    for bound in (2, 3, None):
        assert sorted((r.pos, r.id) for r in V.lookup_ids(rows, vocab, vocab_size_bound=bound).collect()) == [(0, 1), (1, 0)]
    hinted = lambda bound: "strategy=broadcast" in V.lookup_ids(rows, vocab, vocab_size_bound=bound)._jdf.queryExecution().logical().toString()
    assert hinted(3) and not hinted(2)


def test_row_and_segment_reductions(spark):
    df = spark.createDataFrame([(0, [1.0, None, -2.0, 0.0]), (1, []), (2, None)], "id int, x array<double>")
    got = {r["id"]: r.asDict() for r in df.select("id", *[c.alias(n) for n, c in ST.reduce_row("x").items()]).collect()}
    assert got[0] == {"id": 0, "sum": -1.0, "mean": pytest.approx(-1 / 3), "max": 1.0, "min": -2.0, "prod": 0.0, "all": False, "any": True, "count_nonzero": 2}
    assert (got[1]["sum"], got[1]["prod"], got[1]["all"], got[1]["any"], got[1]["mean"], got[1]["max"]) == (0.0, 1.0, True, False, None, None)
    assert got[2]["sum"] is None and got[2]["mean"] is None
    seg = spark.createDataFrame([(0, 2.0), (0, 3.0), (3, 4.0), (9, 1.0), (None, 1.0)], "seg int, v double")
    rows = {r.seg: tuple(r)[1:] for r in ST.segment_reduce(seg, "seg", "v", 5).collect()}
    assert rows == {0: (5.0, 2.5, 3.0, 2.0, 6.0), 1: (0, 0, 0, 0, 1), 2: (0, 0, 0, 0, 1), 3: (4.0, 4.0, 4.0, 4.0, 4.0), 4: (0, 0, 0, 0, 1)}
