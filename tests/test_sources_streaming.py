"""Sources and sinks round trips, streaming transform, misc hooks."""

import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from featlab.operators import linalg as L
from featlab.operators import segmentation as SG
from featlab.operators.encoders import fit_label_encoder
from featlab.operators.mean_encoding import MeanEncoder
from featlab.sources import files as S
from featlab.streaming.apply import apply_fitted, run_to_memory


def _tmp():
    return tempfile.mkdtemp(prefix="featlab-test-")


def test_labelled_tsv_and_vocab(spark):
    d = _tmp()
    with open(os.path.join(d, "c.tsv"), "w") as f:
        f.write("a b\tc d e\tpos\nno tab here\nx\tneg\n")
    df = S.read_labelled_tsv(spark, os.path.join(d, "c.tsv")).collect()
    assert [(list(map(list, r.seqs)), r.label) for r in df] == [([["a", "b"], ["c", "d", "e"]], "pos"), ([["x"]], "neg")]
    with open(os.path.join(d, "v.txt"), "w") as f:
        f.write("[PAD]\nhello\nworld\t7\n")
    v = {r.token: r.id for r in S.read_vocab(spark, os.path.join(d, "v.txt")).collect()}
    assert v == {"[PAD]": 0, "hello": 1, "world": 7}


def test_vector_and_sequence_sinks(spark):
    d = _tmp()
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.5])], "k string, v array<double>")
    S.write_vectors(df, "k", "v", d + "/vec")
    back = {r.key: list(r.vector) for r in S.read_vectors(spark, d + "/vec").collect()}
    assert back == {"a": [1.0, 2.0], "b": [3.0, 4.5]}
    seq = spark.createDataFrame([(1, [1, 2, 3], [4])], "label long, seq0 array<long>, seq1 array<long>")
    S.write_sequences(seq, d + "/seq", "label", ["seq0", "seq1"])
    r = S.read_sequences(spark, d + "/seq", 2).first()
    assert r.label == 1 and list(r.seq0) == [1, 2, 3]
    S.save_params(spark, {"a": 1, "b": [1, 2]}, d + "/p")
    assert S.load_params(spark, d + "/p") == {"a": 1, "b": [1, 2]}


def test_labelled_binary_reports_missing(spark):
    d = _tmp()
    for name in ("x.bin", "y.bin"):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"\x00\x01" * 10)
    ann = spark.createDataFrame([(os.path.join(d, "x.bin"), 1), (os.path.join(d, "z.bin"), 0)], "path string, label long")
    found, missing = S.labelled_binary(spark, d, ann)
    assert found.count() == 1 and missing.count() == 1


def test_streaming_applies_fitted_transforms(spark):
    d = _tmp()
    pdf = pd.DataFrame({"id": range(40), "c": ["a", "b", "c", "a"] * 10, "y": np.arange(40) / 10.0})
    train = spark.createDataFrame(pdf)
    _, model = MeanEncoder(["c"], "y", id_col="id", n_splits=4).fit_transform(train)
    enc = fit_label_encoder(train, "c")
    train.write.parquet(d + "/in")
    stream = spark.readStream.schema(train.schema).parquet(d + "/in")
    out = apply_fitted(stream, model.transform, lambda df: enc.transform(df, "code"))
    got = run_to_memory(out, "fl_stream_test", d + "/ckpt")
    assert got.count() == 40 and got.filter(F.col("c_pred").isNull() | F.col("code").isNull()).count() == 0


def test_prior_weight_hook(spark):
    pdf = pd.DataFrame({"id": range(20), "c": ["a", "b"] * 10, "y": [1.0, 0.0] * 10})
    out, _ = MeanEncoder(["c"], "y", id_col="id", n_splits=2, prior_weight=lambda n: n * 0.0).fit_transform(
        spark.createDataFrame(pdf))
    # weight 0 -> pure category mean of the other fold
    assert {r.c: r.c_pred for r in out.select("c", "c_pred").distinct().collect()} == {"a": 1.0, "b": 0.0}


def test_search_mode_tag_lemma_and_freq(spark):
    d = spark.createDataFrame([("中华", 10), ("华人", 5), ("中华人民", 20), ("人民", 10)], "word string, freq bigint")
    df = spark.createDataFrame([("中华人民",)], "t string")
    words = SG.segment_text(df, "t", d, search_mode=True).first().words
    assert "中华人民" in words and "中华" in words and "人民" in words
    broken = SG.suggest_freq(d, "中华人民", parts=["中华", "人民"])
    w2 = SG.segment_text(df, "t", broken).first().words
    assert w2 == ["中华", "人民"]
    toks = spark.createDataFrame([("cats",), ("ran",)], "token string")
    tags = spark.createDataFrame([("cats", "n")], "word string, tag string")
    assert {r.token: r.tag for r in SG.tag_tokens(toks, "token", tags).collect()} == {"cats": "n", "ran": "x"}
    lem = spark.createDataFrame([("cats", "cat")], "form string, lemma string")
    assert {r.token: r.lemma for r in SG.lemmatize(toks, "token", lem).collect()} == {"cats": "cat", "ran": "ran"}


def test_least_squares_matches_numpy(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(200, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 0.01 * rng.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "y": y}))
    w = L.least_squares(df, ["a", "b", "c"], "y")
    np.testing.assert_allclose(w, np.linalg.lstsq(X, y, rcond=None)[0], atol=1e-9)


def test_line_token_wordlist_listing_and_scores(spark):
    d = _tmp()
    with open(os.path.join(d, "corpus.txt"), "w") as f:
        f.write("a b  c\n\nd e\n")
    with open(os.path.join(d, "stop.txt"), "w") as f:
        f.write("the\n a \nthe\n")
    lines = S.read_lines(spark, os.path.join(d, "corpus.txt")).orderBy("doc_id").collect()
    assert [r.text for r in lines] == ["a b  c", "", "d e"]
    toks = S.read_token_stream(spark, os.path.join(d, "corpus.txt")).orderBy("line", "pos").collect()
    assert [r.token for r in toks] == ["a", "b", "c", "d", "e"]
    assert sorted(r.word for r in S.read_word_list(spark, os.path.join(d, "stop.txt")).collect()) == ["a", "the"]
    assert S.list_files(spark, d, glob="*.txt").count() == 2
    sc = spark.createDataFrame([(1, 0.5), (2, 0.25)], "id long, p double")
    S.write_scores(sc, "id", "p", d + "/scores", "target")
    back = spark.read.option("header", True).csv(d + "/scores").collect()
    assert sorted((r.id, r.target) for r in back) == [("1", "0.5"), ("2", "0.25")]


def test_to_unicode_and_date_mentions(spark):
    from featlab.functions.dates import date_mentions
    from featlab.functions.text import to_unicode
    df = spark.createDataFrame([(bytearray(b"ok\xff\xfeyes"),)], "b binary")
    assert df.select(to_unicode("b")).first()[0] == "okyes"
    t = spark.createDataFrame([("会议在2024年5月6日下午3点开始",)], "t string")
    assert t.select(date_mentions("t")).first()[0] == ["2024年5月6日下午3点"]


def test_forest_rankings(spark):
    from featlab.operators import models as MD
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 2))
    pdf = pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "y": 3 * X[:, 0] + 0.1 * rng.normal(size=300)})
    df = spark.createDataFrame(pdf.assign(id=range(len(pdf))))
    r = {x.feature: x.score for x in MD.single_feature_ranking(df, ["a", "b"], "y", "id", splits=2).collect()}
    assert r["a"] > 0.8 > r["b"]
    imp = MD.impurity_importance(df, ["a", "b"], "y")
    assert imp["a"] > imp["b"]


def test_readers_pass_over_headers_and_stop_lines(spark, tmp_path):
    (tmp_path / "v.txt").write_text("2 3\na 1 2 3\nb 4 5 6\n")
    assert {r.key: list(r.vector) for r in S.read_vectors(spark, str(tmp_path / "v.txt")).collect()} == {"a": [1, 2, 3], "b": [4, 5, 6]}
    (tmp_path / "w.txt").write_text("x\ny\t7\nz\t1\t2\nq\n")
    assert {(r.token, r.id) for r in S.read_vocab(spark, str(tmp_path / "w.txt")).collect()} == {("x", 0), ("y", 7)}


def test_annotations_match_files_by_any_scheme(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"1")
    (tmp_path / "b.bin").write_bytes(b"2")
    ann = spark.createDataFrame([(f"file://{tmp_path}/a.bin", 1), (f"{tmp_path}/b.bin", 2), ("hdfs://host:1/none", 3)], "path string, label int")
    found, missing = S.labelled_binary(spark, str(tmp_path), ann)
    assert {(bytes(r.content), r.label) for r in found.collect()} == {(b"1", 1), (b"2", 2)} and [r.label for r in missing.collect()] == [3]


def test_model_is_saved_and_loaded(spark, tmp_path):
    from pyspark.ml.regression import LinearRegressionModel

    from featlab.operators import models as MD
    df = MD.assemble(spark.createDataFrame([(float(k), 2.0 * k) for k in range(9)], "a double, label double"), ["a"])
    S.save_model(MD.lasso(0.0).fit(df), str(tmp_path / "m"))
    assert abs(S.load_model(LinearRegressionModel, str(tmp_path / "m")).coefficients[0] - 2) < 1e-6
