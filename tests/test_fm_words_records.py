"""Factorization machine steps, unknown words, record files."""

import itertools
import math
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from featlab.operators import encoders as EN
from featlab.operators import factor_machine as FM
from featlab.operators import unknown_words as U
from featlab.operators.vectors import fm_second_order
from featlab.sources import records as RC

K, FIELDS = 2, 3


def fm_rows(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(200):
        a, b, x = int(rng.integers(0, 4)), int(rng.integers(0, 5)), float(rng.normal())
        y = [1, -1, .5, 2][a] + [.3, 0, -2, 1, 1][b] + .7 * x + (a == 1) * (b == 2) * 3 + (a - 1.5) * x
        rows.append((k, f"a{a}" if a else None, f"b{b}", x, None if k % 50 == 9 else float(y + rng.normal() * .05)))
    return spark.createDataFrame(rows, "id long, a string, b string, x double, y double").repartition(3)


def test_factor_machine_equals_plain_alternating_steps(spark):
    df = fm_rows(spark)
    d = EN.fit_feature_dictionary(df.select("a", "b", "x"), numeric=["x"])
    parsed = d.parse(df, keep=["id", "y"])
    model = FM.fit(parsed, d.table, FIELDS, K, sweeps=3, l2=.5)
    rows = parsed.orderBy("id").collect()
    train = [r for r in rows if r.y is not None]
    xi, xv, y = (np.array(z) for z in ([r.xi for r in train], [r.xv for r in train], [r.y for r in train]))
    first = {r.idx: r.v for r in FM.start_table(d.table.select("idx").distinct(), K, 7).collect()}
    w, v = np.zeros(d.dim), np.array([first[j] for j in range(d.dim)])

    def score(xi, xv, w0):
        q = v[xi] * xv[..., None]
        return w0 + (w[xi] * xv).sum(1) + .5 * (q.sum(1) ** 2 - (q ** 2).sum(1)).sum(1)
    losses = []
    for _ in range(3):
        w0 = (y - score(xi, xv, 0.0)).mean()
        for f in range(FIELDS):
            for j in set(xi[:, f]):
                at = xi[:, f] == j
                others = [g for g in range(FIELDS) if g != f]
                basis = np.concatenate([np.ones((at.sum(), 1)), (v[xi[at][:, others]] * xv[at][:, others, None]).sum(1)], 1) * xv[at, f][:, None]
                w[j], v[j] = 0, 0
                t = np.linalg.solve(basis.T @ basis + .5 * np.eye(K + 1), basis.T @ (y[at] - score(xi[at], xv[at], w0)))
                w[j], v[j] = t[0], t[1:]
        losses.append(np.mean((y - score(xi, xv, w0)) ** 2))
    assert model.w0 == pytest.approx(w0) and model.losses == pytest.approx(losses) and losses[-1] < losses[0] / 2
    got = {r.id: r.score for r in FM.predict(parsed, model, FIELDS, ["id"]).collect()}
    all_i, all_v = np.array([r.xi for r in rows]), np.array([r.xv for r in rows])
    assert np.allclose([got[r.id] for r in rows], score(all_i, all_v, w0))
    # the score is w0 + sum w x + the second-order term of the library
    long = parsed.select("id", F.explode(F.arrays_zip("xi", "xv")).alias("z")).select("id", F.col("z.xi").alias("idx"), F.col("z.xv").alias("value"))
    second = {r.id: r.fm2 for r in fm_second_order(long, model.table.select("idx", F.col("v").alias("vec")), "id", K).collect()}
    lin = {r.id: r.s for r in long.join(model.table, "idx").groupBy("id").agg(F.sum(F.col("w") * F.col("value")).alias("s")).collect()}
    assert all(got[k] == pytest.approx(model.w0 + lin[k] + second[k]) for k in got)


def test_factor_machine_on_odd_rows(spark):
    df = spark.createDataFrame([(1, [0, 1], [1.0, None], 2.0), (2, [9, None], [1.0, 1.0], 4.0), (3, [0, 1], [float("nan"), 1.0], None)], "id long, xi array<long>, xv array<double>, y double")
    ids = spark.createDataFrame([(0,), (1,)], "idx long")
    model = FM.fit(df, ids, 2, 1, sweeps=1)
    assert all(math.isfinite(r.score) for r in FM.predict(df, model, 2, ["id"]).collect())
    none = FM.fit(df.limit(0), ids, 2, 1, sweeps=1)
    assert none.w0 == 0.0 and FM.predict(df.limit(0), none, 2, ["id"]).count() == 0


SEGMENTED = [["上海", "人", "爱", "上海滩"], ["我", "爱", "北京"], ["天安门", "很", "大"], None, [], ["", "a"], ["北京", None, "人"]]


def test_tag_model_and_paths_against_enumeration(spark):
    df = spark.createDataFrame([(k, w) for k, w in enumerate(SEGMENTED)], "id long, words array<string>").repartition(2)
    m = U.fit_tags(df, "words")
    flat = [[w for w in ws if w] for ws in SEGMENTED if ws]
    tags = ["".join("S" if len(w) == 1 else "B" + "M" * (len(w) - 2) + "E" for w in ws) for ws in flat]
    chars = ["".join(ws) for ws in flat]
    alphabet = set("".join(chars))
    n = sum(t.count("B") for t in tags)
    have = sum(t == "B" and c == "上" for ts, cs in zip(tags, chars) for t, c in zip(ts, cs))
    assert m.emit["B", "上"] == pytest.approx(math.log((have + .5) / (n + .5 * (len(alphabet) + 1))))
    be, bm = (sum((t + "|").count(p) for t in tags) for p in ("BE", "BM"))
    assert m.step["B", "E"] == pytest.approx(math.log((be + .5) / (be + bm + 1.5)))
    assert m.start["S"] == pytest.approx(math.log((sum(t[0] == "S" for t in tags) + .5) / (len(tags) + 1.5)))

    def weigh(run, path):
        if path[0] not in U.STARTS or path[-1] not in U.ENDS or any(b not in U.FOLLOWS[a] for a, b in zip(path, path[1:])):
            return None
        return m.start[path[0]] + sum(m.emission(t, c) for t, c in zip(path, run)) + sum(m.step[a, b] for a, b in zip(path, path[1:]))
    for run in ["上海", "人大", "滩北京天", "爱爱爱", "xyz上海", "天安门人"]:
        paths = {p: s for p in map("".join, itertools.product(U.TAGS, repeat=len(run))) if (s := weigh(run, p)) is not None}
        assert weigh(run, U.best_tags(run, m)) == pytest.approx(max(paths.values()))
    assert U.best_tags("x", m) == "S"


def test_unknown_runs_are_cut_anew(spark):
    model = U.fit_tags(spark.createDataFrame([(w,) for w in SEGMENTED], "words array<string>"), "words")
    rows = [(1, ["我", "爱", "天", "安", "门"]), (2, ["上海", "大", "，", "人"]), (3, None), (4, []), (5, ["我", None, "爱"]), (6, ["a"]), (1, ["天", "安", "门", "北京", "上", "海"])]
    df = spark.createDataFrame([(k, w, "x") for k, w in rows], "id long, words array<string>, _fl_run string").repartition(3)
    got = sorted(((r.id, r.words) for r in U.join_unknown(df, "words", model).collect()), key=str)

    def expect(words):
        out, run = [], ""
        for w in [*(w for w in words if w is not None), None]:
            if w is not None and len(w) == 1 and w.isalnum():
                run += w
                continue
            if run:
                out += U.cut_by_tags(run, U.best_tags(run, model)) if len(run) > 1 else [run]
                run = ""
            if w is not None:
                out.append(w)
        return out
    assert got == sorted(((k, None if w is None else expect(w)) for k, w in rows), key=str)
    assert ["天安门"] == U.cut_by_tags("天安门", U.best_tags("天安门", model))


def plain_crc(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (RC.POLYNOMIAL if crc & 1 else 0)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + RC.MASK) & 0xFFFFFFFF


def test_checksums():
    data = [b"", b"123456789", b"\x00" * 32, bytes(range(200)), b"x"]
    assert RC.masked_checksums(data).tolist() == [plain_crc(d) for d in data]
    unmasked = (plain_crc(b"123456789") - RC.MASK) & 0xFFFFFFFF
    assert (unmasked << 15 | unmasked >> 17) & 0xFFFFFFFF == 0xE3069283  # the published check value


SCHEMA = "label long, seq0 array<long>, seq1 array<long>"


def test_record_files_round_trip(spark, tmp_path):
    spark.dataSource.register(RC.SequenceRecords)
    rows = [(k, list(range(k % 5)), [-k, 2 ** 62, -2 ** 63]) for k in range(2500)] + [(None, None, []), (7, [], None)]
    path = f"file://{tmp_path}/r"
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df.write.format("sequence_records").mode("append").save(path)
    read = spark.read.format("sequence_records").schema(SCHEMA).load(path)
    assert read.rdd.getNumPartitions() == 3
    assert sorted(map(str, read.collect())) == sorted(map(str, df.collect()))
    df.limit(5).write.format("sequence_records").mode("append").save(path)
    assert spark.read.format("sequence_records").schema(SCHEMA).load(path).count() == len(rows) + 5  # a frame's files are listed once
    df.limit(4).write.format("sequence_records").mode("overwrite").save(path)
    assert spark.read.format("sequence_records").schema(SCHEMA).load(path).count() == 4
    df.limit(0).write.format("sequence_records").mode("overwrite").save(f"{path}2")
    assert spark.read.format("sequence_records").schema(SCHEMA).load(f"{path}2").count() == 0


def test_broken_records_are_reported(spark, tmp_path):
    spark.dataSource.register(RC.SequenceRecords)
    spark.createDataFrame([(1, [1, 2], [3])] * 3, SCHEMA).coalesce(1).write.format("sequence_records").mode("append").save(str(tmp_path / "r"))
    name, = [f for f in os.listdir(tmp_path / "r") if f.endswith(RC.SUFFIX) and not f.startswith(".")]
    good = (tmp_path / "r" / name).read_bytes()
    size = struct.unpack("<Q", good[:8])[0] + 16
    for bad, say in ((good[:size + 20] + b"\xff" + good[size + 21:], f"checksum in the record at byte {size}"), (good[:-3], "ends inside a record"),
                     (good[:2] + b"\x01" + good[3:], "checksum in the record at byte 0")):
        (tmp_path / "r" / name).write_bytes(bad)
        with pytest.raises(Exception, match=say):
            spark.read.format("sequence_records").schema(SCHEMA).load(str(tmp_path / "r")).collect()
    with pytest.raises(Exception, match="only long"):
        spark.read.format("sequence_records").schema("a string").load(str(tmp_path / "r")).collect()
