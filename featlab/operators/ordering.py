"""Global row order without funnelling rows through one task.

``Window.orderBy`` with no ``partitionBy`` moves every row into a single
partition. At scale we instead range-partition on the (total) sort key,
number rows inside each partition, and add the count of earlier rows from
a summary table with one row per partition (its size is bounded by the
partition count we choose, so broadcasting it is safe). Ranges split hot
key values across partitions because the key includes a unique tie-break,
so a value that holds a third of the rows is still spread over many tasks.

Spark's range sampler is seeded from the RDD id, so two executions of the
same ``repartitionByRange`` may cut different ranges. ``global_rank``
therefore writes the numbered frame once as a reliable checkpoint (in the
cluster's ``spark.checkpoint.dir``) and derives both the per-partition
summary and the rows from that copy; it survives executor loss and task
retries. Aggregate-only users (``partition_prefix_aggregate``) compute the
per-partition summary in the same task as the rows and need no copy.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featlab.session import reliable_checkpoint, written_table

_PID, _LOC, _MID = "_fl_pid", "_fl_loc", "_fl_mid"
SUMMARY_ROWS = 10_000   # a summary of at most so many rows goes through the driver to all tasks; a longer one is joined


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranged_local_numbers(df: DataFrame, keys: Sequence, num_partitions: int | None = None) -> DataFrame:
    """Range partition + sort on ``keys``; add partition id and 0-based
    position inside the partition (JVM-side, no Python)."""
    ks = _as_cols(keys)
    n = _partitions(df, num_partitions)
    out = (df.repartitionByRange(n, *ks).sortWithinPartitions(*ks)
           .withColumn(_MID, F.monotonically_increasing_id()))
    return (out.withColumn(_PID, F.shiftright(F.col(_MID), 33))
               .withColumn(_LOC, F.col(_MID) - F.shiftleft(F.col(_PID), 33))
               .drop(_MID))


def global_rank(df: DataFrame, order_by: Sequence, rank_col: str = "rank",
                partition_by: Sequence[str] = (), num_partitions: int | None = None,
                size_col: str | None = None) -> DataFrame:
    """1-based ``row_number`` over ``order_by`` (optionally restarting per
    ``partition_by`` group). ``order_by`` must be a total order (end it with
    a unique id) so the result is deterministic.

    ``partition_by`` is meant for few, possibly huge groups (class labels):
    the summary table has at most ``partitions + groups`` rows. ``size_col``
    adds the group's row count (the whole frame's without groups).
    """
    groups = list(partition_by)
    ranged = reliable_checkpoint(ranged_local_numbers(df, [*groups, *order_by], num_partitions))
    summ = ranged.groupBy(_PID, *groups).agg(F.count(F.lit(1)).alias("_fl_cnt"),
                                             F.min(_LOC).alias("_fl_first"))
    w = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_fl_off", F.coalesce(F.sum("_fl_cnt").over(w), F.lit(0)))
    extra = []
    if size_col:
        summ = summ.withColumn(size_col, F.sum("_fl_cnt").over(Window.partitionBy(*groups)))
        extra = [size_col]
    summ = summ.select(_PID, *groups, "_fl_off", "_fl_first", *extra)
    # One row per (partition, group) boundary, at most partitions + groups rows: few are read in
    # one job and sent to all tasks; more (group keys may be many) are written and joined by a shuffle.
    few = summ.limit(SUMMARY_ROWS + 1).collect()
    if len(few) <= SUMMARY_ROWS:
        summ = F.broadcast(df.sparkSession.createDataFrame(few, summ.schema))
    else:
        summ = reliable_checkpoint(summ)
    joined = ranged.join(summ, [_PID, *groups], "inner")
    return (joined.withColumn(rank_col, F.col("_fl_off") + F.col(_LOC) - F.col("_fl_first") + 1)
            .drop(_PID, _LOC, "_fl_off", "_fl_first"))


def partition_prefix_aggregate(df: DataFrame, order_by: Sequence, aggs: dict,
                               num_partitions: int | None = None) -> DataFrame:
    """Per range partition: row count plus caller aggregates that may use
    the local 0-based position column ``_fl_loc``; adds ``_fl_before``, the
    number of rows in earlier partitions. Output has one row per partition,
    so a final combine over it is tiny."""
    ranged = ranged_local_numbers(df, order_by, num_partitions)
    summ = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_fl_cnt"),
                                    *[expr.alias(name) for name, expr in aggs.items()])
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return summ.withColumn("_fl_before", F.coalesce(F.sum("_fl_cnt").over(w), F.lit(0)))


LOCAL_POS_NAME = _LOC


def dense_rank_ids(df: DataFrame, key: str, tie_break: Sequence[str], id_col: str = "dense_id",
                   num_partitions: int | None = None) -> DataFrame:
    """0-based dense rank of ``key`` (equal keys share an id, ids follow the
    sort order of ``key``) attached to every row, in one range pass.

    Rows are range partitioned on (key, tie_break) - so one hot key may span
    several partitions - and sorted; a vectorised pass numbers the distinct
    keys inside each partition in order. The numbered rows are written once,
    and a summary with one row per partition (distinct count, first and last
    key) gives each partition its offset; a key continuing from the previous
    partition keeps that partition's last id."""
    from pyspark import TaskContext
    from pyspark.sql.types import LongType, StructField, StructType

    n = _partitions(df, num_partitions)
    ks = [F.col(key), *[F.col(c) for c in tie_break]]
    ranged = df.repartitionByRange(n, *ks).sortWithinPartitions(*ks)
    # a new StructType: ``.add`` would mutate the frame's cached schema
    schema = StructType([*ranged.schema.fields, StructField(_PID, LongType()), StructField("_fl_local", LongType())])

    place = ranged.columns.index(key)

    def number(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        pid, base, prev, started = TaskContext.get().partitionId(), -1, None, False
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            k = batch.column(place)
            a, b = k.slice(0, n - 1), k.slice(1)   # neighbours; keys stay Arrow values, NULL equals NULL
            same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
            new = np.ones(n, dtype="int64")
            new[1:] -= np.asarray(same.to_numpy(zero_copy_only=False), dtype="int64")
            new[0] = 0 if started and k[0].as_py() == prev else 1
            local = base + np.cumsum(new)
            base, prev, started = int(local[-1]), k[n - 1].as_py(), True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, pid, dtype="int64")), pa.array(local)],
                                             names=[*batch.schema.names, _PID, "_fl_local"])

    return _with_offsets(written_table(ranged.mapInArrow(number, schema)), key, id_col)


def _with_offsets(numbered: DataFrame, key: str, id_col: str) -> DataFrame:
    """Global dense ranks from a written table whose partitions (``_fl_pid``, in key order) have their own (``_fl_local``)."""
    summ = (numbered.groupBy(_PID).agg((F.max("_fl_local") + 1).alias("n"),
                                       F.min_by(key, "_fl_local").alias("first"),
                                       F.max_by(key, "_fl_local").alias("last"))
            .orderBy(_PID).collect())   # one row per non-empty partition
    offsets, off, prev_n, prev_last = [], 0, 0, None
    for i, r in enumerate(summ):
        if i:
            off += prev_n - (1 if r["first"] == prev_last else 0)
        offsets.append((r[_PID], off))
        prev_n, prev_last = r["n"], r["last"]
    off_df = F.broadcast(numbered.sparkSession.createDataFrame(offsets, f"{_PID} long, _fl_off long"))
    return (numbered.join(off_df, _PID)
            .withColumn(id_col, F.col("_fl_off") + F.col("_fl_local"))
            .drop(_PID, "_fl_local", "_fl_off"))


#: Rows that ``packed_dense_rank_ids`` sorts together before and after its shuffle; sampled keys in all and of a task.
PACK_ROWS, SAMPLED_KEYS, TASK_KEYS = 1 << 20, 200_000, 512


def _term_order(terms: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(dense rank of every term in byte order, the distinct terms in that order)."""
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary.cast(pa.large_binary())).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def packed_dense_rank_ids(df: DataFrame, key: str, salt: Column, id_col: str = "dense_id") -> DataFrame:
    """``dense_rank_ids`` of a string key without NULLs, for many rows: what the shuffle and the disk hold are sorted,
    compressed blocks of rows. ``salt``: a number that tells rows of one key apart, so that a key which many rows
    hold is split. Ranges are cut by a sample that is taken once, so any task's rows go the same way again."""
    cols = df.columns
    place, others = cols.index(key), [c for c in cols if c != key]
    rows = df.withColumn("_fl_salt", salt.cast("long"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw, held, n = np.random.default_rng(TaskContext.get().partitionId()), [], 0
        for b in batches:
            n += b.num_rows
            some = np.sort(draw.choice(b.num_rows, min(b.num_rows, 64), replace=False))
            held.append((b.num_rows, b.take(pa.array(some)).select([key, "_fl_salt"])))
        if n:
            t = pa.Table.from_batches([x for _, x in held])
            weight = np.concatenate([np.full(x.num_rows, k / max(1, x.num_rows)) for k, x in held])
            some = draw.choice(t.num_rows, min(t.num_rows, TASK_KEYS), replace=False)
            t = t.take(pa.array(some))
            yield pa.RecordBatch.from_arrays([t.column(0).combine_chunks().cast(pa.binary()), t.column(1).combine_chunks(), pa.array(weight[some] * (n / weight[some].sum()))], names=["k", "s", "w"])
    sampled = written_table(rows.mapInArrow(sample, "k binary, s long, w double"))
    total = sampled.agg(F.sum("w")).first()[0] or 0
    seen = sorted((bytes(r["k"]), r["s"], r["w"]) for r in sampled.orderBy(F.xxhash64("k", "s")).limit(SAMPLED_KEYS).collect())
    upto = np.cumsum([w for _, _, w in seen])
    parts = max(_partitions(df, None), math.ceil(total / PACK_ROWS))
    cuts = np.unique(np.searchsorted(upto, np.arange(1, parts) * (upto[-1] / parts))) if seen else []
    bounds = sorted({seen[int(c)][:2] for c in cuts})   # a part's first key and salt

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            rank, names = _term_order(t.column(place).combine_chunks())
            names, salts = names.cast(pa.large_binary()), t.column("_fl_salt").to_numpy()
            order = np.lexsort((salts, rank))
            rank, salts = rank[order], salts[order]
            t, ends = t.drop_columns(["_fl_salt"]).take(pa.array(order)), []
            for term, s in bounds:
                k = bisect.bisect_left(names, term, key=lambda x: x.as_py())
                a, b = np.searchsorted(rank, [k, k + 1])
                same = k < len(names) and names[k].as_py() == term
                ends.append(int(a + np.searchsorted(salts[a:b], s)) if same else int(a))
            for pid, (a, b) in enumerate(zip([0, *ends], [*ends, len(rank)])):
                if b > a:
                    sink = pa.BufferOutputStream()
                    # sorted keys share their beginnings
                    pq.write_table(t.slice(a, b - a), sink, compression="zstd", use_dictionary=others, column_encoding={key: "DELTA_BYTE_ARRAY"}, write_statistics=False)
                    yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["pid", "rows"])
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= PACK_ROWS:
                yield from out(held)
                held, n = [], 0
        if held:
            yield from out(held)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pid: int, held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            t = pa.concat_tables(held).combine_chunks()
            rank, _ = _term_order(t.column(place).combine_chunks())
            order = np.argsort(rank, kind="stable")
            t = t.take(pa.array(order)).append_column(_PID, pa.array(np.full(len(order), pid))).append_column("_fl_local", pa.array(rank[order]))
            yield from t.to_batches(max_chunksize=50_000)
        now, held = None, []
        for b in batches:
            for pid, blob in zip(b.column(0).to_pylist(), b.column(1)):
                if pid != now and held:
                    yield from out(now, held)
                    held = []
                now = pid
                held.append(pq.read_table(pa.BufferReader(blob.as_buffer()), use_threads=False))
        if held:
            yield from out(now, held)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], f"{_PID} long, _fl_local long"])
    sent = rows.mapInArrow(pack, "pid long, rows binary").repartition(len(bounds) + 1, "pid").sortWithinPartitions("pid")
    return _with_offsets(written_table(sent.mapInArrow(number, schema)), key, id_col)
