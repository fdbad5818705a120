"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces small
# shuffle partitions at run time, skew-join splits hot keys, UTC keeps
# timestamp arithmetic reproducible, and the UI stays off (no server).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable checkpoint files once their RDD is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "featlab", driver_memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is
    unset (local tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive executor loss
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        configured = tempfile.mkdtemp(prefix="featlab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint dir
    (never ``localCheckpoint``: an executor loss would lose the data)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df):
    """``df`` written once to the shared checkpoint folder as compressed
    Parquet and read back: for long tables, whose checkpoint (rows as Spark
    holds them in memory) would take many times the disk. Row order and
    partitions are not kept."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
