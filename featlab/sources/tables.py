"""Parquet table scans of the driver's star schema.

Scans are lazy; callers select columns right away so Catalyst prunes the
``ReadSchema`` and pushes filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table; with ``columns`` the scan reads only those."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views named like the tables, for ``spark.sql`` users."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy row-local work (tokenising, n-grams, regex) enough
    tasks. A big table already scans into many splits and is returned
    as is; a scan with fewer partitions than the cluster's parallelism (one
    small file, one row group) is round-robin repartitioned first."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
