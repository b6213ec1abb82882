"""Readers for the supplied Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one supplied table. Column pruning and filter pushdown reach the
    Parquet reader because nothing is selected here."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over the cluster before heavy per-row work, but only
    when it arrived in fewer partitions than the default parallelism (a
    file with one row group is one task). Large inputs already come in
    many splits and are left alone: no extra shuffle at scale."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
