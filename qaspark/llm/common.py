"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.session import scratch_path, ship_package

# Word separators of the operators' word definition ``[^\x20\x09-\x0D]+``.
SEPARATORS = " \t\n\x0b\x0c\r"
_SEP_CLASS = "[ \\t-\\r]+"


# Rows of a batch that goes to a Python worker: texts may be long.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Make the package known to Python workers and keep their batches
    small, so that a task's memory doesn't grow with the texts' lengths."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared scratch folder and
    read it back. Lineage is cut, and the rows survive lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEP_CLASS), F.lit(""))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*cols) if cols else df
