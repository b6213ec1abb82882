"""Readers and writers.

Paths are whatever the caller passes (a shared file system or object
store on a cluster). Intermediate outputs of the registered queries go
under ``qaspark.session.scratch_path``, below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QA_SCHEMA = "id bigint, category string, question string, answer string"

NUMERIC_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL")


# --- S1: JSON array files -------------------------------------------------

# JSON bytes of one array file where a writer may choose: two byte ranges of
# Spark's default size.
ARRAY_FILE_BYTES = 256 << 20

def read_json_array(spark: SparkSession, path: str, schema: str | StructType = QA_SCHEMA) -> DataFrame:
    """A file holding one JSON array of row objects (S1). Such a file is one
    document, so each file is read by one task; rewrite once as Parquet."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def _arrays_per_partition(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    """One JSON array per task, written as lines: ``[``, the rows (every row
    after the first prefixed with a comma), ``]``. Memory stays at one Arrow
    batch; the whole file is one JSON document."""
    yield pd.DataFrame({"value": ["["]})
    first = True
    for pdf in batches:
        rows = pdf["j"]
        if rows.empty:
            continue
        lines = "," + rows
        if first:
            lines.iloc[0] = rows.iloc[0]
            first = False
        yield pd.DataFrame({"value": lines.values})
    yield pd.DataFrame({"value": ["]"]})


def write_json_array(df: DataFrame, path: str, files: int | None = None, file_bytes: int | None = None) -> None:
    """Write rows as JSON array files, one array per output file (S1's
    writer). Each task joins only its own partition's rows. A file is written
    by one task: with ``file_bytes`` their number comes from the rows' JSON
    bytes (one more pass), so that no task gets more as the table grows."""
    from qaspark.session import ship_package

    ship_package(df.sparkSession)
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    if file_bytes:
        size = rows.agg(F.sum(F.octet_length("j"))).first()[0] or 0
        files = max(1, -(-size // file_bytes))
    if files:
        rows = rows.repartition(files)
    rows.mapInPandas(_arrays_per_partition, "value string").write.mode("overwrite").text(path)


# --- S2 / S4: splits -------------------------------------------------------

def write_splits(split_df: DataFrame, path: str, split_col: str = "split") -> None:
    """All splits in one table partitioned by split name."""
    split_df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split; the filter prunes the other partitions at planning."""
    return spark.read.parquet(path).where(F.col(split_col) == split)


# --- S5: row files ----------------------------------------------------------

def write_rows(df: DataFrame, path: str) -> None:
    """Overwrite a row file, as JSON lines."""
    df.write.mode("overwrite").json(path)


def read_rows(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


# --- S3 / S6: JSON-lines checkpoint -----------------------------------------

def checkpoint_lines(entries: DataFrame, idx: str = "idx", question: str = "question", scores: str = "scores",
                     written_at: Column | None = None) -> DataFrame:
    """One JSON text line per case (F27): idx, question cut to 100
    characters, the scores map, and the write time if given."""
    fields = [F.col(idx).alias("idx"), F.substring(F.col(question), 1, 100).alias("question"),
              F.col(scores).alias("scores")]
    if written_at is not None:
        fields.append(written_at.alias("written_at"))
    return entries.select(F.to_json(F.struct(*fields)).alias("value"))


def append_checkpoint(lines: DataFrame, path: str, commit: int | None = None) -> None:
    """Append a batch of checkpoint lines (S6); earlier lines stay. With
    ``commit``, the batch's number in the log, the lines go to a folder of
    that number, and a batch that is run again replaces its own lines. A log
    is written with numbers throughout or without."""
    if commit is None:
        lines.write.mode("append").text(path)
    else:
        lines.write.mode("overwrite").text(f"{path.rstrip('/')}/commit={int(commit)}")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and ``order`` of an append-only log's lines: the number of
    the commit (else the time at which the file was last changed), then the
    file's part number and name, then the place in the file."""
    lines = spark.read.text(path)
    commit = F.col("commit").cast("long") if "commit" in lines.columns else F.lit(None).cast("long")
    meta = "_metadata."
    order = F.struct(
        F.coalesce(commit, F.lit(-1)).alias("commit"),
        F.when(commit.isNull(), F.unix_micros(meta + "file_modification_time")).alias("changed_us"),
        F.expr("try_cast(nullif(regexp_extract(_metadata.file_name, '^part-([0-9]+)', 1), '') as bigint)").alias("part"),
        F.col(meta + "file_path").alias("file"),
        F.col(meta + "file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return lines.select("value", order.alias("order"))


def parse_checkpoint(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """Checkpoint lines to ``idx, question, written_at, scores``.
    Lines that are not JSON objects or carry no whole-number ``idx`` vanish;
    ``"scores": null`` keeps the case as done with no scores; only numeric
    and boolean scores are kept (P7), as doubles."""
    v = F.try_parse_json(F.col(value))
    idx_kind = F.schema_of_variant(F.try_variant_get(v, "$.idx", "variant"))
    m = F.try_variant_get(v, "$.scores", "map<string,variant>")

    def numeric(x):
        k = F.schema_of_variant(x)
        ok = k == "BOOLEAN"
        for n in NUMERIC_KINDS:
            ok = ok | k.startswith(n)
        return ok

    kept = F.map_filter(m, lambda k, x: numeric(x))
    scores = F.transform_values(kept, lambda k, x: F.try_variant_get(x, "$", "double"))
    idx_num = F.try_variant_get(v, "$.idx", "double")
    out = lines.select(
        *keep,
        F.try_variant_get(v, "$.idx", "bigint").alias("idx"),
        idx_kind.alias("_k"),
        idx_num.alias("_kv"),
        F.try_variant_get(v, "$.question", "string").alias("question"),
        F.try_variant_get(v, "$.written_at", "string").alias("written_at"),
        scores.alias("scores"),
        F.schema_of_variant(v).alias("_root"),
    )
    # a number with a whole value: 2 and 2.0 both mark case 2 as done (Python compares them equal)
    numeric_idx = F.col("_k").rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    whole = F.col("_kv") == F.floor(F.col("_kv"))
    keep = F.col("_root").startswith("OBJECT") & F.col("idx").isNotNull() & numeric_idx & whole
    return out.where(keep).drop("_k", "_kv", "_root")


def read_checkpoint(spark: SparkSession, path: str, duplicates: str = "latest") -> DataFrame:
    """Read a checkpoint folder (S3). ``duplicates="latest"`` keeps one entry
    per idx, the one with the greatest ``written_at``, and of those without
    it, or with the same, the last line of the log (a partial ``max_by``
    aggregate, safe for hot keys); ``"count"`` keeps every line, as a re-read
    of an append-only log does."""
    entries = parse_checkpoint(log_lines(spark, path), keep=("order",))
    if duplicates == "count":
        return entries.drop("order")
    last = F.struct(F.coalesce(F.col("written_at"), F.lit("")), "order")
    latest = entries.groupBy("idx").agg(F.max_by(F.struct("question", "written_at", "scores"), last).alias("e"))
    return latest.select("idx", "e.question", "e.written_at", "e.scores")


# --- S7 / S8: nested reports -------------------------------------------------

def write_json_rows(df: DataFrame, path: str) -> None:
    """Nested report rows as JSON lines."""
    df.write.mode("overwrite").json(path)


# --- S9 ---------------------------------------------------------------------

def require_columns(df: DataFrame, *required: str) -> DataFrame:
    """Fail early when a required column is missing (S9); a schema check on
    the driver, no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {df.columns}")
    return df



def require_rows(df: DataFrame, rule: Column, message: str) -> DataFrame:
    """Row rule (S9): the job fails with ``message`` on the first row that
    breaks ``rule``; rows pass through unchanged. The check is the filter
    predicate itself, so the optimizer cannot prune it away."""
    return df.where(F.when(F.coalesce(rule, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message))))
