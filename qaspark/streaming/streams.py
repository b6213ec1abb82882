"""Structured Streaming versions of the append-and-resume loops.

Every job runs with a checkpoint location in the shared folder, so a
restart resumes where the last committed batch ended; sinks are Parquet
folders (file sink) or one folder per batch. Nothing is
collected to the driver: results are read back from the sink.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from qaspark.functions.text import normalize_question
from qaspark.operators.order import running_sums
from qaspark.session import ship_package


def file_stream(spark: SparkSession, path: str, schema=None, max_files: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """A file source; a single file works through a one-character glob."""
    reader = spark.readStream.format(fmt)
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> object:
    """Run a stream over everything available now and stop. ``append``
    writes through the file sink; ``update`` and ``complete`` write each
    batch's rows to a folder of its own (see ``run_batches``): read
    ``update`` with ``latest_per_key``, ``complete`` with ``latest_batch``."""
    if mode != "append":
        return run_batches(df, lambda batch, epoch: batch, out, checkpoint, mode)
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.format("parquet").option("path", out).start()
    q.awaitTermination()
    return q


def run_batches(df: DataFrame, step: Callable[[DataFrame, int], DataFrame], out: str, checkpoint: str,
                mode: str = "append") -> object:
    """Run a stream over everything available now; ``step(batch, epoch)``
    gives the rows of a batch, written to ``out/batch_id=<epoch>``. A batch
    that is run again after a failure overwrites its own folder, so the
    sink never holds a batch twice, and earlier batches stay readable.
    ``checkpoint`` and ``out`` belong together."""
    def write(batch: DataFrame, epoch: int) -> None:
        step(batch, epoch).write.mode("overwrite").parquet(f"{out}/batch_id={epoch}")

    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode)
    q = w.foreachBatch(write).start()
    q.awaitTermination()
    return q


def latest_batch(rows: DataFrame) -> DataFrame:
    """The newest result of a complete-mode sink."""
    newest = rows.agg(F.max("batch_id").alias("batch_id"))
    return rows.join(newest, "batch_id").drop("batch_id")


# --- T1 ------------------------------------------------------------------------

# Exact text forms of times in the rows that pass the state operator.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _order_key(text: str) -> tuple:
    """Order columns from their JSON form, nulls first."""
    return tuple((v is not None, v) for v in json.loads(text, parse_float=Decimal).values())


def _first_unseen(key, batches, state):
    """A key's first row by its order columns, if the key is new."""
    if state.exists:
        return
    best = None
    for pdf in batches:
        for order, row in zip(pdf["_order"], pdf["_row"], strict=True):
            at = _order_key(order)
            if best is None or at < best[0]:
                best = at, row
    state.update((True,))
    yield pd.DataFrame({"_row": [best[1]]})


def dedupe_stream(replies: DataFrame, key, order, out: str, checkpoint: str) -> object:
    """First-seen dedupe of an incoming stream (T1). In a batch the row that
    is first by ``order`` stays for each key, and keys of earlier batches are
    left out, however old they are. What has been seen is one flag for each
    key's digest in Spark's state store (RocksDB, if the session sets that
    provider), so a batch looks up its own keys and reads no earlier rows.
    Whole rows are written to ``out`` with ``question_key``, through the file
    sink. Rows without a key are not written; ``order`` should be unique. A
    key's rows of one batch pass one task as a stream; ``maxFilesPerTrigger``
    bounds them."""
    ship_package(replies.sparkSession)
    keyed = replies.withColumn("question_key", key).where("question_key is not null")
    carried = keyed.select(
        F.sha2("question_key", 256).alias("_digest"),
        F.to_json(F.struct(*order), {**_JSON, "ignoreNullFields": "false"}).alias("_order"),
        F.to_json(F.struct(*keyed.columns), _JSON).alias("_row"),
    )
    fresh = carried.groupBy("_digest").applyInPandasWithState(_first_unseen, "_row string", "seen boolean", "append", GroupStateTimeout.NoTimeout)
    rows = fresh.select(F.from_json("_row", keyed.schema, _JSON).alias("_r")).select("_r.*")
    return run_to_parquet(rows, out, checkpoint)


# --- T2 / T3 -----------------------------------------------------------------------

def load_stream(calls: DataFrame, ts: str = "ts", width: str = "60 minutes", slide: str = "10 minutes",
                delay: str = "2 hours") -> DataFrame:
    """Sliding-window call count and token sum (T2). Run it in update mode:
    the watermark evicts finished windows, so state stays bounded by the
    windows still open (``latest_per_key`` on ``w`` gives final values)."""
    return calls.withWatermark(ts, delay).groupBy(F.window(ts, width, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n_calls"), F.sum("tokens").alias("tokens"))


def metrics_stream(scores: DataFrame, threshold: float = 0.7, by=("run", "metric")) -> DataFrame:
    """Running mean, pass rate and count per metric as scores arrive."""
    s = F.col("score")
    return scores.where(s.isNotNull()).groupBy(*by).agg(
        F.avg(s).alias("avg_score"),
        F.avg(F.when(s >= F.lit(float(threshold)), F.lit(1.0)).otherwise(F.lit(0.0))).alias("pass_rate"),
        F.count(s).alias("n"),
    )


# --- T5 ------------------------------------------------------------------------------

def latest_per_key(updates: DataFrame, key: str = "user_id") -> DataFrame:
    """Current value per key from an update-mode sink: the row of the last
    batch that touched the key (a partial ``max_by`` aggregate)."""
    cols = [c for c in updates.columns if c not in (key, "batch_id")]
    last = updates.groupBy(key).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("r"))
    return last.select(key, *[F.col(f"r.{c}").alias(c) for c in cols])


def batch_streaks(rounds: DataFrame, key: str, order: list) -> DataFrame:
    """Streaks of empty rounds of one batch, per key: ``n`` rounds, the
    streak it opens with (``head``), the one it ends with (``tail``) and its
    longest. Islands are numbered by a running sum over ranges, so rounds of
    one hot key are spread over many tasks; the rest is aggregation."""
    flagged = rounds.select(key, *order, "empty", F.when(F.col("empty"), 0).otherwise(1).alias("_ne"))
    runs = running_sums(flagged, [key, *order], {"_island": "_ne"}).groupBy(key, "_island").agg(
        F.count_if("empty").alias("_len"), F.count(F.lit(1)).alias("_rows"))
    # an island opens with its non-empty round, but for a key's first rounds
    opens = F.min_by(F.struct("_len", "_rows"), "_island")
    return runs.groupBy(key).agg(
        F.sum("_rows").alias("n"),
        opens.alias("_first"),
        F.max_by("_len", "_island").alias("tail"),
        F.max("_len").alias("longest"),
    ).select(key, "n", F.when(F.col("_first._len") == F.col("_first._rows"), F.col("_first._len")).otherwise(F.lit(0)).alias("head"),
             "tail", "longest")


_STREAK = ["n", "head", "tail", "longest"]


def merged_streaks(parts: DataFrame, key: str) -> DataFrame:
    """Streaks of one key over following parts (``seq`` gives their order):
    ``n`` rounds, ``head``, ``tail`` and ``longest`` of two parts give those of
    both, so parts merge in any grouping. ``seq`` is that of the last part."""
    def both(a, b):
        return F.struct(
            (a["n"] + b["n"]).alias("n"),
            F.when(a["head"] == a["n"], a["n"] + b["head"]).otherwise(a["head"]).alias("head"),
            F.when(b["tail"] == b["n"], a["tail"] + b["n"]).otherwise(b["tail"]).alias("tail"),
            F.greatest(a["longest"], b["longest"], a["tail"] + b["head"]).alias("longest"),
        )

    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in _STREAK])
    row = F.struct("seq", *[F.col(c).cast("long").alias(c) for c in _STREAK])
    own = parts.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("p"), F.max("seq").alias("seq"))
    return own.select(key, "seq", F.aggregate("p", none, both).alias("m")).select(key, "seq", "m.*")


def stall_stream(rounds: DataFrame, order: list, out: str, checkpoint: str, key: str = "user_id",
                 stall_after: int = 80, compact_every: int = 8) -> object:
    """Current and longest run of empty rounds per key (T5), written for the
    keys of each batch; read with ``latest_per_key``. Batches follow each
    other in ``order``.

    A batch's streaks are a part of their own in ``<out>_state``; every
    ``compact_every`` batches the parts are merged into a snapshot with one
    row a key. A batch reads the last snapshot and at most
    ``compact_every - 1`` parts, whatever came before. Which ones follows from
    its number, so a batch that is run again writes the same rows again."""
    spark = rounds.sparkSession
    state = f"{out.rstrip('/')}_state"
    schema = StructType([rounds.schema[key], *[StructField(c, LongType()) for c in _STREAK]])

    def read(folder: str, seq: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{state}/{folder}={seq}").withColumn("seq", F.lit(seq))

    def step(batch: DataFrame, epoch: int) -> DataFrame:
        batch_streaks(batch, key, order).select(*schema.names).write.mode("overwrite").parquet(f"{state}/part={epoch}")
        compacted = epoch // compact_every * compact_every - 1
        held = [read("part", seq) for seq in range(compacted + 1, epoch + 1)]
        if compacted >= 0:
            held.append(read("snapshot", compacted))
        now = merged_streaks(reduce(DataFrame.unionByName, held), key)
        if (epoch + 1) % compact_every == 0:
            now.select(*schema.names).write.mode("overwrite").parquet(f"{state}/snapshot={epoch}")
        touched = now.where(F.col("seq") == epoch)
        return touched.select(key, "longest", F.col("tail").alias("current"), (F.col("longest") >= stall_after).alias("stalled"))

    return run_batches(rounds, step, out, checkpoint)


# --- T6 ------------------------------------------------------------------------------

def late_stream(rows: DataFrame, out: str, checkpoint: str, ts: str = "ts", width_s: int = 3600, delay_s: int = 3600) -> object:
    """Rows with ``late`` (T6): a row is late if its window had ended by the
    watermark, the latest time of all earlier batches less the delay. Both
    kinds are kept, as ``out/batch_id=<n>/late=<true or false>``. The latest
    time, observed while a batch is written, goes to a log with a row for each
    batch (``<out>_state``) that carries it on, so a batch reads the entry
    before its own and no earlier rows. A batch that is run again overwrites
    its own folders. Rows without a time are never late."""
    spark = rows.sparkSession
    log = f"{out.rstrip('/')}_state/watermark"

    def write(batch: DataFrame, epoch: int) -> None:
        before = spark.read.schema("latest_us long").json(f"{log}={epoch - 1}").first()["latest_us"] if epoch else None
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        end = (F.floor(us / F.lit(width_s * 1_000_000)) + 1) * F.lit(width_s * 1_000_000)  # of the row's window
        mark = None if before is None else before - delay_s * 1_000_000
        marked = batch.withColumn("_end", end).withColumn("late", F.coalesce(F.col("_end") <= F.lit(mark).cast("long"), F.lit(False)))
        seen = Observation(f"late-{epoch}")
        marked.drop("_end").observe(seen, F.max(us).alias("latest")).write.mode("overwrite").partitionBy("late").parquet(f"{out}/batch_id={epoch}")
        latest = max((x for x in (before, seen.get["latest"]) if x is not None), default=None)
        entry = spark.createDataFrame([(latest,)], "latest_us long")
        entry.coalesce(1).write.mode("overwrite").json(f"{log}={epoch}")

    q = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    return q


def read_marked(spark: SparkSession, out: str) -> DataFrame:
    """Rows that ``late_stream`` has written, ``late`` as a boolean; a filter
    on it prunes the folders of the other kind."""
    return spark.read.parquet(out).withColumn("late", F.col("late") == "true")


# --- helpers for the registered queries -------------------------------------------

def question_key(text_col: str = "text"):
    return normalize_question(F.col(text_col))
