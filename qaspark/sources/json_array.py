"""A big JSON array file, read by many tasks.

Spark's JSON reader takes a file that holds one array as one document, in
one task. Here the file is read as text with ``}`` as the line separator, so
its byte ranges go to as many tasks as for any text file. Whether a piece
between two braces ends a row depends on what stands before it: is it inside
a string, and how deep. Both compose over pieces, so every chunk of a byte
range (a bounded number of pieces, dealt over the tasks) is summed up for
either state it may begin in, the sums of earlier chunks of a file give the
state it does begin in (one row for each chunk), and the pieces are judged
with it. Rows that consist of one piece are parsed where they are;
only the pieces of others (nested objects, braces inside strings) are
shuffled to be put together.

Built-in functions only. A file that holds one object, or objects one after
another, is read as those rows. Elements that aren't objects are left out, a
malformed row gives null columns, a file cut off in a row loses that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qaspark.operators.order import BROADCAST_RANGES
from qaspark.session import ensure_checkpoint_dir

_RANGE = ["_file", "_start", "_chunk"]
# Pieces of a chunk are two to this power.
CHUNK_POWER = 14


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between closing braces, in file order by ``_start, _row``."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value").alias("_text"),
    ).withColumn("_chunk", F.shiftright("_row", CHUNK_POWER))


def _opened(text: Column) -> Column:
    """Brackets opened less closed; a piece holds no closing brace."""
    return F.length(text) - F.length(F.translate(text, "{[", "")) - (F.length(text) - F.length(F.translate(text, "]", "")))


def _with_states(pieces: DataFrame) -> DataFrame:
    """Per piece: quotes, and brackets outside strings if it begins outside
    (``_d0``) or inside (``_d1``) one."""
    parts = F.split(F.regexp_replace("_text", r"(?s)\\.", ""), '"')
    parted = pieces.withColumn("_parts", parts)
    even = F.array_join(F.filter("_parts", lambda x, i: i % 2 == 0), " ")
    odd = F.array_join(F.filter("_parts", lambda x, i: i % 2 == 1), " ")
    rows = parted.select(*pieces.columns, (F.size("_parts") - 1).alias("_quotes"), _opened(even).alias("_d0"), _opened(odd).alias("_d1"))
    before = Window.partitionBy(*_RANGE).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_rel", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2)


def _change(inside: Column) -> Column:
    """Change of depth over a piece and its closing brace."""
    return F.when(inside == 0, F.col("_d0")).otherwise(F.col("_d1")) - F.when((inside + F.col("_quotes")) % 2 == 0, 1).otherwise(0)


def _join_ranges(rows: DataFrame, table: DataFrame, n_ranges: int) -> DataFrame:
    return rows.join(F.broadcast(table) if n_ranges <= BROADCAST_RANGES else table, _RANGE)


def _judged(rows: DataFrame) -> DataFrame:
    """Pieces with ``_ends`` (closes a row), ``_alone`` (is a row by itself)
    and ``_el``, the number of rows of the file that end before it."""
    sums = rows.groupBy(*_RANGE).agg(
        (F.sum("_quotes") % 2).alias("_q"),
        F.sum(_change(F.col("_rel"))).alias("_e0"),
        F.sum(_change(1 - F.col("_rel"))).alias("_e1"),
        F.min_by(F.regexp_substr("_text", F.lit(r"[^\s﻿]")), "_row").alias("_mark"),
    ).checkpoint(eager=True)
    n_ranges = sums.count()
    earlier = Window.partitionBy("_file").orderBy("_start", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file").orderBy("_start", "_chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    state = sums.withColumn("_in", F.coalesce(F.sum("_q").over(earlier), F.lit(0)) % 2)
    state = state.withColumn("_e", F.when(F.col("_in") == 0, F.col("_e0")).otherwise(F.col("_e1")))
    state = state.select(*_RANGE, "_in", F.coalesce(F.sum("_e").over(earlier), F.lit(0)).alias("_depth"),
                         F.when(F.first("_mark").over(whole) == "[", 1).otherwise(0).alias("_base"))
    own = _join_ranges(rows, state, n_ranges)
    inside = (F.col("_rel") + F.col("_in")) % 2
    before = Window.partitionBy(*_RANGE).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("_change", _change(inside)).withColumn("_at", F.col("_depth") + F.coalesce(F.sum("_change").over(before), F.lit(0)))
    ends = ((inside + F.col("_quotes")) % 2 == 0) & (F.col("_at") + F.col("_change") == F.col("_base"))
    own = own.withColumn("_ends", ends).withColumn("_alone", ends & (F.col("_at") <= F.col("_base")))
    own = own.withColumn("_upto", F.coalesce(F.sum(F.col("_ends").cast("long")).over(before), F.lit(0)))
    own = own.select(*_RANGE, "_row", "_text", "_ends", "_alone", "_upto")
    counts = own.groupBy(*_RANGE).agg(F.sum(F.col("_ends").cast("long")).alias("_n"))
    offset = counts.select(*_RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return _join_ranges(own, offset, n_ranges).withColumn("_el", F.col("_off") + F.col("_upto"))


def read_json_array_ranges(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of the JSON array files at ``path``, each file read by a task for
    each of its byte ranges (``spark.sql.files.maxPartitionBytes``)."""
    ensure_checkpoint_dir(spark)
    judged = _judged(_with_states(_pieces(spark, path).checkpoint(eager=True)))
    alone = judged.where("_alone").select(F.concat("_text", F.lit("}")).alias("_json"))
    several = judged.where("not _alone").groupBy("_file", "_el").agg(
        F.array_sort(F.collect_list(F.struct("_start", "_row", "_text"))).alias("_p"), F.max("_ends").alias("_whole"))
    joined = several.where("_whole").select(F.concat(F.array_join(F.col("_p._text"), "}"), F.lit("}")).alias("_json"))
    text = F.regexp_replace("_json", r"^[^{]*", "")
    return alone.unionByName(joined).select(F.from_json(text, schema).alias("_r")).select("_r.*")
