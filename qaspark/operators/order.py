"""Order-dependent operators that must not collapse into one partition.

``row_number().over(Window.orderBy(...))`` without ``partitionBy`` moves the
whole table into a single task. The helpers here keep global order
semantics but split the work by range:

1. ``repartitionByRange`` on the order key (sampled bounds, one shuffle);
   a hot key value is spread over several ranges because the bounds are
   taken from the composite key.
2. Each row is tagged with its range number and its position in the
   sorted range; the tagged table is checkpointed to the shared folder so
   the tags stay fixed if an executor is lost and the plan is recomputed.
3. Per-range counts or sums become running totals over a table of one row
   per range, joined back by range number. Nothing per range goes through
   the driver or into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaspark.session import ensure_checkpoint_dir

_B, _P = "_qs_range", "_qs_inpos"

# The table of running totals has one row per range. Up to this many ranges
# (about 16 MB) it is broadcast; above it, it is joined by a shuffle.
BROADCAST_RANGES = 1_000_000


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in ([cols] if isinstance(cols, (str, Column)) else cols)]


def tag_ranges(df: DataFrame, order_cols, num_ranges: int | None = None) -> DataFrame:
    """Range-partition by ``order_cols``, sort each range, add the range
    number ``_qs_range`` and the position inside it ``_qs_inpos``;
    checkpoint. Without ``num_ranges`` there are as many ranges as
    ``spark.sql.shuffle.partitions``, of which AQE merges small neighbours."""
    ensure_checkpoint_dir(df.sparkSession)
    order = _cols(order_cols)
    ranged = df.repartitionByRange(int(num_ranges), *order) if num_ranges else df.repartitionByRange(*order)
    pid = F.spark_partition_id().cast("long")
    tagged = ranged.sortWithinPartitions(*order).withColumn(_B, pid)
    return tagged.withColumn(_P, F.monotonically_increasing_id() - F.shiftleft(pid, 33)).checkpoint(eager=True)


def add_totals(tagged: DataFrame, totals: dict) -> DataFrame:
    """Add, per output column, the sum of an aggregate over all earlier
    ranges (0 for the first)."""
    per = tagged.groupBy(_B).agg(*[agg.alias(name) for name, agg in totals.items()])
    earlier = Window.orderBy("_qs_r").rowsBetween(Window.unboundedPreceding, -1)
    table = per.withColumnRenamed(_B, "_qs_r").select(
        "_qs_r", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals]
    )
    if tagged.rdd.getNumPartitions() <= BROADCAST_RANGES:
        table = F.broadcast(table)
    return tagged.join(table, F.col(_B) == F.col("_qs_r"), "left").drop("_qs_r")


def reindex(df: DataFrame, order_cols, id_col: str = "id", start: int = 1, num_ranges: int | None = None) -> DataFrame:
    """Contiguous ids ``start, start+1, ...`` in the order of ``order_cols``
    (W4), without a single-partition window."""
    tagged = add_totals(tag_ranges(df, order_cols, num_ranges), {"_qs_off": F.count(F.lit(1))})
    out = tagged.withColumn(id_col, (F.col("_qs_off") + F.col(_P) + F.lit(start)).cast("long"))
    return out.drop(_B, _P, "_qs_off")


def running_sums(df: DataFrame, order_cols, sums: dict, num_ranges: int | None = None) -> DataFrame:
    """Global inclusive running sums in ``order_cols`` order (prefix sums in
    two passes). ``sums`` maps output column -> input column; the sum keeps
    the type Spark gives to a sum of the input, and nulls add nothing.
    Per-range running sums come from a window keyed by the range number
    (ranges are balanced by the range partitioner), plus the totals of
    earlier ranges."""
    tagged = tag_ranges(df, order_cols, num_ranges)
    w = Window.partitionBy(_B).orderBy(_P).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = add_totals(tagged, {f"_qs_off_{o}": F.sum(v) for o, v in sums.items()})
    for o, v in sums.items():
        out = out.withColumn(o, F.col(f"_qs_off_{o}") + F.coalesce(F.sum(v).over(w), F.lit(0)))
    return out.drop(_B, _P, *[f"_qs_off_{o}" for o in sums])


def with_next(df: DataFrame, partition_cols, order_cols, value_cols, suffix: str = "_next", keep: Column | None = None, id_col: str | None = None) -> DataFrame:
    """``lead(v) over (partition by p order by o)`` for every ``v`` in
    ``value_cols``, from one tagging: ``lead`` inside each range, and the
    first row of the next range for the last row of one. A partition key
    holding a third of the rows is spread over many ranges.

    With ``keep`` (a condition that may use the new columns) only those rows
    are returned, and ``id_col`` numbers them from 1 in the order of the
    partition and order columns, from per-range counts of the kept rows."""
    parts = list(partition_cols)
    tagged = tag_ranges(df, parts + list(order_cols))
    row = F.struct(*parts, *value_cols)
    firsts = tagged.where(F.col(_P) == 0).select(F.col(_B).alias("_qs_r"), row.alias("_qs_row"))
    after = firsts.select("_qs_r", F.lead("_qs_row").over(Window.orderBy("_qs_r")).alias("_qs_after"))
    w = Window.partitionBy(_B).orderBy(_P)
    inside = tagged.withColumn("_qs_lead", F.lead(row).over(w)).withColumn("_qs_end", F.lead(F.lit(1)).over(w).isNull())
    ends = inside.join(after, F.when(F.col("_qs_end"), F.col(_B)) == F.col("_qs_r"), "left")
    nxt = F.when(F.col("_qs_end"), F.col("_qs_after")).otherwise(F.col("_qs_lead"))
    same = F.lit(True)
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col("_qs_nxt")[p])
    joined = ends.withColumn("_qs_nxt", nxt).select(
        *df.columns, _B, _P, *[F.when(same & F.col("_qs_nxt").isNotNull(), F.col("_qs_nxt")[v]).alias(f"{v}{suffix}") for v in value_cols]
    )
    if keep is not None:
        joined = joined.where(keep)
    if id_col:
        joined = add_totals(joined, {"_qs_off": F.count(F.lit(1))})
        joined = joined.withColumn(id_col, (F.col("_qs_off") + F.row_number().over(w)).cast("long")).drop("_qs_off")
    return joined.drop(_B, _P)
