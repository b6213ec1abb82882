"""Mixing sources to target weights by hash thresholds.

Every document has a fixed 60-bit hash of its id. Words are summed by source
and hash bucket; in each source the bucket in which its budget ends is found
from the running sums of at most 1,024 buckets, and only that bucket is
divided again by the next ten bits, until one hash value is left. A document
is taken once more than the whole repeats of its source if its hash lies
under the source's threshold. No documents are sorted, and thresholds are
nested: a larger budget keeps what a smaller one took.

Defined cases: a null text has size 0; null sources form one source, last in
order; rows without an id are hashed by their text; rows with an equal hash
(repeated rows) are taken or left together, whichever comes nearer to the
target; empty tables give empty results; a source without words has target
0 and none of its rows is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaspark.llm.common import materialise, word_count
from qaspark.operators.order import reindex

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
HASH_BITS, LEVEL_BITS = 60, 10


def hash60(doc_id: Column, text: Column) -> Column:
    """First 15 hex digits of the MD5 of the id (of the text, if it's null)."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size``: the sources, in
    code point order with null last, weigh ``weights`` in turn and share the
    sum of all sizes; a share stops at ``cap`` times its source's size and
    the excess is shared again. Every round of sharing is one small
    aggregate; it ends when no further source reaches its cap."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = reindex(per, [F.col("source").asc_nulls_last()], "_rank", start=0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    per = materialise(ranked.withColumn("_w", weight).drop("_rank"), "sources")
    top = F.col("source_size") * cap
    total = per.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    rate, n_capped = 0.0, -1
    while True:
        over = top < F.lit(rate) * F.col("_w") if n_capped >= 0 else F.lit(False)
        row = per.agg(
            F.sum(F.when(over, 1).otherwise(0)).alias("n"),
            F.sum(F.when(over, top).otherwise(0)).alias("used"),
            F.sum(F.when(over, 0.0).otherwise(F.col("_w"))).alias("w"),
        ).first()
        if not row["w"] or row["n"] == n_capped:
            break
        n_capped, rate = row["n"], (total - row["used"]) / row["w"]
    return per.select("source", "source_size", F.least(top.cast("double"), F.lit(rate) * F.col("_w")).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``whole`` (repeats of every document) and ``cut`` (documents with
    a smaller hash are taken once more) to ``targets``."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("whole", whole).withColumn(
        "need", F.col("target") - F.col("whole") * F.col("source_size")
    )
    state = state.withColumns(
        {
            "prefix": F.lit(0).cast("long"),
            "before": F.lit(0).cast("long"),
            "cut": F.when(F.col("need") <= 0, F.lit(0)).cast("long"),
        }
    )
    state = materialise(state, "thresholds")
    names = state.columns
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        open_ = state.where("cut is null").select(F.col("source").alias("_s"), "prefix", "need", "before")
        if open_.isEmpty():
            break
        inside = sized.join(open_, sized.source.eqNullSafe(open_._s)).where(
            F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")
        )
        hist = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket"), "need", "before").agg(
            F.sum("size").alias("s"), F.min("hash").alias("lo"), F.max("hash").alias("hi")
        )
        run = hist.withColumn("upto", F.col("before") + F.sum("s").over(Window.partitionBy("source").orderBy("bucket")))
        edge = (
            run.where("upto > need")
            .groupBy("source")
            .agg(F.min_by(F.struct("bucket", "s", "lo", "hi", "upto"), "bucket").alias("e"))
            .select(F.col("source").alias("_s"), "e.*")
        )
        joined = state.join(edge, state.source.eqNullSafe(edge._s), "left")
        start = F.col("upto") - F.col("s")
        one = F.col("lo") == F.col("hi")
        nearer = F.col("upto") - F.col("need") < F.col("need") - start
        state = materialise(
            joined.select(
                "source", "source_size", "target", "whole", "need",
                F.coalesce("bucket", "prefix").alias("prefix"),
                F.coalesce(start, "before").cast("long").alias("before"),
                F.coalesce("cut", F.when(one, F.col("lo") + F.when(nearer, 1).otherwise(0))).alias("cut"),
            ).select(*names),
            "thresholds",
        )
    return state.select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        hash60(F.col("doc_id"), F.col("text")).alias("hash"),
    )


def _copies() -> Column:
    return F.col("whole") + F.when(F.col("hash") < F.col("cut"), 1).otherwise(0)


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row."""
    sized = materialise(_sized(docs), "sized")
    plan = thresholds(sized, source_targets(sized, weights, cap))
    plan = plan.withColumnRenamed("source", "_s")
    return sized.join(plan, sized.source.eqNullSafe(plan._s)).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken")
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, repeated as often as it takes
    them; columns unchanged. Texts without words are not taken."""
    sized = materialise(_sized(docs), "sized")
    plan = thresholds(sized, source_targets(sized, weights, cap))
    plan = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in ("source", "whole", "cut")])
    h = hash60(docs["doc_id"], docs["text"])
    copies = F.col("_mix_whole") + F.when(h < F.col("_mix_cut"), 1).otherwise(0)
    copies = F.when(F.coalesce(docs["text"], F.lit("")).rlike("[^ \\t-\\r]"), copies).otherwise(0)
    joined = docs.join(plan, docs["source"].eqNullSafe(plan["_mix_source"])).withColumn("_mix_n", copies.cast("int"))
    return joined.where("_mix_n > 0").select(
        *[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col("_mix_n"))).alias("_mix_i")
    ).drop("_mix_i")


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS w FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
    coalesce(sum(3 * source_size) OVER p, 0) AS used, coalesce(sum(w) OVER p, 0) AS gone,
    row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS k FROM r
    WINDOW p AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT min_by((total - used) / (all_w - gone), k) AS rate FROM o WHERE (total - used) / (all_w - gone) * w <= 3 * source_size),
t AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), rate * w) AS target FROM r, l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
    sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER (PARTITION BY d.source, h) AS own FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, source, size, source_size, target, CAST(size * (whole + CASE WHEN need > 0 AND
    (upto <= need OR (upto - own <= need AND upto - need < need - (upto - own))) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""
