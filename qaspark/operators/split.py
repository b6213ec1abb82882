"""Stratified splits, seeded shuffles and samples.

Seeded order (N2): rows are ranked by ``md5(seed|id)`` with ties broken by
``id``. This is deterministic, independent of partitioning and equal in
Spark and DuckDB, unlike ``rand(seed)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaspark.functions.text import normalize_question

# Quotas per category and the split names, in fill order.
DEFAULT_QUOTAS = (("golden_eval", 6), ("validation", 5), ("train", 27))
DEFAULT_SEED = 42


def seeded_key(id_col: str = "id", seed: int = DEFAULT_SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))


def _rank_in_group(df: DataFrame, by: str, id_col: str, seed: int) -> Column:
    w = Window.partitionBy(by).orderBy(seeded_key(id_col, seed), F.col(id_col))
    return F.row_number().over(w)


def _group_limit_threshold(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def _rank_by_prefix(df: DataFrame, by: str, id_col: str, seed: int) -> DataFrame:
    """Rank inside each group without a per-group window: a global position
    in (group, seeded key, id) order from range-partitioned prefix counts,
    minus the position where the group starts (a partial ``min``
    aggregate per group). A group holding a third of the rows is spread
    over many ranges."""
    from qaspark.operators.order import running_sums

    keyed = df.withColumn("_qs_key", seeded_key(id_col, seed)).withColumn("_qs_one", F.lit(1))
    pos = running_sums(keyed, [by, "_qs_key", id_col], {"_qs_pos": "_qs_one"})
    start = pos.groupBy(by).agg(F.min("_qs_pos").alias("_qs_start"))
    start = start.withColumnRenamed(by, "_qs_by")
    ranked = pos.join(start, pos[by].eqNullSafe(start["_qs_by"])).drop("_qs_by").withColumn("rank", F.col("_qs_pos") - F.col("_qs_start") + 1)
    return ranked.drop("_qs_key", "_qs_one", "_qs_pos", "_qs_start")


def balanced_sample(df: DataFrame, by: str = "category", id_col: str = "id", per_group: int = 38,
                    seed: int = DEFAULT_SEED) -> DataFrame:
    """First ``per_group`` rows of each group in seeded order (W1). Up to the
    optimizer's group-limit threshold the ``rank <= n`` filter lets Catalyst
    insert a WindowGroupLimit before the shuffle, so a hot group ships at
    most ``n`` rows per map task; above it the rank comes from prefix
    counts (no single-task window)."""
    if per_group > _group_limit_threshold(df):
        ranked = _rank_by_prefix(df, by, id_col, seed)
    else:
        ranked = df.withColumn("rank", _rank_in_group(df, by, id_col, seed))
    return ranked.where(F.col("rank") <= per_group).withColumn("rank", F.col("rank").cast("long"))


def stratified_split(df: DataFrame, by: str = "category", id_col: str = "id", quotas=DEFAULT_QUOTAS,
                     seed: int = DEFAULT_SEED) -> DataFrame:
    """Quota slices per group in fill order golden, validation, train.
    A short group fills the earlier splits first; rows past the total quota
    are left out (see ``unused_rows``)."""
    total = sum(q for _, q in quotas)
    ranked = balanced_sample(df, by, id_col, total, seed)
    label, upper = None, 0
    for name, q in quotas:
        upper += q
        cond = F.col("rank") <= upper
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    return ranked.withColumn("split", label)


def split_sizes(split_df: DataFrame) -> DataFrame:
    """Rows per split."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_audit(df: DataFrame, split_df: DataFrame, by: str = "category", quotas=DEFAULT_QUOTAS) -> DataFrame:
    """Rows per group and split against the quota (A10). Groups are taken
    from the input, so a group with no row in some split still shows up
    with ``n = 0`` and its shortfall."""
    groups = df.select(by).distinct()
    counts = split_df.groupBy(by, "split").agg(F.count(F.lit(1)).alias("n"))
    # every (group, split) pair: explode a literal list of the fixed splits
    names = F.array(*[F.struct(F.lit(n).alias("split"), F.lit(q).cast("long").alias("quota")) for n, q in quotas])
    grid = groups.select(by, F.explode(names).alias("q")).select(by, "q.split", "q.quota")
    counts = counts.select(F.col(by).alias("_qs_by"), F.col("split").alias("_qs_split"), "n")
    same = grid[by].eqNullSafe(counts["_qs_by"]) & (grid["split"] == counts["_qs_split"])
    out = grid.join(counts, same, "left").select(
        by, "split", "quota", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")
    )
    return out.withColumn("shortfall", (F.col("quota") - F.col("n")).cast("long"))


def seeded_shuffle(df: DataFrame, id_col: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """Seeded shuffle (L1). The order is materialised as a ``shuffle_rank``
    column via the range-based reindex, so no single-partition sort."""
    from qaspark.operators.order import reindex

    keyed = df.withColumn("_qs_key", seeded_key(id_col, seed))
    return reindex(keyed, ["_qs_key", id_col], "shuffle_rank").drop("_qs_key")


def eval_sample(df: DataFrame, n: int, id_col: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """``n`` rows without replacement, all rows if there are fewer (L2): the
    first ones in seeded order. The bound is found by histograms over the
    seeded key's first 60 bits, and the rows are filtered, not sorted."""
    from qaspark.operators.select import first_rows

    key = F.conv(F.substring(seeded_key(id_col, seed), 1, 15), 16, 10).cast("long")
    return first_rows(df, n, key, [seeded_key(id_col, seed), F.col(id_col)])


def split_leakage(split_df: DataFrame, held_out: str = "golden_eval", train: str = "train",
                  question: str = "question") -> DataFrame:
    """Held-out rows whose normalised question also appears in train."""
    key = normalize_question(question)
    held = split_df.where(F.col("split") == held_out).withColumn("_qs_q", key)
    trn = split_df.where(F.col("split") == train).select(key.alias("_qs_q"))
    return held.join(trn, "_qs_q", "left_semi").drop("_qs_q")


def unused_rows(df: DataFrame, split_df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows that landed in no split."""
    return df.join(split_df.select(id_col), id_col, "left_anti")
