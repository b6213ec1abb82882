"""Building a corpus from model replies.

Validation keeps rejects as rows with a reason instead of dropping them
silently, so ``reject_reasons`` is an ordinary aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from qaspark.functions.replies import _is_object, extract_items, field_text, repeated_keys, strict_json
from qaspark.functions.text import normalize_question, strip_fence
from qaspark.operators.order import reindex
from qaspark.operators.select import first_rows


def reply_items(df: DataFrame, raw: str = "raw", keep=("id", "requested_category")) -> DataFrame:
    """One row per reply element (or one row with a null item for a reply
    that yields nothing): ``keep..., item_pos, item, reason``; ``reason`` is
    null for a usable item."""
    # parse once per reply in its own projection, then branch on the result
    text = df.select(*keep, strip_fence(raw).alias("_qs_text"))
    with repeated_keys(df.sparkSession):
        parsed = text.select(*keep, "_qs_text", strict_json("_qs_text").alias("_qs_v0"))
        items = parsed.select(*keep, F.posexplode_outer(extract_items("_qs_text", "_qs_v0")).alias("item_pos", "item"))
    fields = items.select(
        *keep,
        F.col("item_pos").cast("long").alias("item_pos"),
        F.col("item").isNull().alias("_qs_none"),
        _is_object(F.col("item")).alias("_qs_obj"),
        field_text(F.col("item"), "category").alias("item_category"),
        field_text(F.col("item"), "question").alias("question_raw"),
        field_text(F.col("item"), "answer").alias("answer"),
    )
    reason = (
        F.when(F.col("_qs_none"), F.lit("no_items"))
        .when(~F.col("_qs_obj"), F.lit("not_object"))
        .when(F.col("question_raw").isNull(), F.lit("missing_question"))
        .when(F.col("answer").isNull(), F.lit("missing_answer"))
        .when(normalize_question("question_raw") == F.lit(""), F.lit("blank_question"))
    )
    return fields.select(*keep, "item_pos", "item_category", "question_raw", "answer", reason.alias("reason"))


def resolve_category(item_category, requested, categories) -> Column:
    """Item's category if it is a known one, else the requested one (P5).
    ``categories`` is a small fixed list, inlined as a literal set."""
    c = F.col(item_category) if isinstance(item_category, str) else item_category
    r = F.col(requested) if isinstance(requested, str) else requested
    return F.when(c.isin(*categories), c).otherwise(r)


def valid_rows(items: DataFrame, categories, requested: str = "requested_category") -> DataFrame:
    """Usable items with stripped question and resolved category."""
    ok = items.where(F.col("reason").isNull())
    return ok.select(
        *[c for c in ok.columns if c not in ("item_category", "question_raw", "answer", "reason", requested)],
        resolve_category("item_category", requested, categories).alias("category"),
        normalize_question("question_raw").alias("question"),
        "answer",
    )


def reject_reasons(items: DataFrame) -> DataFrame:
    return items.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def dedupe_first(df: DataFrame, key: str = "question", order: str = "id", normalize: bool = True) -> DataFrame:
    """First row per key in ``order`` (W3): the smallest ``order`` per digest
    of the key in a hash aggregate (a key holding a third of the rows ships
    one slim row per task), then the rows that have it; equal rows count
    once. A null key is a key of its own."""
    k = normalize_question(key) if normalize else F.col(key)
    digest = F.coalesce(F.sha2(k.cast("string"), 256), F.lit(""))
    keyed = df.withColumn("_qs_key", digest)
    first = keyed.groupBy("_qs_key").agg(F.min(order).alias("_qs_first"))
    first = first.select(F.col("_qs_key").alias("_qs_k"), "_qs_first")
    same = (F.col("_qs_key") == F.col("_qs_k")) & F.col(order).eqNullSafe(F.col("_qs_first"))
    return keyed.join(first, same, "left_semi").dropDuplicates(["_qs_key"]).drop("_qs_key")


def new_questions(new: DataFrame, seen: DataFrame, key: str = "question") -> DataFrame:
    """Rows of ``new`` whose normalised question is not in ``seen``."""
    held = seen.select(normalize_question(key).alias("_qs_key"))
    return new.withColumn("_qs_key", normalize_question(key)).join(held, "_qs_key", "left_anti").drop("_qs_key")


def cap_to_target(df: DataFrame, target: int, order: str = "id") -> DataFrame:
    """First ``target`` rows in ``order`` (L5): by histograms and a filter if
    the order is a whole number, else by ranks over ranges."""
    if isinstance(df.schema[order].dataType, IntegralType):
        return first_rows(df, target, F.col(order), [F.col(order)])
    ranked = reindex(df, [order], "_qs_rank")
    return ranked.where(F.col("_qs_rank") <= target).drop("_qs_rank")


def merge_batches(*batches: DataFrame) -> DataFrame:
    """Append batches by column name."""
    return reduce(lambda a, b: a.unionByName(b), batches)


def top_up(held: DataFrame, candidates: DataFrame, target: int | None = None, key: str = "question",
           order: str = "id", extra: int | None = None) -> DataFrame:
    """Append new, unseen, first-seen candidates to the held corpus until
    ``target`` rows, or ``extra`` of them, then renumber ids 1..n (U2 = J2 +
    W3 + U1 + L5 + W4). Held rows come first and all stay; candidates follow
    in their own order."""
    if (target is None) == (extra is None):
        raise ValueError("give either target or extra")
    more = max(0, target - held.count()) if extra is None else extra
    fresh = cap_to_target(dedupe_first(new_questions(candidates, held, key), key, order), more, order)
    both = merge_batches(
        held.withColumn("_qs_src", F.lit(0)),
        fresh.select(*held.columns).withColumn("_qs_src", F.lit(1)),
    )
    ordered = both.withColumn("_qs_ord", F.struct("_qs_src", order)).drop(order)
    return reindex(ordered, ["_qs_ord"], order).drop("_qs_ord", "_qs_src").select(*held.columns)


def category_counts(df: DataFrame, by: str = "category") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def distinct_questions(df: DataFrame, key: str = "question") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(normalize_question(key)).alias("n_distinct"),
    )
