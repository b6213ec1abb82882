"""Relations derived from the supplied tables (schemas in FIXTURES.md).

Every function takes ``(spark, sf_dir)`` and builds its rows from the
supplied Parquet tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.operators.order import with_next
from qaspark.sources.tables import load, spread

# The cut-over between the two evaluation runs in score_log,
# and the 9 categories of conversation-derived Q&A rows.
RUN_CUTOVER = "2024-01-16 00:00:00"
N_QA_CATEGORIES = 9


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q&A rows: each user turn followed by an assistant turn.
    ``id bigint, category string, question string, answer string``."""
    conv = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    asked = (F.col("role") == "user") & (F.col("role_next") == "assistant")
    pairs = with_next(conv, ["conv_id"], ["turn"], ["role", "text"], keep=asked, id_col="id")
    return pairs.select(
        "id",
        F.concat(F.lit("cat"), (F.col("conv_id") % N_QA_CATEGORIES).cast("string")).alias("category"),
        F.col("text").alias("question"),
        F.col("text_next").alias("answer"),
    )


def qa_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q&A rows from documents: 20 equal categories, real duplicates."""
    return spread(load(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("category"),
        F.col("text").alias("question"),
        F.col("text").alias("answer"),
    )


def score_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long score table ``idx, run, metric, score``."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("idx"),
        F.when(F.col("ts") < F.lit(RUN_CUTOVER).cast("timestamp_ntz"), F.lit("baseline"))
        .otherwise(F.lit("finetuned"))
        .alias("run"),
        F.col("event_type").alias("metric"),
        F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).alias("score"),
    )


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge call log ``key, ts, tokens, event_id`` (ts as UTC timestamp)."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("key"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor(F.col("value") * F.lit(10.0)).cast("long").alias("tokens"),
        "event_id",
    )


def _item(category, question, answer=None):
    fields = [category.alias("category"), question.alias("question")]
    if answer is not None:
        fields.append(answer.alias("answer"))
    return F.to_json(F.struct(*fields))


def replies(spark: SparkSession, sf_dir: str, qa_df: DataFrame | None = None) -> DataFrame:
    """Model replies, one per Q&A row, shaped by ``id % 10`` (FIXTURES.md):
    ``id bigint, requested_category string, raw string``."""
    base = qa_df if qa_df is not None else qa(spark, sf_dir)
    cat, q, a = F.col("category"), F.col("question"), F.col("answer")
    item = _item(cat, q, a)
    k = F.col("id") % 10
    raw = (
        F.when(k == 0, F.concat(F.lit("["), item, F.lit("]")))
        .when(k == 1, F.concat(F.lit('{"n":1,"items":['), item, F.lit("]}")))
        .when(k == 2, item)
        .when(k == 3, F.concat(F.lit("```json\n["), item, F.lit("]\n```")))
        .when(k == 4, F.concat(F.lit("Sure, here: ["), item, F.lit("] hope it helps")))
        .when(k == 5, F.lit("not json"))
        .when(k == 6, F.concat(F.lit("["), item, F.lit(", "), item, F.lit("]")))
        .when(k == 7, F.concat(F.lit("["), _item(cat, q), F.lit("]")))
        .when(k == 8, F.concat(F.lit("["), _item(cat, F.concat(F.lit("\n\t"), q, F.lit(" ")), a), F.lit("]")))
        .otherwise(F.concat(F.lit("["), _item(F.lit("Unknown"), q, a), F.lit("]")))
    )
    return base.select("id", F.col("category").alias("requested_category"), raw.alias("raw"))


def lenient_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that only a lenient parser takes, one per Q&A row, shaped by
    ``id % 5``: a repeated key, ``NaN`` as a value, infinities beside strings
    that hold such words, an object whose list key comes again, and ``NaN``
    inside text around the array."""
    q, a = (F.substring(F.to_json(F.struct(F.col(c).alias("x"))), 6, 2**30) for c in ("question", "answer"))  # "..."}
    head = F.concat(F.lit('{"category":"'), F.col("category"), F.lit('","question":'))
    end = F.expr("'}'")
    q, a = (F.regexp_replace(x, r"\}$", "") for x in (q, a))
    item = F.concat(head, q, F.lit(',"answer":'), a, end)
    k = F.col("id") % 5
    raw = (
        F.when(k == 0, F.concat(F.lit('[{"category":"none","question":"first",'), F.substring(item, 2, 2**30), F.lit("]")))
        .when(k == 1, F.concat(F.lit("["), head, q, F.lit(',"answer":NaN}]')))
        .when(k == 2, F.concat(F.lit('{"n":[-Infinity,Infinity],"answer":"NaN, [NaN] \\" Infinity","question":'), q, F.lit("}")))
        .when(k == 3, F.concat(F.lit('{"items":[1],"rest":['), item, F.lit('],"items":NaN}')))
        .otherwise(F.concat(F.lit('It is NaN: [{"score":NaN,'), F.substring(item, 2, 2**30), F.lit("] or Infinity")))
    )
    return qa(spark, sf_dir).select("id", F.col("category").alias("requested_category"), raw.alias("raw"))


# The nine categories of the conversation-derived Q&A rows.
QA_CATEGORIES = tuple(f"cat{i}" for i in range(N_QA_CATEGORIES))


# Word separator for the answer cuts (explicit so Spark and DuckDB agree).
_WORD_SEP = "[ \t\n\r]+"


def answers(spark: SparkSession, sf_dir: str, qa_df: DataFrame | None = None, offset: int = 1) -> DataFrame:
    """Answer rows of two runs: ``idx`` (from 0), question, expected answer,
    a baseline answer (first third of the expected one, by words), a second-
    run answer (first two thirds) and an empty context."""
    from qaspark.functions.text import strip_ws

    base = qa_df if qa_df is not None else qa(spark, sf_dir)
    words = F.split(strip_ws("answer"), _WORD_SEP)
    n = F.size(words)
    return base.select(
        (F.col("id") - offset).alias("idx"),
        "category",
        "question",
        F.col("answer").alias("expected_answer"),
        F.array_join(F.slice(words, 1, F.floor(n / 3).cast("int")), " ").alias("generated_answer"),
        F.array_join(F.slice(words, 1, F.floor(n * 2 / 3).cast("int")), " ").alias("finetuned_answer"),
        F.lit("").alias("context"),
    )
