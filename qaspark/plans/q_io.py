"""Queries: readers, writers and small text functions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.functions import text as T
from qaspark.operators import split as S
from qaspark.plans import derived as D
from qaspark.plans.registry import register
from qaspark.plans.sqltext import ANSWERS, QA, QA_DOCS, SCORE_LOG, split_cte, strip, with_
from qaspark.session import scratch_path
from qaspark.sources import io as IO
from qaspark.sources import json_array as JA
from qaspark.sources.tables import load


@register("read_json_array", with_(QA) + "select id, category, question, answer from qa")
def read_json_array(spark, sf_dir):
    path = scratch_path(spark, "json-array")
    IO.write_json_array(D.qa(spark, sf_dir), path)
    return IO.read_json_array(spark, path)


@register(
    "read_json_array_ranges",
    "select doc_id, source, '\"}, {[' || text || '\\\" }]' as question, n_chars as n, '}' as tag_0, lang as tag_1 from documents",
)
def read_json_array_ranges(spark, sf_dir):
    """JSON array files of all documents, each of several byte ranges and no
    more than a task can write, with nested objects and with braces, quotes
    and backslashes in strings, read by byte ranges."""
    path = scratch_path(spark, "json-array")
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", "source", F.concat(F.lit('"}, {['), "text", F.lit('\\" }]')).alias("question"),
        F.struct(F.col("n_chars").alias("n"), F.array(F.lit("}"), "lang").alias("tags")).alias("meta"))
    IO.write_json_array(docs, path, file_bytes=IO.ARRAY_FILE_BYTES)
    rows = JA.read_json_array_ranges(spark, path, docs.schema)
    return rows.select("doc_id", "source", "question", "meta.n", F.col("meta.tags")[0].alias("tag_0"), F.col("meta.tags")[1].alias("tag_1"))


@register(
    "flatten_lists",
    with_(QA) + "select id, category || ' None ' || cast(id as varchar) as tags, question as words, "
    "'True False' as flags from qa",
)
def flatten_lists(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    lists = qa.select(
        "id",
        F.array(F.col("category"), F.lit(None).cast("string"), F.col("id").cast("string")).alias("tags"),
        F.split(F.col("question"), " ").alias("words"),
        F.array(F.lit(True), F.lit(False)).alias("flags"),
    )
    return T.flatten_lists(lists)


@register(
    "to_text",
    with_(QA) + f"select id, {strip('question')} || chr(10) || {strip('answer')} as text, '' as empty from qa",
)
def to_text(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    arr = F.array(F.concat(F.col("question"), F.lit("  ")), F.lit(None).cast("string"), F.lit(""),
                  F.concat(F.lit(" "), F.col("answer")))
    df = qa.select("id", arr.alias("ctx"), F.lit(None).cast("string").alias("missing"))
    return df.select(
        "id",
        T.to_text("ctx", df.schema["ctx"].dataType).alias("text"),
        T.to_text("missing", df.schema["missing"].dataType).alias("empty"),
    )


@register(
    "case_prefix",
    with_(QA) + "select id, substring(question, 1, 100) as q100, substring(question, 1, 150) as q150, "
    "substring(answer, 1, 180) as a180 from qa",
)
def case_prefix(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    return qa.select("id", T.prefix("question", 100).alias("q100"), T.prefix("question", 150).alias("q150"),
                     T.prefix("answer", 180).alias("a180"))


_FLAG_TEXT = {"click": " Yes ", "view": "TRUE\n", "signup": "0", "error": "no", "purchase": "\ty"}


@register(
    "parse_flag",
    "select event_id, event_type in ('click', 'view', 'purchase') as flag from events",
)
def parse_flag(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    text = None
    for k, v in _FLAG_TEXT.items():
        text = F.when(F.col("event_type") == k, F.lit(v)) if text is None else text.when(F.col("event_type") == k, F.lit(v))
    return ev.select("event_id", T.parse_flag(text).alias("flag"))


_SPLIT = with_(QA_DOCS, split_cte("qa_docs"))


@register("write_splits", _SPLIT + "select id, category, split from split_rows")
def write_splits(spark, sf_dir):
    path = scratch_path(spark, "splits")
    IO.write_splits(S.stratified_split(D.qa_docs(spark, sf_dir)).select("id", "category", "split"), path)
    return spark.read.parquet(path).select("id", "category", "split")


@register("read_split", _SPLIT + "select id, category from split_rows where split = 'validation'")
def read_split(spark, sf_dir):
    path = scratch_path(spark, "splits")
    IO.write_splits(S.stratified_split(D.qa_docs(spark, sf_dir)).select("id", "category", "split"), path)
    return IO.read_split(spark, path, "validation").select("id", "category")


_ANS_SCHEMA = "idx bigint, question string, expected_answer string, generated_answer string, context string"


@register(
    "write_answers",
    with_(QA, ANSWERS) + "select idx, question, expected_answer, generated_answer, context from answers",
)
def write_answers(spark, sf_dir):
    path = scratch_path(spark, "answers")
    ans = D.answers(spark, sf_dir).select("idx", "question", "expected_answer", "generated_answer", "context")
    IO.write_rows(ans.withColumn("generated_answer", F.lit("draft")), path)
    IO.write_rows(ans, path)  # the second write replaces the first
    return IO.read_rows(spark, path, _ANS_SCHEMA)


@register(
    "append_checkpoint",
    with_(SCORE_LOG) + "select idx, metric, score from score_log",
)
def append_checkpoint(spark, sf_dir):
    path = scratch_path(spark, "checkpoint")
    log = D.score_log(spark, sf_dir).withColumn("scores", F.create_map("metric", "score"))
    log = log.withColumn("question", F.concat(F.lit("case "), F.col("idx").cast("string")))
    for commit, run in ((1, "baseline"), (2, "finetuned"), (2, "finetuned")):  # the last batch is run again
        IO.append_checkpoint(IO.checkpoint_lines(log.where(F.col("run") == run)), path, commit)
    entries = IO.read_checkpoint(spark, path, duplicates="count")
    return entries.select("idx", F.explode("scores").alias("metric", "score"))


# Hand-written checkpoint lines (N6): malformed, truncated, no idx, null
# scores, mixed score types, the same idx again with and without a write time.
BAD_LINES = (
    "not json",
    '{"idx": 5, "scores": {"A": 0.',
    '{"scores": {"A": 1.0}}',
    '{"idx": 2, "scores": null}',
    '{"idx": 4, "scores": {"A": 0.5, "B": "0.5", "C": null, "D": true}}',
    '{"idx": 7, "scores": {"A": 0.9}, "written_at": "2024-01-02T00:00:00"}',
    '{"idx": 7, "scores": {"A": 0.1}, "written_at": "2024-01-01T00:00:00"}',
    '{"idx": 9, "scores": {"A": 0.2}}',
    '{"idx": 9, "scores": {"A": 0.3}}',
)


@register(
    "read_checkpoint",
    with_(SCORE_LOG) + """select idx, metric, score from score_log where idx not in (2, 4, 7, 9)
union all select * from (values (2, null, null), (4, 'A', 0.5), (4, 'D', 1.0), (7, 'A', 0.9), (9, 'A', 0.3)) v(idx, metric, score)""",
)
def read_checkpoint(spark, sf_dir):
    """The whole score log, written twice as in a run that starts anew, then
    lines that name some of its cases again; the last line of a case wins,
    and a commit run again leaves one copy."""
    path = scratch_path(spark, "checkpoint")
    log = D.score_log(spark, sf_dir).select("idx", F.col("metric").alias("question"), F.col("metric"), F.col("score"))
    early = log.withColumn("scores", F.create_map("metric", F.lit(-1.0)))
    final = log.withColumn("scores", F.create_map("metric", "score"))
    bad = spark.createDataFrame([(s,) for s in BAD_LINES], "value string").coalesce(1)
    for commit, lines in enumerate((IO.checkpoint_lines(early), IO.checkpoint_lines(final), bad)):
        IO.append_checkpoint(lines, path, commit)
    IO.append_checkpoint(bad, path, 2)
    return IO.read_checkpoint(spark, path).select("idx", F.explode_outer("scores").alias("metric", "score"))


@register("require_columns", with_(QA) + "select id, category from qa")
def require_columns(spark, sf_dir):
    qa = IO.require_columns(D.qa(spark, sf_dir), "id", "category", "question", "answer")
    qa = IO.require_rows(qa, F.col("question").isNotNull() & F.col("answer").isNotNull(), "question or answer is null")
    return qa.select("id", "category")
