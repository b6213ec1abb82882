"""Queries: reply parsing, validation, dedupe, anti-joins, cap, top-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.functions import replies as R
from qaspark.functions import text as T
from qaspark.operators import corpus as C
from qaspark.operators import split as S
from qaspark.operators.order import reindex
from qaspark.plans import derived as D
from qaspark.plans.registry import register
from qaspark.plans.sqltext import QA, QA_DOCS, split_cte, strip, with_
from qaspark.sources.tables import load

# Expected reply elements, computed from ``qa`` by the shape rule, not by parsing.
_EXPECTED_ITEMS = """expected as (
  select id, cast(0 as bigint) as item_pos, category as item_category, category as requested_category,
         question as question_raw, answer from qa where id % 10 in (0, 1, 2, 3, 4, 6)
  union all select id, 1, category, category, question, answer from qa where id % 10 = 6
  union all select id, 0, category, category, question, null from qa where id % 10 = 7
  union all select id, 0, category, category, chr(10) || chr(9) || question || chr(160), answer from qa where id % 10 = 8
  union all select id, 0, 'Unknown', category, question, answer from qa where id % 10 = 9)"""


def _items(spark, sf_dir):
    return C.reply_items(D.replies(spark, sf_dir))


def _valid(spark, sf_dir):
    return C.valid_rows(_items(spark, sf_dir), D.QA_CATEGORIES)


@register(
    "extract_items",
    with_(QA, _EXPECTED_ITEMS) + "select id, item_pos, item_category, question_raw, answer from expected",
)
def extract_items(spark, sf_dir):
    return _items(spark, sf_dir).where(F.col("item_pos").isNotNull()).select(
        "id", "item_pos", "item_category", "question_raw", "answer"
    )


@register(
    "lenient_items",
    with_(QA) + """select id, cast(0 as bigint) as item_pos, category as item_category, question as question_raw,
       case when id % 5 = 1 then 'NaN' else answer end as answer from qa where id % 5 <> 2
union all select id, 0, null, null, null from qa where id % 5 = 2
union all select id, 1, null, null, null from qa where id % 5 = 2""",
)
def lenient_items(spark, sf_dir):
    """Items of replies with repeated keys and numbers that aren't finite; a
    reply's first list counts even if it holds no objects."""
    return C.reply_items(D.lenient_replies(spark, sf_dir)).select("id", "item_pos", "item_category", "question_raw", "answer")


@register(
    "valid_rows",
    with_(QA, _EXPECTED_ITEMS) + f"select id, item_pos, requested_category as category, {strip('question_raw')} "
    "as question, answer from expected where answer is not null",
)
def valid_rows(spark, sf_dir):
    return _valid(spark, sf_dir).select("id", "item_pos", "category", "question", "answer")


@register(
    "reject_reasons",
    with_(QA) + "select case when id % 10 = 5 then 'no_items' else 'missing_answer' end as reason, count(*) as n "
    "from qa where id % 10 in (5, 7) group by 1",
)
def reject_reasons(spark, sf_dir):
    return C.reject_reasons(_items(spark, sf_dir))


@register(
    "resolve_category",
    with_(QA, _EXPECTED_ITEMS) + "select id, item_pos, item_category, requested_category, "
    "case when item_category in ('cat0','cat1','cat2','cat3','cat4','cat5','cat6','cat7','cat8') "
    "then item_category else requested_category end as category from expected where answer is not null",
)
def resolve_category(spark, sf_dir):
    items = _items(spark, sf_dir).where(F.col("reason").isNull())
    return items.select(
        "id", "item_pos", "item_category", "requested_category",
        C.resolve_category("item_category", "requested_category", D.QA_CATEGORIES).alias("category"),
    )


@register(
    "strip_fence",
    with_(QA) + f"select id, {strip('question')} as text from qa",
)
def strip_fence(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    k = F.col("id") % 3
    raw = (
        F.when(k == 0, F.concat(F.lit("```json\n"), F.col("question"), F.lit("\n```")))
        .when(k == 1, F.concat(F.lit("  ```\n"), F.col("question"), F.lit("\n```\n")))
        .otherwise(F.concat(F.lit("\t"), F.col("question"), F.lit(" \n")))
    )
    return qa.select("id", T.strip_fence(raw).alias("text"))


@register(
    "reply_content",
    with_(QA) + "select id, case when id % 4 = 0 then '' else question end as content from qa",
)
def reply_content(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    msg = F.struct(F.struct(F.col("question").alias("content")).alias("message"))
    body = F.when(F.col("id") % 4 == 0, F.lit('{"choices":[]}')).otherwise(
        F.to_json(F.struct(F.array(msg).alias("choices")))
    )
    return qa.select("id", R.reply_content(body).alias("content"))


@register(
    "judge_reply_valid",
    "select event_id as idx, event_type in ('click', 'view') as valid from events",
)
def judge_reply_valid(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    body = F.format_string('{"score": %s, "reason": "ok"}', F.col("value") / 100)
    reply = (
        F.when(F.col("event_type") == "click", body)
        .when(F.col("event_type") == "view", F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(F.col("event_type") == "error", F.format_string('{"score": %s}', F.col("value") / 100))
        .when(F.col("event_type") == "signup", F.format_string('{"score": "%s", "reason": "ok"}', F.col("value")))
        .otherwise(F.format_string("score: %s", F.col("value")))
    )
    return ev.select(
        F.col("event_id").alias("idx"),
        R.judge_reply_valid(T.strip_fence(reply), {"score": "number", "reason": "string"}).alias("valid"),
    )


@register(
    "dedupe_first",
    with_(QA_DOCS) + f"select id, category, question from (select *, row_number() over "
    f"(partition by {strip('question')} order by id) as rn from qa_docs) d where rn = 1",
)
def dedupe_first(spark, sf_dir):
    return C.dedupe_first(D.qa_docs(spark, sf_dir).select("id", "category", "question"))


_HELD = "held as (select q.* from qa_docs q where q.id in (select doc_id from labels))"


@register(
    "new_questions",
    with_(QA_DOCS, _HELD) + f"select id, category from qa_docs c where not exists (select 1 from held h "
    f"where {strip('h.question')} = {strip('c.question')})",
)
def new_questions(spark, sf_dir):
    docs = D.qa_docs(spark, sf_dir)
    held = docs.join(load(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")), "id", "left_semi")
    return C.new_questions(docs, held).select("id", "category")


@register(
    "cap_to_target",
    with_(QA) + "select id, category from qa order by id limit 150",
)
def cap_to_target(spark, sf_dir):
    return C.cap_to_target(D.qa(spark, sf_dir), 150).select("id", "category")


@register(
    "reindex",
    "select o_orderkey, cast(row_number() over (order by o_orderdate, o_orderkey) as bigint) as new_id from orders",
)
def reindex_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return reindex(orders, ["o_orderdate", "o_orderkey"], "new_id").select("o_orderkey", "new_id")


@register(
    "merge_batches",
    with_(QA, QA_DOCS) + "select id, 'conversations' as batch, category from qa union all "
    "select id, 'documents', category from qa_docs",
)
def merge_batches(spark, sf_dir):
    a = D.qa(spark, sf_dir).select("id", F.lit("conversations").alias("batch"), "category")
    b = D.qa_docs(spark, sf_dir).select("id", F.lit("documents").alias("batch"), "category")
    return C.merge_batches(a, b)


_TOPUP_SHARE = 10  # a tenth of the candidates' number is added


@register(
    "top_up",
    with_(QA, QA_DOCS) + f"""
, fresh as (
  select * from (select *, row_number() over (partition by {strip('question')} order by id) as rn
                 from qa_docs c
                 where not exists (select 1 from qa h where {strip('h.question')} = {strip('c.question')})) f
  where rn = 1),
both_ as (select 0 as src, id, category, question, answer from qa
          union all select 1, id, category, question, answer
          from (select *, row_number() over (order by id) as nth from fresh) n
          where nth <= (select count(*) // {_TOPUP_SHARE} from qa_docs))
select cast(row_number() over (order by src, id) as bigint) as id, category, question from both_""",
)
def top_up(spark, sf_dir):
    held = D.qa(spark, sf_dir)
    docs = D.qa_docs(spark, sf_dir)
    return C.top_up(held, docs, extra=docs.count() // _TOPUP_SHARE).select("id", "category", "question")


@register(
    "unused_rows",
    with_(QA_DOCS, split_cte("qa_docs")) + "select id, category from qa_docs where id not in (select id from split_rows)",
)
def unused_rows(spark, sf_dir):
    docs = D.qa_docs(spark, sf_dir)
    return S.unused_rows(docs, S.stratified_split(docs)).select("id", "category")


@register(
    "category_counts",
    with_(QA) + "select category, count(*) as n from qa group by category",
)
def category_counts(spark, sf_dir):
    return C.category_counts(D.qa(spark, sf_dir))


@register(
    "distinct_questions",
    with_(QA_DOCS) + f"select count(*) as n_rows, count(distinct {strip('question')}) as n_distinct from qa_docs",
)
def distinct_questions(spark, sf_dir):
    return C.distinct_questions(D.qa_docs(spark, sf_dir))
