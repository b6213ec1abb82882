"""Queries: splits (complete), chat formatting, training plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.operators import chat as CH
from qaspark.operators import split as S
from qaspark.plans import derived as D
from qaspark.plans.registry import register
from qaspark.plans.sqltext import QA, QA_DOCS, split_cte, strip, with_


def _sql_lit(s: str) -> str:
    """A DuckDB string expression for any text (newlines as chr(10))."""
    pieces = s.split("\n")
    quoted = [("'" + p.replace("'", "''") + "'") for p in pieces]
    return " || chr(10) || ".join(quoted)


def _render_sql(template: CH.ChatTemplate, msgs, gen: bool = False) -> str:
    before, after = template.open.split("{role}", 1)
    names = dict(template.role_names)
    out = [_sql_lit(template.bos)] if template.bos else []
    for role, content in msgs:
        out += [_sql_lit(before + names.get(role, role) + after), content, _sql_lit(template.close)]
    if gen:
        out.append(_sql_lit(template.generation_prompt))
    return "(" + " || ".join(out) + ")"


_SYS = _sql_lit(CH.SYSTEM_PROMPT)


def _qa_msgs(spark, sf_dir):
    return D.qa(spark, sf_dir).withColumn("messages", CH.chat_messages())


@register(
    "chat_messages",
    with_(QA) + f"""select id, cast(0 as bigint) as pos, 'system' as role, {_SYS} as content from qa
union all select id, 1, 'user', {strip('question')} from qa
union all select id, 2, 'assistant', {strip('answer')} from qa""",
)
def chat_messages(spark, sf_dir):
    m = _qa_msgs(spark, sf_dir).select("id", F.posexplode("messages").alias("pos", "m"))
    return m.select("id", F.col("pos").cast("long").alias("pos"), "m.role", "m.content")


_FULL = [("system", _SYS), ("user", strip("question")), ("assistant", strip("answer"))]
_PROMPT = [("system", _SYS), ("user", strip("question"))]


@register(
    "render_chat",
    with_(QA) + f"select id, {_render_sql(CH.TURN_TEMPLATE, _FULL)} as text, "
    f"{_render_sql(CH.TURN_TEMPLATE, _PROMPT, gen=True)} as prompt from qa",
)
def render_chat(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    full = CH.chat_messages()
    prompt = CH.chat_messages(answer=None)
    return qa.select(
        "id",
        CH.render_chat(full).alias("text"),
        CH.render_chat(prompt, add_generation_prompt=True).alias("prompt"),
    )


def _template_for(category):
    """The category number of ``catN``; it picks the template of the row."""
    return F.substring(category, 4, 2).cast("int")


@register(
    "template_kind",
    with_(QA) + "select id, case when cast(substring(category, 4, 2) as int) <= 3 then 'turn' "
    "when cast(substring(category, 4, 2) as int) <= 6 then 'start_of_turn' end as kind from qa",
)
def template_kind(spark, sf_dir):
    qa = _qa_msgs(spark, sf_dir)
    n = _template_for(F.col("category"))
    text = (
        F.when(n <= 3, CH.render_chat("messages", CH.TURN_TEMPLATE))
        .when(n <= 6, CH.render_chat("messages", CH.START_OF_TURN_TEMPLATE))
        .otherwise(CH.render_chat("messages", CH.PLAIN_TEMPLATE))
    )
    return qa.select("id", CH.template_kind(text).alias("kind"))


_CLOSE = _sql_lit(CH.TURN_TEMPLATE.close)


@register(
    "response_spans",
    with_(QA) + f"""select id, cast(1 as bigint) as span_no, {strip('answer')} || {_CLOSE} as span from qa
union all select id, 2, category || {_CLOSE} from qa""",
)
def response_spans(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    msgs = F.concat(
        CH.chat_messages(),
        F.array(CH.message("user", F.lit("Which category is this?")), CH.message("assistant", F.col("category"))),
    )
    text = CH.render_chat(msgs, CH.TURN_TEMPLATE)
    spans = CH.response_spans(text, CH.TURN_TEMPLATE.instruction_part(), CH.TURN_TEMPLATE.response_part())
    out = qa.select("id", F.posexplode(spans).alias("p", "span"))
    return out.select("id", (F.col("p") + 1).cast("long").alias("span_no"), "span")


def _n_words(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '[^ \t\n\r]+'))"


def _second_turn():
    return F.array(CH.message("user", F.lit("Which category is this?")), CH.message("assistant", F.col("category")))


_ASK = [("user", "'Which category is this?'"), ("assistant", "category")]
_CUT = _sql_lit(CH.TURN_TEMPLATE.response_part())


@register(
    "response_mask",
    with_(QA) + f""", t as (select id, category, answer, {_render_sql(CH.TURN_TEMPLATE, _FULL + _ASK)} as text from qa),
p as (select id, string_split(text, {_CUT}) as p, {strip('answer')} || {_CLOSE} as one, category || {_CLOSE} as two from t),
n as (select id, {_n_words('p[1] || ' + _CUT)} as a, {_n_words('one')} as b,
        {_n_words('substr(p[2], len(one) + 1) || ' + _CUT)} as c, {_n_words('two')} as d from p)
select id, repeat('0', a) || repeat('1', b) || repeat('0', c) || repeat('1', d) as mask, b + d as n_on from n""",
)
def response_mask(spark, sf_dir):
    """Word tokens of two-turn chats, and which of them are answers."""
    qa = D.qa(spark, sf_dir)
    chats = qa.select("id", CH.render_chat(F.concat(CH.chat_messages(), _second_turn()), CH.TURN_TEMPLATE).alias("text"))
    spans = CH.span_offsets("text", CH.TURN_TEMPLATE.instruction_part(), CH.TURN_TEMPLATE.response_part())
    spans = chats.select("id", F.explode(spans).alias("s")).select("id", "s.start", "s.end")
    masks = CH.response_mask(CH.word_tokens(chats, "text"), spans)
    return masks.select("id", F.array_join(F.col("mask").cast("array<string>"), "").alias("mask"),
                        F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_on"))


@register(
    "build_prompts",
    with_(QA) + "select distinct category, replace("
    + _sql_lit(CH.PROMPT_TEMPLATE.replace("{n}", "1")) + ", '{category}', category) as prompt from qa",
)
def build_prompts(spark, sf_dir):
    cats = D.qa(spark, sf_dir).select("category").distinct()
    return cats.select("category", CH.build_prompt(F.col("category")).alias("prompt"))


_SPLIT = with_(QA_DOCS, split_cte("qa_docs"))


@register(
    "project_messages",
    _SPLIT + "select " + _render_sql(CH.TURN_TEMPLATE, _FULL) + " as text from split_rows where split = 'train'",
)
def project_messages(spark, sf_dir):
    train = S.stratified_split(D.qa_docs(spark, sf_dir)).where(F.col("split") == "train")
    msgs = train.select(CH.chat_messages().alias("messages"))
    return msgs.select(CH.render_chat("messages").alias("text"))


@register(
    "training_plan",
    _SPLIT + """select n as n_rows, steps as total_steps,
       cast(ceil(steps * cast(0.03 as double)) as bigint) as warmup_steps
from (select count(*) as n, cast(ceil(count(*) * 10 / cast(16 as double)) as bigint) as steps
      from split_rows where split = 'train') t""",
)
def training_plan(spark, sf_dir):
    train = S.stratified_split(D.qa_docs(spark, sf_dir)).where(F.col("split") == "train")
    return CH.training_plan(train)


@register(
    "balanced_sample",
    with_(QA_DOCS) + "select id, category, rank from (select id, category, cast(row_number() over (partition by "
    "category order by md5(concat_ws('|', '42', cast(id as varchar))), id) as bigint) as rank from qa_docs) r "
    "where rank <= 10",
)
def balanced_sample(spark, sf_dir):
    return S.balanced_sample(D.qa_docs(spark, sf_dir), per_group=10).select("id", "category", "rank")


@register(
    "seeded_shuffle",
    _SPLIT + "select id, cast(row_number() over (order by md5(concat_ws('|', '42', cast(id as varchar))), id) "
    "as bigint) as shuffle_rank from split_rows where split = 'train'",
)
def seeded_shuffle(spark, sf_dir):
    train = S.stratified_split(D.qa_docs(spark, sf_dir)).where(F.col("split") == "train").select("id")
    return S.seeded_shuffle(train)


@register(
    "eval_sample",
    _SPLIT + "select id, category from split_rows where split = 'golden_eval' "
    "order by md5(concat_ws('|', '42', cast(id as varchar))), id limit 54",
)
def eval_sample(spark, sf_dir):
    golden = S.stratified_split(D.qa_docs(spark, sf_dir)).where(F.col("split") == "golden_eval")
    return S.eval_sample(golden.select("id", "category"), 54)


@register(
    "split_audit",
    with_(QA, split_cte("qa")) + """select g.category, q.split, cast(q.quota as bigint) as quota, coalesce(c.n, 0) as n,
       q.quota - coalesce(c.n, 0) as shortfall
from (select distinct category from qa) g
cross join (values ('golden_eval', 6), ('validation', 5), ('train', 27)) q(split, quota)
left join (select category, split, count(*) as n from split_rows group by 1, 2) c
  on c.category = g.category and c.split = q.split""",
)
def split_audit(spark, sf_dir):
    qa = D.qa(spark, sf_dir)
    return S.split_audit(qa, S.stratified_split(qa))


@register(
    "split_leakage",
    _SPLIT + f"select id, category from split_rows g where split = 'golden_eval' and exists (select 1 from "
    f"split_rows t where t.split = 'train' and {strip('t.question')} = {strip('g.question')})",
)
def split_leakage(spark, sf_dir):
    return S.split_leakage(S.stratified_split(D.qa_docs(spark, sf_dir))).select("id", "category")
