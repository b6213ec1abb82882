"""Queries: call load, token estimates, retries, request plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.functions import text as T
from qaspark.operators import chat as CH
from qaspark.operators import load as L
from qaspark.operators import packing as PK
from qaspark.plans import derived as D
from qaspark.plans.q_chat import _FULL, _PROMPT, _render_sql
from qaspark.plans.registry import register
from qaspark.plans.sqltext import CALL_LOG, QA_DOCS, with_
from qaspark.sources.tables import load

# The events are about 4 minutes apart, so the 60 s window of the reference
# becomes 60 minutes here, with limits of 10 calls or 4,200 tokens.
WIDTH_S = 3600
MAX_CALLS = 10
MAX_TOKENS_WINDOW = 4200
MAX_WAIT_S = 1800.0

_T = with_(CALL_LOG) + ", t as (select *, epoch_us(ts) as us from call_log)\n"
_W = f"range between {WIDTH_S * 1_000_000 - 1} preceding and current row"


@register(
    "rolling_load",
    _T + f"""select event_id, count(*) over w as n_calls, cast(sum(tokens) over w as bigint) as tokens_in_window
from t window w as (partition by key order by us {_W})""",
)
def rolling_load(spark, sf_dir):
    return L.rolling_window(D.call_log(spark, sf_dir), keys=["key"], width_s=WIDTH_S)


@register(
    "rate_breaches",
    _T + f"""select * from (select event_id, count(*) over w as n_calls,
       cast(sum(tokens) over w as bigint) as tokens_in_window
from t window w as (order by us {_W})) x where n_calls > {MAX_CALLS} or tokens_in_window > {MAX_TOKENS_WINDOW}""",
)
def rate_breaches(spark, sf_dir):
    w = L.rolling_window(D.call_log(spark, sf_dir), width_s=WIDTH_S)
    return L.rate_breaches(w, MAX_CALLS, MAX_TOKENS_WINDOW)


@register(
    "suggested_wait",
    _T + f"""select event_id, greatest(cast(1.0 as double), least(cast({MAX_WAIT_S} as double),
       (min(us) over w + {(WIDTH_S + 1) * 1_000_000} - us) / cast(1000000 as double))) as wait_s
from t window w as (order by us {_W})""",
)
def suggested_wait(spark, sf_dir):
    calls = D.call_log(spark, sf_dir)
    w = L.rolling_window(calls, width_s=WIDTH_S, oldest=True)
    return L.suggested_wait(w, calls, width_s=WIDTH_S, max_s=MAX_WAIT_S)


@register(
    "budget_slots",
    with_(CALL_LOG) + """select event_id, cast(floor((sum(tokens) over (order by ts, event_id rows between
       unbounded preceding and current row) - tokens) / 4200) as bigint) as slot from call_log""",
)
def budget_slots(spark, sf_dir):
    return L.budget_slots(D.call_log(spark, sf_dir))


SLOT_CALLS = 12  # a second limit beside the budget, so that both are met


@register(
    "budget_slots_exact",
    with_(CALL_LOG).replace("with ", "with recursive ", 1) + f""", o as materialized (
  select event_id, tokens, row_number() over (order by ts, event_id) as pos,
         sum(tokens) over (order by ts, event_id rows between unbounded preceding and current row) as run from call_log),
n as materialized (select p.pos, coalesce(min(q.pos), p.pos + {SLOT_CALLS}) as nxt
      from o p cross join range(1, {SLOT_CALLS + 1}) r(k) left join o q on q.pos = p.pos + k and q.run > p.run - p.tokens + 4200 group by p.pos),
g(slot, pos) as (
  select cast(0 as bigint), cast(1 as bigint)
  union all select slot + 1, n.nxt from g join n on n.pos = g.pos where n.nxt <= (select count(*) from o))
select o.event_id, g.slot, g.pos = o.pos as opens from o asof join g on o.pos >= g.pos""",
)
def budget_slots_exact(spark, sf_dir):
    """Greedy slots of at most 4,200 tokens and 12 calls over the whole log."""
    return PK.pack_calls(D.call_log(spark, sf_dir), max_calls=SLOT_CALLS)


STALL_AFTER = 3


@register(
    "empty_streaks",
    f"""with s as (select user_id, ts, event_id, event_type = 'error' as e,
       sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id
           rows between unbounded preceding and current row) as island from events)
select user_id, arg_min(event_id, ts) as start_id, count(*) as length, count(*) >= {STALL_AFTER} as stopped
from s where e group by user_id, island""",
)
def empty_streaks(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return L.empty_streaks(ev, "user_id", "ts", "event_id", F.col("event_type") == "error", STALL_AFTER)


@register(
    "token_estimate",
    "select doc_id, cast(floor(length(text) / 4) + 1024 as bigint) as estimate from documents",
)
def token_estimate(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", T.token_estimate("text").alias("estimate"))


@register(
    "never_admissible",
    "select doc_id, estimate from (select doc_id, cast(floor(length(text) / 4) + 1024 as bigint) as estimate "
    "from documents) d where estimate > 4200",
)
def never_admissible(spark, sf_dir):
    from qaspark.operators.score import never_admissible as na

    return na(load(spark, sf_dir, "documents"), "text").select("doc_id", "estimate")


@register(
    "overlong_rows",
    with_(QA_DOCS) + f""", r as (select id, cast(floor(length({_render_sql(CH.TURN_TEMPLATE, _PROMPT, gen=True)}) / 4)
       as bigint) as prompt_tokens, cast(floor(length({_render_sql(CH.TURN_TEMPLATE, _FULL)}) / 4) as bigint)
       as text_tokens from qa_docs)
select id, prompt_tokens, text_tokens, prompt_tokens > 1024 as over_input, text_tokens > 512 as over_train
from r where prompt_tokens > 1024 or text_tokens > 512""",
)
def overlong_rows(spark, sf_dir):
    docs = D.qa_docs(spark, sf_dir)
    r = docs.select(
        "id",
        CH.render_chat(CH.chat_messages(answer=None), add_generation_prompt=True).alias("prompt"),
        CH.render_chat(CH.chat_messages()).alias("text"),
    )
    est = lambda c: F.floor(F.length(c) / F.lit(4)).cast("long")
    r = r.select("id", est("prompt").alias("prompt_tokens"), est("text").alias("text_tokens"))
    return r.where((F.col("prompt_tokens") > 1024) | (F.col("text_tokens") > 512)).select(
        "id", "prompt_tokens", "text_tokens", (F.col("prompt_tokens") > 1024).alias("over_input"),
        (F.col("text_tokens") > 512).alias("over_train"))


@register(
    "charged_tokens",
    "select event_id, coalesce(case when event_type <> 'error' then cast(floor(value * 10) as bigint) end, "
    "cast(floor(length(props) / 4) + 1024 as bigint)) as charged from events",
)
def charged_tokens(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    actual = F.when(F.col("event_type") != "error", F.floor(F.col("value") * F.lit(10.0)).cast("long"))
    return ev.select("event_id", L.charged_tokens(actual, T.token_estimate("props")).alias("charged"))


def _error_message():
    e = F.col("event_type")
    return (
        F.when(e == "error", F.concat(F.lit("HTTP "), F.when(F.col("value") > 200, F.lit("429 Too Many Requests"))
                                      .otherwise(F.lit("500 Internal Server Error"))))
        .when(e == "signup", F.concat(F.lit("Rate_Limit reached for key "), F.col("user_id").cast("string")))
        .when(e == "click", F.concat(F.lit("timeout for key "), F.col("user_id").cast("string")))
    )


@register(
    "error_class",
    """select event_id, case when event_type = 'error' and value > 200 then 'rate_limit'
            when event_type = 'signup' then 'rate_limit'
            when event_type = 'click' and cast(user_id as varchar) like '%429%' then 'rate_limit'
            when event_type in ('error', 'click') then 'other' end as error_class from events""",
)
def error_class(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", T.error_class(_error_message()).alias("error_class"))


@register(
    "retry_schedule",
    "select event_id, cast(a as bigint) as attempt, cast(least(10, a * 2) as bigint) as cooldown_s "
    "from events, range(1, 5) r(a) where event_type = 'error'",
)
def retry_schedule(spark, sf_dir):
    failed = load(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return L.retry_schedule(failed)


_CATS = "[" + ", ".join("'" + c.replace("'", "''") + "'" for c in L.GENERATOR_CATEGORIES) + "]"


@register(
    "request_plan",
    f"""select n, bucket, list_extract({_CATS}, cast(bucket as integer) + 1) as category from (
  select event_id as n, cast(concat('0x', substring(md5(cast(event_id as varchar)), 1, 8)) as bigint) % 9 as bucket
  from events) b""",
)
def request_plan(spark, sf_dir):
    return L.request_plan(load(spark, sf_dir, "events"), "event_id")
