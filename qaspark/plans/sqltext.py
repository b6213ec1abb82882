"""SQL building blocks for the DuckDB oracle texts.

The oracle runs on DuckDB over the same Parquet files, so the derived
relations of ``qaspark.plans.derived`` are restated here as CTEs."""

from __future__ import annotations

from qaspark.functions.text import WS

# The 29 whitespace characters as a DuckDB string expression.
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WS) + ")"


def strip(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


def seeded_key(id_expr: str = "id", seed: int = 42) -> str:
    return f"md5(concat_ws('|', '{seed}', cast({id_expr} as varchar)))"


QA = """qa as (
  select row_number() over (order by conv_id, turn) as id,
         concat('cat', cast(conv_id % 9 as varchar(10))) as category,
         q as question, a as answer
  from (select conv_id, turn, role, text as q,
               lead(role) over (partition by conv_id order by turn) as next_role,
               lead(text) over (partition by conv_id order by turn) as a
        from conversations) s
  where role = 'user' and next_role = 'assistant')"""

QA_DOCS = """qa_docs as (
  select doc_id as id, source as category, text as question, text as answer
  from documents)"""

SCORE_LOG = """score_log as (
  select event_id as idx,
         case when ts < timestamp '2024-01-16 00:00:00' then 'baseline' else 'finetuned' end as run,
         event_type as metric,
         least(value / 100, cast(1.0 as double)) as score
  from events)"""

CALL_LOG = """call_log as (
  select user_id as key, ts, cast(floor(value * 10) as bigint) as tokens, event_id from events)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def split_cte(src: str = "qa_docs", quotas=((("golden_eval", 6), ("validation", 5), ("train", 27))), seed: int = 42,
              name: str = "split_rows") -> str:
    total = sum(q for _, q in quotas)
    upper, arms = 0, []
    for label, q in quotas:
        upper += q
        arms.append(f"when rank <= {upper} then '{label}'")
    return f"""{name} as (
  select *, case {' '.join(arms)} end as split
  from (select *, row_number() over (partition by category order by {seeded_key('id', seed)}, id) as rank
        from {src}) r
  where rank <= {total})"""

def answers_cte(src: str = "qa", offset: int = 1, name: str = "answers") -> str:
    return f"""{name} as (
  select id - {offset} as idx, category, question, answer as expected_answer,
         array_to_string(list_slice(w, 1, len(w) // 3), ' ') as generated_answer,
         array_to_string(list_slice(w, 1, (len(w) * 2) // 3), ' ') as finetuned_answer,
         '' as context
  from (select *, string_split_regex({strip('answer')}, '[ \\t\\n\\r]+') as w from {src}) s)"""


ANSWERS = answers_cte()
