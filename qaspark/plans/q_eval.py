"""Queries: evaluation cases, scoring, summaries, run comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.operators import cases as K
from qaspark.operators import compare as CMP
from qaspark.operators import score as SC
from qaspark.operators import summary as SM
from qaspark.operators import waves as W
from qaspark.plans import derived as D
from qaspark.plans.registry import register
from qaspark.plans.sqltext import ANSWERS, QA, QA_DOCS, SCORE_LOG, WS_SQL, answers_cte, with_
from qaspark.session import scratch_path
from qaspark.sources import io as IO
from qaspark.sources.tables import load


def eval_answers(spark, sf_dir):
    """Answers over the documents corpus; the context is the whole text."""
    ans = D.answers(spark, sf_dir, D.qa_docs(spark, sf_dir), offset=0)
    return ans.withColumn("context", F.coalesce("expected_answer", F.lit("")))


def _has_context(spark, sf_dir) -> bool:
    cov = K.context_coverage(eval_answers(spark, sf_dir)).collect()[0]
    return bool(cov["has_context"])


def _cases(spark, sf_dir):
    has_ctx = _has_context(spark, sf_dir)
    return K.test_cases(eval_answers(spark, sf_dir), has_ctx), K.active_metrics(SC.LEXICAL_METRICS, has_ctx)


def _scores(spark, sf_dir):
    cases, metrics = _cases(spark, sf_dir)
    return SC.score_cases(cases, metrics)


EVAL = with_(QA_DOCS, answers_cte("qa_docs", 0, "ans0"), f"""eval as (
  select idx, category, question, expected_answer, generated_answer, finetuned_answer,
         coalesce(expected_answer, '') as context
  from ans0)""", """has_ctx as (
  select count_if(context <> '') >= count(*) * cast(0.8 as double) as on_ from eval)""", """cases as (
  select idx, coalesce(question, '') as input, coalesce(generated_answer, '') as actual_output,
         coalesce(expected_answer, '') as expected_output,
         case when (select on_ from has_ctx) and context <> '' then context else '' end as context_text,
         (select on_ from has_ctx) and context <> '' as has_retrieval
  from eval)""")


def _toks(x: str) -> str:
    return (f"list_distinct(list_filter(string_split_regex(lower(trim({x}, {WS_SQL})), '[ \\t\\n\\r]+'), "
            "lambda w: w <> ''))")


def _recall(act: str, exp: str) -> str:
    return (f"case when len({_toks(exp)}) > 0 then cast(len(list_intersect({_toks(exp)}, {_toks(act)})) as double)"
            f" / len({_toks(exp)}) end")


def _metric_sql() -> str:
    rows = []
    for s in SC.LEXICAL_METRICS:
        fields = ", ".join({"input": "input", "actual_output": "actual_output", "expected_output": "expected_output",
                            "retrieval_context": "context_text"}[p] for p in s.evaluation_params)
        raw = {"TokenRecall": _recall("actual_output", "expected_output"),
               "ExactMatch": f"case when lower(trim(actual_output, {WS_SQL})) = lower(trim(expected_output, {WS_SQL}))"
                             " then cast(1.0 as double) else cast(0.0 as double) end",
               "ContextRecall": _recall("actual_output", "context_text")}[s.metric_name]
        need = "true" if s.needs_context else "false"
        rows.append(f"""select idx, '{s.metric_name}' as metric,
       cast(floor(length(concat_ws(chr(10), '{s.criteria}', {fields})) / 4) + 1024 as bigint) as estimate,
       {raw} as raw
from cases where not {need} or (select on_ from has_ctx)""")
    return "raw_scores as (\n" + "\nunion all\n".join(rows) + ")"


SCORES = EVAL + ", " + _metric_sql() + """, scores as (
  select idx, metric, raw as score, case when raw is null then 'no_score' end as error, estimate
  from raw_scores)
"""


@register(
    "detect_columns",
    with_(QA, ANSWERS) + """, f as (select * from answers order by idx limit 1)
select case when (select coalesce(question, '') from f) <> '' then 'question' end as question_key,
       case when (select coalesce(expected_answer, '') from f) <> '' then 'expected_answer' end as answer_key,
       case when (select coalesce(context, '') from f) <> '' then 'context' end as context_key""",
)
def detect_columns(spark, sf_dir):
    q, a, c = K.detect_columns(D.answers(spark, sf_dir), order="idx")
    return spark.createDataFrame([(q, a, c)], "question_key string, answer_key string, context_key string")


@register(
    "detect_columns_falsy",
    with_(QA, ANSWERS) + """, f as (select * from answers order by idx limit 1)
select case when (select coalesce(question, '') from f) <> '' then 'prompt' end as question_key,
       case when (select coalesce(expected_answer, '') from f) <> '' then 'response' end as answer_key,
       case when (select count(*) from f) > 0 then 'background' end as context_key""",
)
def detect_columns_falsy(spark, sf_dir):
    """Columns of earlier rank that hold zero, false, or an empty list, map
    or text are passed over."""
    rows = D.answers(spark, sf_dir).select(
        "idx", F.lit(0).alias("question"), F.lit(0.0).alias("input"), F.lit("").alias("query"), F.col("question").alias("prompt"),
        F.array().cast("array<string>").alias("answer"), F.lit(False).alias("output"), F.col("expected_answer").alias("response"),
        F.create_map().cast("map<string,string>").alias("context"), F.lit(None).cast("string").alias("reference"), F.array("idx").alias("background"))
    q, a, c = K.detect_columns(rows, order="idx")
    return spark.createDataFrame([(q, a, c)], "question_key string, answer_key string, context_key string")


@register(
    "answer_rows",
    with_(QA, ANSWERS) + "select idx, question, expected_answer, generated_answer, context from answers",
)
def answer_rows(spark, sf_dir):
    ans = D.answers(spark, sf_dir)
    q, a, c = K.detect_columns(ans, order="idx")
    return K.answer_rows(ans, q, a, c)


@register(
    "context_coverage",
    EVAL + "select category, count(*) as n, cast(count_if(context <> '') as bigint) as n_context, "
    "count_if(context <> '') >= count(*) * cast(0.8 as double) as has_context from eval group by category",
)
def context_coverage(spark, sf_dir):
    return K.context_coverage(eval_answers(spark, sf_dir), by=["category"])


@register(
    "active_metrics",
    EVAL + "select metric from (values ('TokenRecall', false), ('ExactMatch', false), ('ContextRecall', true)) "
    "m(metric, needs_context) where not needs_context or (select on_ from has_ctx)",
)
def active_metrics(spark, sf_dir):
    names = [m.metric_name for m in K.active_metrics(SC.LEXICAL_METRICS, _has_context(spark, sf_dir))]
    return spark.createDataFrame([(n,) for n in names], "metric string")


def _spec_sql(criteria: str) -> str:
    return (f"select metric, {criteria} as criteria, cast(0.7 as double) as threshold, "
            f"sha256(concat_ws('|', metric, {criteria}, 'input,actual_output', printf('%.6f', 0.7))) as spec_hash "
            "from (select distinct metric from score_log) m")


def _specs(df, revised=()):
    crit = F.concat(F.lit("score of "), F.col("metric"))
    if revised:
        crit = F.when(F.col("metric").isin(*revised), F.concat(crit, F.lit(" (revised)"))).otherwise(crit)
    specs = df.select("metric").distinct().select(
        "metric", crit.alias("criteria"), F.array(F.lit("input"), F.lit("actual_output")).alias("evaluation_params"),
        F.lit(0.7).alias("threshold"))
    return K.with_spec_hash(specs)


@register("metric_specs", with_(SCORE_LOG) + _spec_sql("'score of ' || metric"))
def metric_specs(spark, sf_dir):
    return _specs(D.score_log(spark, sf_dir)).select("metric", "criteria", "threshold", "spec_hash")


@register(
    "test_cases",
    EVAL + "select idx, input, actual_output, expected_output, case when has_retrieval then context_text end "
    "as context_item, has_retrieval from cases",
)
def test_cases(spark, sf_dir):
    cases, _ = _cases(spark, sf_dir)
    return cases.select("idx", "input", "actual_output", "expected_output",
                        F.element_at("retrieval_context", 1).alias("context_item"),
                        F.col("retrieval_context").isNotNull().alias("has_retrieval"))


@register(
    "scoring_worklist",
    EVAL + "select idx, metric from cases, (values ('TokenRecall', false), ('ExactMatch', false), "
    "('ContextRecall', true)) m(metric, needs_context) where not needs_context or (select on_ from has_ctx)",
)
def scoring_worklist(spark, sf_dir):
    cases, metrics = _cases(spark, sf_dir)
    return K.scoring_worklist(cases, metrics).select("idx", "metric")


@register("score_cases", SCORES + "select idx, metric, score, error, estimate from scores")
def score_cases(spark, sf_dir):
    return _scores(spark, sf_dir)


@register("score_with", SCORES + "select idx, metric, score, error from scores where metric = 'TokenRecall'")
def score_with(spark, sf_dir):
    """Batch scoring in waves: the first run ends after one wave, the second
    one scores what the journal doesn't hold."""
    cases, _ = _cases(spark, sf_dir)
    work = K.scoring_worklist(cases, [SC.TOKEN_RECALL])
    journal = scratch_path(spark, "journal")
    wave = -(-cases.count() // 3)
    for most in (1, None):
        W.score_in_waves(work, [SC.TOKEN_RECALL], SC.TokenRecallBatchScorer, journal, wave, max_waves=most)
    return W.read_journal(spark, journal).select("idx", "metric", "score", "error")


@register(
    "failed_cases",
    SCORES + """select cast(coalesce(sum(case when any_error and n_scored = 0 then 1 else 0 end), 0) as bigint) as n_failed,
       count(*) as n_cases
from (select idx, bool_or(error is not null) as any_error, count(score) as n_scored from scores group by idx) c""",
)
def failed_cases(spark, sf_dir):
    return SM.failed_cases(_scores(spark, sf_dir))


@register("case_score_map", SCORES + "select idx, metric, score from scores where score is not null")
def case_score_map(spark, sf_dir):
    """Per-case score maps (A7), exploded back to entries for the comparison."""
    maps = SM.case_score_map(_scores(spark, sf_dir))
    return maps.select("idx", F.explode("scores").alias("metric", "score"))


@register(
    "run_counts",
    SCORES + """select (select count(*) from cases) as n_samples, count(score) as n_scores, count(error) as n_errors,
       (select count(*) from cases) * 3 as total_calls from scores""",
)
def run_counts(spark, sf_dir):
    cases, metrics = _cases(spark, sf_dir)
    scores = SC.score_cases(cases, metrics)
    return SM.run_counts(cases, len(metrics), scores)


@register(
    "metric_summary",
    with_(SCORE_LOG) + """select run, metric, avg(score) as avg_score,
       avg(case when score >= 0.7 then cast(1.0 as double) else cast(0.0 as double) end) as pass_rate,
       count(score) as n
from score_log where score is not null group by run, metric""",
)
def metric_summary(spark, sf_dir):
    return SM.metric_summary(D.score_log(spark, sf_dir), by=("run", "metric"))


@register(
    "scores_long",
    with_(SCORE_LOG) + "select idx, metric, score from score_log union all "
    "select idx, 'raw_value', score * 100 from score_log",
)
def scores_long(spark, sf_dir):
    log = D.score_log(spark, sf_dir)
    entries = log.select("idx", F.create_map("metric", "score", F.lit("raw_value"), F.col("score") * 100).alias("scores"))
    return SM.scores_long(entries)


@register(
    "scores_wide",
    SCORES + """select idx, max(case when metric = 'TokenRecall' then score end) as TokenRecall,
       max(case when metric = 'ExactMatch' then score end) as ExactMatch,
       max(case when metric = 'ContextRecall' then score end) as ContextRecall
from scores group by idx""",
)
def scores_wide(spark, sf_dir):
    return SM.scores_wide(_scores(spark, sf_dir), ["TokenRecall", "ExactMatch", "ContextRecall"])


@register("passing_cases", with_(SCORE_LOG) + "select idx, run, metric, score from score_log where score >= 0.7")
def passing_cases(spark, sf_dir):
    return SM.passing_cases(D.score_log(spark, sf_dir))


@register(
    "ordered_cases",
    with_(QA, ANSWERS) + "select idx, cast(row_number() over (order by idx) as bigint) as pos from answers",
)
def ordered_cases(spark, sf_dir):
    return SM.ordered_cases(D.answers(spark, sf_dir).select("idx"))


@register(
    "preview",
    with_(QA, ANSWERS) + "select idx, substring(question, 1, 150) as question_150, substring(expected_answer, 1, 150)"
    " as expected_answer_150, substring(generated_answer, 1, 150) as generated_answer_150 from answers "
    "order by idx limit 1",
)
def preview(spark, sf_dir):
    return SM.preview(D.answers(spark, sf_dir), "idx", ["question", "expected_answer", "generated_answer"])


@register(
    "pending_cases",
    "select doc_id as idx from documents where doc_id not in (select doc_id from labels)",
)
def pending_cases(spark, sf_dir):
    cases = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"))
    done = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("idx"))
    return K.pending_cases(cases, done)


_SUMMARY_SCHEMA = ("run string, model string, dataset string, judge string, n_samples bigint, n_failed bigint, "
                   "threshold double, metrics map<string, struct<avg_score: double, pass_rate: double, n: bigint>>")


@register(
    "write_summary",
    with_(SCORE_LOG) + """, per as (
  select run, metric, round(avg(score), 4) as avg_score,
         round(avg(case when score >= 0.7 then cast(1.0 as double) else cast(0.0 as double) end), 4) as pass_rate,
         count(score) as n
  from score_log where score is not null group by run, metric),
runs as (select run, count(*) as n_samples from score_log group by run)
select r.run, 'base' as model, 'events' as dataset, 'lexical' as judge, r.n_samples, cast(0 as bigint) as n_failed,
       cast(0.7 as double) as threshold, p.metric, p.avg_score, p.pass_rate, p.n
from runs r join per p on p.run = r.run""",
)
def write_summary(spark, sf_dir):
    """Nested run summaries written as JSON lines (S7), read back with their
    schema and flattened per metric for the comparison."""
    log = D.score_log(spark, sf_dir).withColumn("error", F.lit(None).cast("string"))
    cases = log.select("run", "idx")
    summary = SM.run_summary(log, cases, {"model": "base", "dataset": "events", "judge": "lexical"})
    path = scratch_path(spark, "summary")
    IO.write_json_rows(summary, path)
    back = IO.read_rows(spark, path, _SUMMARY_SCHEMA)
    flat = back.select("*", F.explode("metrics").alias("metric", "m")).drop("metrics")
    return flat.select("run", "model", "dataset", "judge", "n_samples", "n_failed", "threshold", "metric",
                       "m.avg_score", "m.pass_rate", "m.n")


@register(
    "answer_table",
    with_(QA, ANSWERS) + f"""select idx, question, trim(case when regexp_matches(question, '[.!?][ \\t\\n\\r]')
       then regexp_extract(question, '(?s)^(.*?[.!?])[ \\t\\n\\r]', 1) else question end, {WS_SQL})
       as generated_answer from answers""",
)
def answer_table(spark, sf_dir):
    return SC.answer_table(D.answers(spark, sf_dir), SC.FirstSentenceAnswerer)


# --- comparison --------------------------------------------------------------

_SUMS = with_(SCORE_LOG) + """, base as (
  select metric, avg(score) as avg_score,
         avg(case when score >= 0.7 then cast(1.0 as double) else cast(0.0 as double) end) as pass_rate
  from score_log where run = 'baseline' and metric <> 'signup' group by metric),
post as (
  select metric, avg(score) as avg_score,
         avg(case when score >= 0.7 then cast(1.0 as double) else cast(0.0 as double) end) as pass_rate
  from score_log where run = 'finetuned' and metric <> 'error' group by metric),
joined as (
  select p.metric, coalesce(b.avg_score, cast(0 as double)) as baseline_avg,
         coalesce(b.pass_rate, cast(0 as double)) as baseline_pass,
         p.avg_score as finetuned_avg, p.pass_rate as finetuned_pass, b.metric is not null as has_baseline,
         p.avg_score - coalesce(b.avg_score, 0) as delta,
         case when coalesce(b.avg_score, 0) > 0 then (p.avg_score - coalesce(b.avg_score, 0)) / b.avg_score * 100
              else cast(0 as double) end as relative_change,
         p.pass_rate - coalesce(b.pass_rate, 0) as pass_rate_change
  from post p left join base b on p.metric = b.metric)
"""


def _summaries(spark, sf_dir):
    log = D.score_log(spark, sf_dir)
    base = SM.metric_summary(log.where((F.col("run") == "baseline") & (F.col("metric") != "signup")))
    post = SM.metric_summary(log.where((F.col("run") == "finetuned") & (F.col("metric") != "error")))
    return base, post


@register(
    "paired_answers",
    with_(QA, ANSWERS) + "select idx, question, expected_answer, generated_answer as baseline_answer, "
    "finetuned_answer, context from answers",
)
def paired_answers(spark, sf_dir):
    ans = D.answers(spark, sf_dir)
    post = ans.select("idx", F.col("finetuned_answer").alias("generated_answer"))
    return CMP.paired_answers(ans, post)


@register(
    "metric_join",
    _SUMS + "select metric, baseline_avg, baseline_pass, finetuned_avg, finetuned_pass, has_baseline from joined",
)
def metric_join(spark, sf_dir):
    base, post = _summaries(spark, sf_dir)
    return CMP.metric_join(post, base)


@register("dropped_metrics", _SUMS + "select metric from base where metric not in (select metric from post)")
def dropped_metrics(spark, sf_dir):
    base, post = _summaries(spark, sf_dir)
    return CMP.dropped_metrics(post, base).select("metric")


@register(
    "metric_delta",
    _SUMS + "select metric, baseline_avg, finetuned_avg, delta, relative_change from joined",
)
def metric_delta(spark, sf_dir):
    base, post = _summaries(spark, sf_dir)
    return CMP.metric_delta(CMP.metric_join(post, base)).select(
        "metric", "baseline_avg", "finetuned_avg", "delta", "relative_change")


_VERDICT_SQL = ("case when coalesce({d}, 0) >= 0.15 then 'SIGNIFICANT IMPROVEMENT' when coalesce({d}, 0) >= 0.05 "
                "then 'MODERATE IMPROVEMENT' else 'MARGINAL / FLAT' end")


@register(
    "verdict",
    _SUMS + "select metric, round(delta, 4) as delta_4, " + _VERDICT_SQL.format(d="round(delta, 4)")
    + " as verdict, coalesce(round(delta, 4), 0) < 0 as regressed from joined",
)
def verdict(spark, sf_dir):
    base, post = _summaries(spark, sf_dir)
    j = CMP.metric_delta(CMP.metric_join(post, base)).withColumn("delta_4", F.round("delta", 4))
    return j.select("metric", "delta_4", CMP.verdict(F.col("delta_4")).alias("verdict"),
                    CMP.regressed(F.col("delta_4")).alias("regressed"))


@register(
    "compare_runs",
    _SUMS + """, vd as (select max(case when metric = 'click' then round(delta, 4) end) as d from joined)
select j.*, coalesce(sha256(concat_ws('|', j.metric, 'score of ' || j.metric ||
                            case when j.metric = 'click' then ' (revised)' else '' end,
                            'input,actual_output', printf('%.6f', 0.7)))
                     = sha256(concat_ws('|', b.metric, 'score of ' || b.metric, 'input,actual_output',
                              printf('%.6f', 0.7))), false) as spec_match,
       """ + _VERDICT_SQL.format(d="(select d from vd)") + """ as verdict,
       coalesce((select d from vd), 0) < 0 as regressed
from joined j left join base b on j.metric = b.metric""",
)
def compare_runs(spark, sf_dir):
    base, post = _summaries(spark, sf_dir)
    return CMP.compare_runs(post, base, _specs(post, revised=("click",)), _specs(base), verdict_metric="click")


@register(
    "report_lines",
    _SUMS + """select metric,
       printf('%-30s %10.3f %12.3f %s%9.3f %s%8.1f%%', metric, baseline_avg, finetuned_avg,
              case when delta >= 0 then '+' else '' end, delta,
              case when relative_change >= 0 then '+' else '' end, relative_change) as score_line,
       printf('%-30s %9.1f%% %11.1f%% %s%8.1f%%', metric, baseline_pass * 100, finetuned_pass * 100,
              case when pass_rate_change >= 0 then '+' else '' end, pass_rate_change * 100) as pass_line
from joined""",
)
def report_lines(spark, sf_dir):
    base, post = _summaries(spark, sf_dir)
    return CMP.report_lines(CMP.compare_runs(post, base, verdict_metric="click"))


_DELTA_SCHEMA = ("metric string, baseline struct<avg_score: double, pass_rate: double>, "
                 "fine_tuned struct<avg_score: double, pass_rate: double>, "
                 "delta struct<avg_score_change: double, relative_change_percent: double, pass_rate_change: double>")


@register(
    "write_delta",
    _SUMS + """select metric, baseline_avg, baseline_pass, finetuned_avg, finetuned_pass,
       round(delta, 4) as avg_score_change, round(relative_change, 2) as relative_change_percent,
       round(pass_rate_change, 4) as pass_rate_change from joined""",
)
def write_delta(spark, sf_dir):
    """Delta report written as JSON lines (S8), read back with its schema
    and flattened."""
    base, post = _summaries(spark, sf_dir)
    path = scratch_path(spark, "delta")
    IO.write_json_rows(CMP.delta_report(CMP.metric_join(post, base)), path)
    back = IO.read_rows(spark, path, _DELTA_SCHEMA)
    return back.select(
        "metric", F.col("baseline.avg_score").alias("baseline_avg"), F.col("baseline.pass_rate").alias("baseline_pass"),
        F.col("fine_tuned.avg_score").alias("finetuned_avg"), F.col("fine_tuned.pass_rate").alias("finetuned_pass"),
        "delta.avg_score_change", "delta.relative_change_percent", "delta.pass_rate_change")
