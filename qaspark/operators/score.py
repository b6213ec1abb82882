"""Scoring (X1, X2, X4, F12, F17).

Two paths:

* Column scorers: a scorer is a column expression over the case fields,
  evaluated JVM-side on the (case, metric) work list. The lexical scorers
  shipped here (token recall, exact match) are deterministic **test
  stand-ins**, not model-based judges.
* Batch scorers: any object with ``score_batch(pdf) -> pdf`` (columns
  ``score``, ``error``), built once per task inside ``mapInPandas``. This
  is where an external judge model plugs in; failures become rows with an
  ``error`` and a null score instead of aborting the job.

Every score row carries the error of the call gate: a case whose judge
prompt is estimated above the per-minute token budget can never be sent
(F17, ``never_admissible``); scores computed here don't depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.functions.text import strip_ws, token_estimate
from qaspark.operators.cases import MetricSpec
from qaspark.session import ship_package

# Judge limits (calls and tokens per minute, safety share)
# and the completion allowance added to each estimate.
RPM_LIMIT = 30
TPM_LIMIT = 6000
TPM_SAFETY = 0.70
TPM_BUDGET = int(TPM_LIMIT * TPM_SAFETY)  # 4200
MAX_TOKENS = 1024

TOKEN_SEP = "[ \t\n\r]+"

_FIELD = {"input": "input", "actual_output": "actual_output", "expected_output": "expected_output",
          "retrieval_context": "context_text"}


def tokens(c: Column) -> Column:
    """Distinct lower-case word tokens."""
    words = F.split(F.lower(strip_ws(c)), TOKEN_SEP)
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def _recall(exp_tokens: Column, act_tokens: Column) -> Column:
    return F.try_divide(F.size(F.array_intersect(exp_tokens, act_tokens)).cast("double"),
                        F.size(exp_tokens).cast("double"))


def token_recall(actual: Column, expected: Column) -> Column:
    """Share of the expected answer's distinct tokens found in the actual one."""
    return _recall(tokens(expected), tokens(actual))


def exact_match(actual: Column, expected: Column) -> Column:
    return F.when(F.lower(strip_ws(actual)) == F.lower(strip_ws(expected)), F.lit(1.0)).otherwise(F.lit(0.0))


# Test stand-in metrics: lexical, deterministic.
TOKEN_RECALL = MetricSpec(name="TokenRecall", class_name="TokenRecallScorer",
                          criteria="share of expected tokens present in the answer")
EXACT_MATCH = MetricSpec(name=None, class_name="ExactMatch", criteria="answer equals expected",
                         evaluation_params=("actual_output", "expected_output"))
CONTEXT_RECALL = MetricSpec(name="ContextRecall", class_name="ContextRecallScorer",
                            criteria="share of context tokens present in the answer",
                            evaluation_params=("actual_output", "retrieval_context"), needs_context=True)
LEXICAL_METRICS = (TOKEN_RECALL, EXACT_MATCH, CONTEXT_RECALL)

# Column scorers over the per-case features built in ``score_cases``:
# ``_ta``/``_te``/``_tc`` token sets of actual, expected and context text,
# ``_eq`` the stripped, lower-cased equality of actual and expected.
_COLUMN_SCORERS: dict[str, Callable[[], Column]] = {
    "TokenRecall": lambda: _recall(F.col("_te"), F.col("_ta")),
    "ExactMatch": lambda: F.when(F.col("_eq"), F.lit(1.0)).otherwise(F.lit(0.0)),
    "ContextRecall": lambda: _recall(F.col("_tc"), F.col("_ta")),
}


def judge_prompt_length(spec: MetricSpec, lengths: dict) -> Column:
    """Characters of the judge prompt of one metric: criteria and the fields
    the metric reads, joined by newlines; from field lengths, so the prompt
    text itself is never built."""
    parts = [F.lit(len(spec.criteria))] + [lengths[_FIELD[p]] for p in spec.evaluation_params]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total + F.lit(len(parts) - 1)


def _with_context_text(cases: DataFrame) -> DataFrame:
    if "context_text" in cases.columns:
        return cases
    return cases.withColumn("context_text", F.coalesce(F.element_at("retrieval_context", 1), F.lit("")))


def score_cases(cases: DataFrame, specs=LEXICAL_METRICS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Column-scorer path (X1): one row per case and metric,
    ``idx, metric, score, error, estimate``. Each text is tokenised once per
    case; the per-metric rows come from exploding an array of
    ``(metric, raw score, estimate)`` structs (the work list, J5)."""
    c = _with_context_text(cases)
    unknown = [s.metric_name for s in specs if s.metric_name not in _COLUMN_SCORERS]
    if unknown:
        raise ValueError(f"no column scorer for {unknown}")
    fields = ("input", "actual_output", "expected_output", "context_text")
    feats = c.select(
        "idx",
        *[F.length(F.coalesce(F.col(f), F.lit(""))).alias(f"_len_{f}") for f in fields],
        tokens(F.col("actual_output")).alias("_ta"),
        tokens(F.col("expected_output")).alias("_te"),
        tokens(F.col("context_text")).alias("_tc"),
        (F.lower(strip_ws("actual_output")) == F.lower(strip_ws("expected_output"))).alias("_eq"),
    )
    lengths = {f: F.col(f"_len_{f}") for f in fields}
    entries = F.array(*[
        F.struct(F.lit(s.metric_name).alias("metric"), _COLUMN_SCORERS[s.metric_name]().alias("raw"),
                 (F.floor(judge_prompt_length(s, lengths) / F.lit(4)) + F.lit(max_tokens)).cast("long").alias("estimate"))
        for s in specs
    ])
    work = feats.select("idx", F.explode(entries).alias("w")).select("idx", "w.metric", "w.raw", "w.estimate")
    # a score that was computed stays, whatever the size of a judge's prompt
    error = F.when(F.col("raw").isNull(), F.lit("no_score"))
    return work.select("idx", "metric", F.col("raw").alias("score"), error.alias("error"), "estimate")


# --- batch scorers and answerers (mapInPandas) -------------------------------

class TokenRecallBatchScorer:
    """Reference implementation of the batch protocol (X2), equal to the
    ``TokenRecall`` column scorer; a real judge replaces it."""

    name = "TokenRecall"

    def score_batch(self, pdf: pd.DataFrame) -> pd.DataFrame:
        import re

        sep = re.compile(TOKEN_SEP)
        ws = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

        def toks(s):
            return {w for w in sep.split((s or "").strip(ws).lower()) if w}

        scores, errors = [], []
        for act, exp in zip(pdf["actual_output"], pdf["expected_output"]):
            e = toks(exp)
            if not e:
                scores.append(None)
                errors.append("no_score")
            else:
                scores.append(len(e & toks(act)) / len(e))
                errors.append(None)
        return pd.DataFrame({"score": pd.array(scores, dtype="Float64"), "error": errors})


def score_with(worklist: DataFrame, scorer_factory: Callable[[], object]) -> DataFrame:
    """Batch path (X1 + X2): ``idx, metric, score, error``. The scorer is
    created once per task and sees the case's fields, the context too if
    ``worklist`` has one. If it fails on a batch, the rows are scored one by
    one, so that only those that fail carry an error and no score."""
    cols = ["idx", "metric", "input", "actual_output", "expected_output"]
    cols += [c for c in ("retrieval_context",) if c in worklist.columns]

    def scored(scorer, pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            res = scorer.score_batch(pdf)
            if len(res) != len(pdf):
                raise ValueError(f"{len(res)} scores for {len(pdf)} cases")
            score, error = res["score"], res["error"]
        except Exception as e:  # noqa: BLE001 - a failure is data here
            if len(pdf) > 1:
                return pd.concat([scored(scorer, pdf.iloc[i : i + 1]) for i in range(len(pdf))], ignore_index=True)
            score, error = [None] * len(pdf), [f"{type(e).__name__}: {e}"] * len(pdf)
        return pd.DataFrame({"idx": pdf["idx"].values, "metric": pdf["metric"].values,
                             "score": pd.array(score, dtype="Float64"), "error": list(error)})

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        scorer = scorer_factory()
        for pdf in batches:
            yield scored(scorer, pdf)

    ship_package(worklist.sparkSession)
    return worklist.select(*cols).mapInPandas(run, "idx long, metric string, score double, error string")


class FirstSentenceAnswerer:
    """Test stand-in answerer (X4): answers with the first sentence of the
    question, i.e. the text up to the first ``.``, ``!`` or ``?`` that is
    followed by a space, tab or line break, stripped. A real model is the
    caller's, behind the same method."""

    def answer_batch(self, questions: pd.Series) -> pd.Series:
        ws = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
        first = questions.fillna("").str.split(r"(?<=[.!?])[ \t\n\r]", n=1, regex=True).str[0]
        return first.map(lambda s: s.strip(ws))


def answer_table(df: DataFrame, answerer_factory: Callable[[], object], question: str = "question",
                 idx: str = "idx") -> DataFrame:
    """Generate answers for every row (X4): ``idx, question,
    generated_answer``; the answerer is built once per task."""

    def run(batches):
        model = answerer_factory()
        for pdf in batches:
            yield pd.DataFrame({"idx": pdf[idx].values, "question": pdf[question].values,
                                "generated_answer": model.answer_batch(pdf[question]).values})

    ship_package(df.sparkSession)
    return df.select(F.col(idx).alias(idx), F.col(question).alias(question)).mapInPandas(
        run, f"{idx} long, {question} string, generated_answer string"
    )


def never_admissible(df: DataFrame, text: str, budget: int = TPM_BUDGET, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Rows whose call estimate exceeds the budget: the reference's limiter
    would wait for them forever (F17)."""
    return df.withColumn("estimate", token_estimate(text, max_tokens)).where(F.col("estimate") > budget)
