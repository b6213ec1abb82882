"""Evaluation cases.

A case is one answered question; the work list is cases x active metrics,
written as an ``explode`` of the (small, fixed) metric list, not a join."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, MapType, NumericType, StringType, VariantType

from qaspark.functions.text import to_text

# Column-name candidates, in priority order.
Q_CANDIDATES = ("question", "input", "query", "prompt", "instruction")
A_CANDIDATES = ("answer", "expected_answer", "output", "response", "completion")
C_CANDIDATES = ("context", "retrieval_context", "reference", "passage", "background")

# Share of rows that must carry a context.
CONTEXT_COVERAGE = 0.8


def _truthy(c: Column, kind: DataType) -> Column:
    """Python truth of a value read from a row: not null, not empty, not zero
    and not false."""
    if isinstance(kind, (NumericType, BooleanType)):
        full = c.cast("double") != 0 if isinstance(kind, NumericType) else c
    elif isinstance(kind, (ArrayType, MapType)):
        full = F.size(c) > 0
    elif isinstance(kind, VariantType):
        text = F.to_json(c)  # of a value without blanks
        full = ~text.isin("null", "false", '""', "[]", "{}") & ~text.rlike(r"^-?0(\.0*)?([eE][-+]?\d+)?$")
    elif isinstance(kind, (StringType, BinaryType)):
        full = F.length(c) > 0
    else:
        full = F.lit(True)
    return c.isNotNull() & F.coalesce(full, F.lit(False))


def detect_columns(df: DataFrame, order: str | None = None, q_candidates=Q_CANDIDATES,
                   a_candidates=A_CANDIDATES, c_candidates=C_CANDIDATES) -> tuple:
    """(question, answer, context) column names (P2): for each candidate list,
    the first column present in the schema and truthy in the first row.
    One action reads one row (``orderBy(order).limit(1)`` keeps one row per
    task)."""
    present = [c for c in dict.fromkeys(q_candidates + a_candidates + c_candidates) if c in df.columns]
    if not present:
        return None, None, None
    first = df.orderBy(order).limit(1) if order else df.limit(1)
    row = first.select(*[_truthy(F.col(c), df.schema[c].dataType).alias(c) for c in present]).collect()
    flags = row[0].asDict() if row else {}

    def pick(cands):
        for c in cands:
            if flags.get(c):
                return c
        return None

    return pick(q_candidates), pick(a_candidates), pick(c_candidates)


def _text(df: DataFrame, name: str) -> Column:
    """One column as case text; list items become lines."""
    return to_text(F.col(name), df.schema[name].dataType)


def answer_rows(df: DataFrame, q_key: str, a_key: str, c_key: str | None, generated: str = "generated_answer",
                idx: str = "idx") -> DataFrame:
    """Answer rows under fixed names (P11); context defaults to ""."""
    ctx = _text(df, c_key) if c_key else F.lit("")
    return df.select(
        F.col(idx).alias("idx"),
        F.col(q_key).alias("question"),
        F.col(a_key).alias("expected_answer"),
        F.col(generated).alias("generated_answer"),
        ctx.alias("context"),
    )


def context_coverage(df: DataFrame, context: str = "context", by=None, share: float = CONTEXT_COVERAGE) -> DataFrame:
    """Rows, rows with a non-empty context, and whether the share reaches
    ``share`` (A6)."""
    c = F.col(context)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(c.isNotNull() & (c != "")).cast("long").alias("n_context"),
    ]
    g = df.groupBy(*by) if by else df
    out = g.agg(*aggs)
    return out.withColumn("has_context", F.col("n_context") >= F.col("n") * F.lit(float(share)))


@dataclass(frozen=True)
class MetricSpec:
    """A declarative metric (X3): name, judging criteria, the case fields it
    reads, pass threshold, and whether it needs a context."""

    name: str | None
    class_name: str
    criteria: str = ""
    evaluation_params: tuple = ("input", "actual_output", "expected_output")
    threshold: float = 0.7
    needs_context: bool = False
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def metric_name(self) -> str:
        """Own name, else the class name."""
        return self.name or self.class_name


def specs_frame(spark, specs) -> DataFrame:
    rows = [(s.metric_name, s.class_name, s.criteria, list(s.evaluation_params), float(s.threshold),
             bool(s.needs_context)) for s in specs]
    df = spark.createDataFrame(
        rows, "metric string, class_name string, criteria string, evaluation_params array<string>, "
        "threshold double, needs_context boolean",
    )
    return with_spec_hash(df)


def with_spec_hash(specs: DataFrame) -> DataFrame:
    """``spec_hash``: a digest of everything that decides a score, so two
    runs are comparable only when it is equal (D5)."""
    text = F.concat_ws(
        "|", F.col("metric"), F.col("criteria"), F.array_join(F.col("evaluation_params"), ","),
        F.format_string("%.6f", F.col("threshold")),
    )
    return specs.withColumn("spec_hash", F.sha2(text, 256))


def active_metrics(specs, has_context: bool):
    """Metrics usable for a data set (P8): context metrics only if the
    data set has contexts."""
    return [s for s in specs if has_context or not s.needs_context]


def test_cases(answers: DataFrame, has_context: bool, generated: str = "generated_answer") -> DataFrame:
    """Cases (F21, F22): input, actual and expected output, and the context
    as a one-element list, or null when contexts are off or empty."""
    ctx = _text(answers, "context")
    retrieval = F.when(F.lit(has_context) & (ctx != ""), F.array(ctx))
    return answers.select(
        "idx",
        _text(answers, "question").alias("input"),
        _text(answers, generated).alias("actual_output"),
        _text(answers, "expected_answer").alias("expected_output"),
        retrieval.alias("retrieval_context"),
    )


def scoring_worklist(cases: DataFrame, metrics) -> DataFrame:
    """One row per case and metric (J5): an ``explode`` of the literal
    metric list, so no join and no shuffle."""
    names = F.array(*[F.lit(m.metric_name if isinstance(m, MetricSpec) else m) for m in metrics])
    return cases.withColumn("metric", F.explode(names))


def pending_cases(cases: DataFrame, done: DataFrame, idx: str = "idx", retry_failed: bool = False,
                  scores: str = "scores") -> DataFrame:
    """Cases not yet scored (J1): anti-join on the case key. With
    ``retry_failed`` a checkpoint entry without any stored score (every
    metric failed) does not count as done, so the case is scored again."""
    if retry_failed:
        done = done.where(F.coalesce(F.size(F.col(scores)), F.lit(0)) > 0)
    return cases.join(done.select(F.col(idx)), idx, "left_anti")
