"""Queries: text normalisation, stratified split and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.functions import text as T
from qaspark.operators import split as S
from qaspark.plans import derived as D
from qaspark.plans.registry import register
from qaspark.plans.sqltext import QA, QA_DOCS, split_cte, strip, with_

# Padding added to the question by ``id % 4``; the supplied texts have no
# edge whitespace, so the normalisation query adds some.
_PAD = {1: ("\n\t", "  "), 2: ("　", "\r\n"), 3: (" ", "")}


def _padded(col):
    out = F.col(col)
    expr = None
    for k, (a, b) in _PAD.items():
        v = F.concat(F.lit(a), F.col(col), F.lit(b))
        expr = F.when(F.col("id") % 4 == k, v) if expr is None else expr.when(F.col("id") % 4 == k, v)
    return expr.otherwise(out)


def _padded_sql(col):
    arms = " ".join(
        f"when id % 4 = {k} then {' || '.join(f'chr({ord(ch)})' for ch in a) or chr(39) * 2} || {col} || "
        f"{' || '.join(f'chr({ord(ch)})' for ch in b) or chr(39) * 2}"
        for k, (a, b) in _PAD.items()
    )
    return f"case {arms} else {col} end"


@register(
    "normalize_question",
    with_(QA) + f"select id, {strip(_padded_sql('question'))} as question_norm, "
    f"cast(length({strip(_padded_sql('question'))}) as bigint) as n_chars from qa",
)
def normalize_question(spark, sf_dir):
    qa = D.qa(spark, sf_dir).withColumn("raw", _padded("question"))
    return qa.select("id", T.normalize_question("raw").alias("question_norm")).withColumn(
        "n_chars", F.length("question_norm").cast("long")
    )


@register(
    "stratified_split",
    with_(QA_DOCS, split_cte("qa_docs")) + "select id, category, split, cast(rank as bigint) as rank from split_rows",
)
def stratified_split(spark, sf_dir):
    return S.stratified_split(D.qa_docs(spark, sf_dir)).select("id", "category", "split", "rank")


@register(
    "split_sizes",
    with_(QA_DOCS, split_cte("qa_docs")) + "select split, count(*) as n from split_rows group by split",
)
def split_sizes(spark, sf_dir):
    return S.split_sizes(S.stratified_split(D.qa_docs(spark, sf_dir)))
