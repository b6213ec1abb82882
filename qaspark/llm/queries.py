"""The registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from qaspark.llm import ann, bpe, chat_tools, importance, langid, mixing, neardup, pii, quality, repair, repeats, toxicity, urls
from qaspark.llm.common import documents

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return add


@_query("op1_toxicity")
def op1(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@_query("op2_nearest")
def op2(spark, sf_dir):
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


@_query("op3_bpe")
def op3(spark, sf_dir):
    return bpe.digests(documents(spark, sf_dir), stored=True)


@_query("op4_tool_calls", chat_tools.CHAT_SQL)
def op4(spark, sf_dir):
    calls, results = chat_tools.derived_calls(_table(spark, sf_dir, "conversations"))
    return chat_tools.link_tool_calls(calls, results, chat_tools.SCHEMAS, more="rows")


@_query("op5_pseudonyms")
def op5(spark, sf_dir):
    return pii.with_pseudonyms(documents(spark, sf_dir, "doc_id", "text"), finds_col="finds")


@_query("op6_language")
def op6(spark, sf_dir):
    """Documents and pages, each judged among its own kind, with one model."""
    docs = documents(spark, sf_dir)
    model = langid.fit(docs)
    found = ["lang_found", "lang_probability", "lang_kept"]
    of_docs = langid.identify_documents(docs, model).select("doc_id", F.lit(None).cast("long").alias("page_id"), *found)
    of_pages = langid.identify_pages(_table(spark, sf_dir, "pages"), model)
    return of_docs.unionByName(of_pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", *found))


@_query("op7_near_duplicates")
def op7(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir))


@_query("op8_quality", quality.QUALITY_SQL)
def op8(spark, sf_dir):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judge(documents(spark, sf_dir)).select("doc_id", *names, "base_failed", "kept")


@_query("op9_mixture", mixing.MIX_SQL)
def op9(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


@_query("op10_url_filter", urls.URLS_SQL)
def op10(spark, sf_dir):
    return urls.filter_urls(_table(spark, sf_dir, "pages"))


@_query("op11_resample", importance.RESAMPLE_SQL)
def op11(spark, sf_dir):
    target = _table(spark, sf_dir, "benchmark").select("text")
    return importance.resample(documents(spark, sf_dir, "doc_id", "text"), target)


@_query("op12_repeats", repeats.REPEATS_SQL)
def op12(spark, sf_dir):
    return repeats.remove_repeats(documents(spark, sf_dir, "doc_id", "text"))


@_query("op13_repair", repair.REPAIR_SQL)
def op13(spark, sf_dir):
    return repair.repair(_table(spark, sf_dir, "conversations"))
