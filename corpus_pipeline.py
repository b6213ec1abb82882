"""A training corpus from ``documents``, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from qaspark.llm import bpe, langid, mixing, neardup, pii
from qaspark.llm.common import documents, materialise


def language_id(spark, docs, sf_dir):
    """Documents in a language that can be told; others go."""
    return langid.keep_identified(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies (a similarity of 0.8 or
    more of their five-word shingles)."""
    return neardup.keep_one_of_each(docs, percent=80)


def pseudonyms(spark, docs, sf_dir):
    """Personal data replaced within their formats (the length of a text
    stays)."""
    return pii.with_pseudonyms(docs)


def mixture(spark, docs, sf_dir):
    """Documents repeated or left out so that sources meet their targets."""
    return mixing.mixed_documents(docs)


def tokens(spark, docs, sf_dir):
    """Digests of every document's ids and of their decoded text."""
    return bpe.digests(docs, stored=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pseudonyms", pseudonyms),
    ("mixture", mixture),
    ("tokens", tokens),
]

# A language model, a keyed permutation and a tokenizer have no SQL form;
# tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
