"""Language identification by fusing evidence.

Four sources are combined by Bayes' rule: the likelihood of the text under
character-trigram models, the language declared in the markup, the address
suffix, and a prior for the host that is smoothed through its hierarchy
(host, then its domain, then all rows). The trigram models are fitted on a
bounded sample; the tables for markup, suffix and hosts are grouped
aggregates of the text-only posteriors over all rows.

A class ``und`` (undetermined) stands for text that no model explains: its
likelihood is that of a uniform model. Texts without letters have no text
evidence. A document is rejected if ``und`` or a language outside the wanted
ones is likeliest, or the likeliest one stays below ``MIN_PROBABILITY``.

Defined cases: null and empty texts are ``und`` and rejected; null markup,
suffix or host add no evidence of that kind; repeated rows get equal rows;
an empty table gives an empty result; without any labelled row there are no
models and every text is ``und``.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaspark.llm.common import materialise, prepare

UNKNOWN = "und"
BUCKET_BITS = 16
# Bounds of the sample that the trigram models are fitted on.
SAMPLE_DOCS, SAMPLE_CHARS = 300, 4_000
# A text counts as at most so many independent trigrams, so that other
# evidence can still tip short or mixed texts.
EFFECTIVE_TRIGRAMS = 60
# Strength, in rows, of a parent's distribution over a child's own rows.
SMOOTHING = 20.0
MIN_PROBABILITY = 0.5


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself if it's a letter, else space."""
    table = np.full(0x110000, 32, np.uint32)
    ok = [i for i in range(0x30000) if chr(i).isalpha()]
    table[ok] = ok
    return table


def trigram_ids(text: str | None) -> np.ndarray:
    """Bucket of every character trigram of the lower-cased text that holds a
    letter; runs of other characters count as one space."""
    if not text:
        return np.empty(0, np.int64)
    raw = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    c = _letters()[np.frombuffer(raw, np.uint32)]
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]].astype(np.uint64)
    if len(c) < 3:
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and a matrix of log probabilities (trigram buckets x
    languages, ``und`` last), for every language that has a non-empty text.
    Fitted on at most ``SAMPLE_DOCS`` rows a language, chosen by hash from
    its texts of at most ``SAMPLE_CHARS`` characters; a language that has
    only longer ones gives the first ``SAMPLE_CHARS`` of each row taken."""
    text = F.col(text_col)
    ok = labelled.where((F.length(text) > 0) & F.col(lang_col).isNotNull() & (F.col(lang_col) != UNKNOWN)).select(
        F.substring(text, 1, SAMPLE_CHARS).alias("text"), F.col(lang_col).alias("lang"), (F.length(text) > SAMPLE_CHARS).alias("long")
    )
    # short texts come before long ones
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("long", F.xxhash64("text"), "text"))
    best = F.min("long").over(Window.partitionBy("lang"))
    sample = ok.withColumn("r", rank).where(F.col("r") <= SAMPLE_DOCS).withColumn("best", best).where("long = best")
    rows = sample.select("lang", "text").collect()
    wanted = sorted({r["lang"] for r in rows})
    place = {lang: i for i, lang in enumerate(wanted)}
    counts = np.zeros((1 << BUCKET_BITS, len(wanted) + 1))
    for r in rows:
        counts[:, place[r["lang"]]] += np.bincount(trigram_ids(r["text"]), minlength=1 << BUCKET_BITS)
    counts += 0.05
    counts[:, -1] = 1.0
    return [*wanted, UNKNOWN], np.log(counts / counts.sum(axis=0)).astype(np.float32)


def _scorer(model):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.value
        for texts in batches:
            out = []
            for text in texts:
                ids = trigram_ids(text)
                n = len(ids)
                out.append((table[ids].sum(axis=0, dtype=np.float64) * (min(n, EFFECTIVE_TRIGRAMS) / n)).tolist() if n else None)
            yield pd.Series(out, dtype=object)

    return run


def _softmax(logits: list[Column]) -> list[Column]:
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    parts = [F.exp(x - top) for x in logits]
    total = functools.reduce(lambda a, b: a + b, parts)
    return [p / total for p in parts]


def _group_table(rows: DataFrame, key: str, k: int) -> DataFrame:
    """Sums of the text-only posteriors by a key, over all rows."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("_n").alias("_n"), *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(k)]
    )


def identify(
    df: DataFrame,
    model: tuple[list[str], np.ndarray],
    text_col: str = "text",
    hosts: tuple[Column, ...] = (),
    markup: Column | None = None,
    suffix: Column | None = None,
    wanted: list[str] | None = None,
) -> DataFrame:
    """``df`` with ``lang_found``, ``lang_probability`` and ``lang_kept``.
    ``hosts`` names the host's hierarchy from coarse to fine."""
    spark = df.sparkSession
    prepare(spark)
    langs, table = model
    k = len(langs)
    shared = spark.sparkContext.broadcast(table)
    score = F.pandas_udf(_scorer(shared), "array<double>")
    null = F.lit(None).cast("string")
    keys = {f"_h{i}": h for i, h in enumerate(hosts)} | {"_m": null if markup is None else markup, "_s": null if suffix is None else suffix}
    scored = df.withColumns({**keys, "_ll": score(F.col(text_col))})

    # text-only posteriors, summed by every key in one pass each over slim rows
    flat = [F.coalesce(F.col("_ll")[i], F.lit(0.0)) for i in range(k)]
    post = _softmax([F.col(f"_l{i}") for i in range(k)])
    slim = scored.select(*keys, *[f.alias(f"_l{i}") for i, f in enumerate(flat)], F.col("_ll").isNotNull().alias("_has"))
    # rows with equal keys are one row of sums from here on
    sums = slim.where("_has").select(*keys, *[p.alias(f"_p{i}") for i, p in enumerate(post)])
    sums = materialise(
        sums.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_n"), *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(k)]),
        "evidence",
    )
    total = sums.agg(F.sum("_n").alias("_n"), *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(k)]).first()
    n_all = total["_n"] or 0.0
    overall = [((total[f"_p{i}"] or 0.0) + 1.0) / (n_all + k) for i in range(k)]

    def log_ratio(name: str) -> DataFrame:
        """log P(key | language) against P(key), smoothed towards 0."""
        per = _group_table(sums, name, k)
        return per.select(
            F.col(name).alias(f"{name}_k"),
            *[
                F.log((F.col(f"_p{i}") + SMOOTHING * overall[i]) / ((F.col("_n") + SMOOTHING) * overall[i])).alias(f"{name}_{i}")
                for i in range(k)
            ],
        )

    evidence = {name: materialise(log_ratio(name), "evidence") for name, given in (("_m", markup), ("_s", suffix)) if given is not None}
    parent = None
    for level in range(len(hosts)):
        chain = [f"_h{j}" for j in range(level + 1)]
        per = sums.where(F.col(f"_h{level}").isNotNull()).groupBy(*chain).agg(
            F.sum("_n").alias("_n"), *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(k)]
        )
        above = [F.lit(overall[i]) for i in range(k)]
        if parent is not None:
            up = parent.select(*[F.col(c).alias(f"_up{c}") for c in chain[:-1]], *[F.col(f"_q{i}").alias(f"_up{i}") for i in range(k)])
            on = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_up{c}")) for c in chain[:-1]])
            per = per.join(up, on, "left")
            above = [F.coalesce(F.col(f"_up{i}"), a) for i, a in enumerate(above)]
        parent = per.select(
            *chain, *[((F.col(f"_p{i}") + SMOOTHING * a) / (F.col("_n") + SMOOTHING)).alias(f"_q{i}") for i, a in enumerate(above)]
        )
        parent = materialise(parent, "hosts")

    out = scored
    logits = [F.coalesce(F.col("_ll")[i], F.lit(0.0)) for i in range(k)]
    for name, table_ in evidence.items():
        out = out.join(table_, F.col(name) == F.col(f"{name}_k"), "left")
        logits = [x + F.coalesce(F.col(f"{name}_{i}"), F.lit(0.0)) for i, x in enumerate(logits)]
    if parent is not None:
        chain = [f"_h{j}" for j in range(len(hosts))]
        prior = parent.select(*[F.col(c).alias(f"_k{c}") for c in chain], *[F.col(f"_q{i}").alias(f"_q{i}") for i in range(k)])
        on = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{c}")) for c in chain])
        out = out.join(prior, on, "left")
        logits = [x + F.log(F.coalesce(F.col(f"_q{i}"), F.lit(overall[i]))) for i, x in enumerate(logits)]
    else:
        logits = [x + F.lit(math.log(overall[i])) for i, x in enumerate(logits)]
    out = out.select(*df.columns, "_ll", *[x.alias(f"_z{i}") for i, x in enumerate(logits)])
    probs = _softmax([F.col(f"_z{i}") for i in range(k)])
    out = out.select(*df.columns, "_ll", F.array(*probs).alias("_post"))
    best = F.array_max("_post")
    lang = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("_post", best).cast("int"))
    # without a letter there is nothing to decide on
    out = out.select(
        *df.columns,
        F.when(F.col("_ll").isNull(), F.lit(UNKNOWN)).otherwise(lang).alias("lang_found"),
        F.when(F.col("_ll").isNull(), F.lit(0.0)).otherwise(best).alias("lang_probability"),
    )
    accepted = [x for x in (wanted or langs) if x != UNKNOWN]
    kept = F.col("lang_found").isin(accepted) & (F.col("lang_probability") >= MIN_PROBABILITY) if accepted else F.lit(False)
    return out.withColumn("lang_kept", kept)


def page_text(html: Column) -> Column:
    """Text of a page: scripts, styles and tags cut out."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>|&[a-zA-Z#0-9]+;", " ")


def markup_language(html: Column) -> Column:
    found = F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?i)<html[^>]*\blang\s*=\s*["']?([a-zA-Z]{2,3})""", 1))
    return F.when(found != "", found)


def host_levels(host: Column) -> tuple[Column, Column]:
    """The host's domain (its last three labels) and the host."""
    named = F.when(host != "", host)
    return F.substring_index(named, ".", -3), named


def suffix_of(host: Column) -> Column:
    return F.when(host != "", F.substring_index(host, ".", -1))


def identify_documents(docs: DataFrame, model=None) -> DataFrame:
    """Documents have a source for a host, and no markup or address."""
    return identify(docs, model or fit(docs), hosts=(F.col("source"),))


def identify_pages(pages: DataFrame, model) -> DataFrame:
    from qaspark.llm.urls import host

    name = host(F.col("url"))
    ready = pages.select("page_id", "url", "html").withColumn("_text", page_text(F.col("html")))
    return identify(
        ready, model, text_col="_text", hosts=host_levels(name), markup=markup_language(F.col("html")), suffix=suffix_of(name)
    ).drop("_text")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that aren't rejected; columns unchanged."""
    return identify_documents(docs).where("lang_kept").select(*docs.columns)
