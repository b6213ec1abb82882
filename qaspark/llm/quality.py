"""Quality rules as one projection.

A threshold table (measure, lower bound, upper bound) is compiled into one
Spark projection over a text's words, lines and characters; no user function
runs. Words are ``[^\\x20\\x09-\\x0D]+``.

The number of words in repeated eight-word windows takes the hashes of all
windows of a text; only texts in which two hashes are equal go on to sort
them. Sorting keeps the work of a text near-linear in its length.

Defined cases: a null or empty text has no words, all counts are 0 and the
base check fails; ratios of texts without words or lines are 0; repeated rows
get equal rows; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.llm.common import SEPARATORS, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French, Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with be at by this from or an",
    "der die das und in den von zu mit ist ein eine auf für im dem nicht es sich auch",
    "le la les de des et un une du en que est pour dans par sur qui au pas avec",
    "el la los las de que y en un una por con para del se no su al lo es",
)
# measure, least, most (None: no bound); a document is kept if all hold.
THRESHOLDS = (
    ("n_words", 20, None),
    ("mean_word_length", 2.0, 20.0),
    ("symbol_ratio", None, 0.2),
    ("stop_word_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.5),
)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(ws: Column) -> Column:
    """Words in ``WINDOW``-word windows that occur twice or more."""
    n = F.size(ws)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(p: Column) -> Column:
            def again(x: Column, j: Column) -> Column:
                before = F.when(j > 0, F.get(p, j - 1)["h"] == x["h"]).otherwise(False)
                after = F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False))
                return before | after

            starts = F.array_sort(F.transform(F.filter(p, again), lambda x: x["i"]))
            return _bind(
                starts,
                lambda s: F.aggregate(
                    F.transform(s, lambda x, j: F.least(F.coalesce(F.get(s, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
                    F.lit(0),
                    lambda a, x: a + x,
                ),
            )

        return _bind(pairs, marked)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(_bind(windows(ws), count)).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and ratios of every text, from built-in functions only."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    stop = sorted({w for line in STOP_WORDS for w in line.split()})
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t")).withColumn("_w", words(F.col("_t")))
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: F.length(F.translate(x, SEPARATORS, "")) > 0)
    base = base.withColumn("_lines", lines)
    n_lines = F.size("_lines")
    plain = F.transform(F.col("_w"), lambda x: F.lower(F.regexp_replace(x, r"^[^\p{L}]+|[^\p{L}]+$", "")))
    counted = base.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
        F.size(F.filter(plain, lambda x: x.isin(stop))).cast("long").alias("n_stop_words"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return counted.withColumns(
        {
            "mean_word_length": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "word_chars"),
            "stop_word_ratio": ratio("n_stop_words", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        }
    )


def compile_thresholds(table=()) -> Column:
    """One condition from the rows of a threshold table."""
    parts = [F.lit(True)]
    for name, least, most in table:
        if least is not None:
            parts.append(F.col(name) >= least)
        if most is not None:
            parts.append(F.col(name) <= most)
    return reduce(lambda a, b: a & b, parts)


def judge(docs: DataFrame, table=None) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept`` for every row."""
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    out = measures(docs).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & compile_thresholds(THRESHOLDS if table is None else table))


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
x AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
g AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g FROM x),
m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
c AS (SELECT r, CAST(count(*) AS BIGINT) AS n_repeat_words FROM (SELECT DISTINCT r, unnest(range(i, i + 8)) AS p FROM m) GROUP BY r),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(ws, lambda x: list_contains(string_split('@STOP@', ' '), lower(regexp_replace(regexp_replace(x, '^[^\p{L}]+', ''), '[^\p{L}]+$', ''))))) AS n_stop
    FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words >= 20 AND word_chars / n_words BETWEEN 2 AND 20 AND n_symbols / greatest(word_chars, 1) <= 0.2
    AND n_stop / greatest(n_words, 1) >= 0.02 AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AS kept FROM f
""".replace("@STOP@", " ".join(STOP_WORDS))
