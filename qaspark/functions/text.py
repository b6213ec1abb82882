"""Column expressions for text clean-up. All are built-in Spark functions,
so they stay inside whole-stage codegen; none needs a Python UDF."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, NumericType, StringType, StructType

# Whitespace removed by a plain Python ``str.strip()``: every code point for
# which ``str.isspace()`` holds (29 characters). Spark's and DuckDB's one-
# argument ``trim`` remove only the space, so the set is passed explicitly.
WS = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())

# Accepted spellings of a true flag.
TRUE_FLAGS = ("1", "true", "yes", "y")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """``str.strip()``: trim the 29 Unicode whitespace characters."""
    return F.btrim(_c(c), F.lit(WS))


def normalize_question(c) -> Column:
    """The dedupe key of a question: the stripped text (F1)."""
    return strip_ws(c)


def parse_flag(c) -> Column:
    """Yes/no text to boolean (P10); null stays false."""
    return F.coalesce(F.lower(strip_ws(c)).isin(*TRUE_FLAGS), F.lit(False))


def prefix(c, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(_c(c), 1, n)


def _py_true(x: Column, dtype) -> Column:
    """Truth of a list item: not null, empty, zero or false."""
    if isinstance(dtype, BooleanType):
        return F.coalesce(x, F.lit(False))
    if isinstance(dtype, NumericType):
        return F.coalesce(x != 0, F.lit(False))
    return x.isNotNull() & (x.cast("string") != F.lit(""))


def to_text(c, dtype=None) -> Column:
    """``to_str`` (F3): null -> "", string as is, list -> its items that are
    true (not null, empty, zero or false), each stripped, joined by
    newlines. Pass the column's type as ``dtype`` for lists and booleans."""
    c = _c(c)
    if isinstance(dtype, ArrayType):
        kept = F.filter(c, lambda x: _py_true(x, dtype.elementType))
        shown = F.transform(kept, lambda x: strip_ws(_py_str(x, dtype.elementType)))
        return F.coalesce(F.array_join(shown, "\n"), F.lit(""))
    return F.coalesce(_py_str(c, dtype), F.lit(""))


def _py_str(x: Column, dtype) -> Column:
    if isinstance(dtype, BooleanType):
        return F.when(x, F.lit("True")).when(~x, F.lit("False"))
    return x.cast("string")


def flatten_list(c, element_type=StringType()) -> Column:
    """``" ".join(str(i) for i in v)`` (F2): nulls print as ``None``."""
    return F.array_join(F.transform(_c(c), lambda x: _py_str(x, element_type)), " ", "None")


def flatten_lists(df):
    """Replace every array column by its space-joined text (F2)."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, ArrayType) and not isinstance(field.dataType.elementType, StructType):
            cols.append(flatten_list(field.name, field.dataType.elementType).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def strip_fence(c) -> Column:
    """Reply clean-up (F4): strip; if it opens with a code fence keep the text
    between the first two fences, drop a leading ``json`` tag, strip again."""
    t = strip_ws(c)
    inner = F.split_part(t, F.lit("```"), F.lit(2))
    return F.when(t.startswith("```"), strip_ws(F.regexp_replace(inner, "^json", ""))).otherwise(t)


def token_estimate(c, max_tokens: int = 1024) -> Column:
    """Charged tokens before a call (F12): ``len(text) // 4 + max_tokens``."""
    return (F.floor(F.length(_c(c)) / F.lit(4)) + F.lit(max_tokens)).cast("bigint")


def error_class(c) -> Column:
    """Rate-limit errors are retried after a pause, others count as attempts."""
    msg = F.lower(_c(c))
    return (
        F.when(msg.isNull(), F.lit(None).cast("string"))
        .when(msg.contains("429") | msg.contains("rate_limit"), F.lit("rate_limit"))
        .otherwise(F.lit("other"))
    )
