"""Parsing model replies into Q&A items (F24, F25, F26), with native
variant functions only: no Python parser, no UDF.

Rules of ``extract_items`` (what the generator accepts as a batch):

* the whole reply is one JSON value (leading/trailing whitespace allowed):
  an array gives its elements; an object gives the first of its values
  that is an array, in document order (an empty array counts), else the
  object itself as the only element; any other value gives nothing;
* the reply is not one JSON value: the text from the first ``[`` to the
  last ``]`` is tried as one JSON value, and only an array is accepted;
* anything else gives nothing.

Strictness comes from parsing ``[`` + text + ``]`` and requiring exactly
one element: trailing text then becomes a parse error, and ``1,2`` or an
empty reply give a size other than one. Two forms that Python's parser takes
are taken too: ``NaN``, ``Infinity`` and ``-Infinity``, which are read as
strings of that text (``settle_numbers``), and repeated keys, of which the
last one counts (in expressions resolved under ``repeated_keys``).
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

ARR = "array<variant>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_array(v: Column) -> Column:
    return _kind(v).startswith("ARRAY")


def _is_object(v: Column) -> Column:
    return _kind(v).startswith("OBJECT")


@contextlib.contextmanager
def repeated_keys(spark: SparkSession):
    """DataFrames built in this block keep the last value of a repeated key
    when they parse JSON; Spark fixes that when it resolves an expression.
    The session's own setting is put back."""
    name = "spark.sql.variant.allowDuplicateKeys"
    old = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def settle_numbers(c) -> Column:
    """JSON text with ``NaN`` and the infinities outside strings put into
    quotes. Escapes are hidden first, so that every quote left opens or closes
    a string, and only the parts between strings are changed. Texts without
    these words, or with the two control characters used to hide escapes (which
    JSON doesn't allow), stay as they are."""
    c = _c(c)
    hidden = F.replace(F.replace(c, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    token = r"(?<![\w.])(-?Infinity|NaN)(?![\w.])"
    parts = F.transform(F.split(hidden, '"'), lambda x, i: F.when(i % 2 == 0, F.regexp_replace(x, token, '"$1"')).otherwise(x))
    shown = F.replace(F.replace(F.array_join(parts, '"'), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    odd = (F.contains(c, F.lit("NaN")) | F.contains(c, F.lit("Infinity"))) & ~c.rlike("[\x01\x02]")
    return F.when(odd, shown).otherwise(c)


def strict_json(c) -> Column:
    """One complete JSON value as a variant, else null."""
    c = settle_numbers(c)
    wrapped = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", ARR)
    return F.when(F.size(wrapped) == 1, F.element_at(wrapped, 1))


def bracket_span(c) -> Column:
    """Text from the first ``[`` to the last ``]``, or null."""
    c = _c(c)
    first = F.locate("[", c)
    last_rev = F.locate("]", F.reverse(c))
    last = F.length(c) - last_rev + 1
    return F.when((first > 0) & (last_rev > 0) & (last > first), F.substring(c, first, last - first + 1))


def extract_items(c, parsed=None) -> Column:
    """``array<variant>`` of reply elements (F24); never null. ``parsed`` is
    an optional column already holding ``strict_json(c)``; projecting it
    first lets the parse run once per row instead of once per branch."""
    c = _c(c)
    v0 = strict_json(c) if parsed is None else _c(parsed)
    as_array = F.try_variant_get(v0, "$", ARR)
    # values in the order of the keys' first appearance, each with its last value
    fields = F.try_variant_get(v0, "$", "map<string,variant>")
    values = F.transform(F.array_distinct(F.json_object_keys(settle_numbers(c))), lambda k: F.try_element_at(fields, k))
    lists = F.filter(values, lambda v: _is_array(v))
    from_object = F.when(F.size(lists) > 0, F.try_variant_get(F.element_at(lists, 1), "$", ARR)).otherwise(
        F.array(v0)
    )
    fb = strict_json(bracket_span(c))
    fallback = F.when(_is_array(fb), F.try_variant_get(fb, "$", ARR))
    out = (
        F.when(v0.isNotNull() & _is_array(v0), as_array)
        .when(v0.isNotNull() & _is_object(v0), from_object)
        .when(v0.isNull(), fallback)
    )
    return F.coalesce(out, F.array().cast(ARR))


def field_text(item: Column, key: str) -> Column:
    """A field of an item as text: strings as they are, numbers and booleans
    in their JSON form, arrays and objects as JSON text; absent or JSON
    null gives null."""
    path = f"$.{key}"
    as_str = F.try_variant_get(item, path, "string")
    raw = F.try_variant_get(item, path, "variant")
    return F.when(_kind(raw) == "VOID", F.lit(None).cast("string")).otherwise(F.coalesce(as_str, F.to_json(raw)))


def reply_content(body) -> Column:
    """``choices[0].message.content`` of a chat-completion body, else "" (F25)."""
    v = F.try_parse_json(_c(body))
    return F.coalesce(F.try_variant_get(v, "$.choices[0].message.content", "string"), F.lit(""))


def judge_reply_valid(c, required: dict[str, str]) -> Column:
    """The reply is one JSON object whose required fields are present with
    the given types (F26). ``required`` maps field -> Spark type name."""
    v = strict_json(c)
    ok = v.isNotNull() & _is_object(v)
    for key, typ in required.items():
        raw = F.try_variant_get(v, f"$.{key}", "variant")
        kind = _kind(raw)
        if typ == "string":
            good = kind.startswith("STRING")
        elif typ in ("double", "float", "int", "bigint", "number"):
            good = kind.startswith("BIGINT") | kind.startswith("DOUBLE") | kind.startswith("DECIMAL") | \
                kind.startswith("INT") | kind.startswith("FLOAT") | kind.startswith("SMALLINT") | \
                kind.startswith("TINYINT")
        elif typ == "boolean":
            good = kind == "BOOLEAN"
        else:
            good = raw.isNotNull() & (kind != "VOID")
        ok = ok & F.coalesce(good, F.lit(False))
    return F.coalesce(ok, F.lit(False))
