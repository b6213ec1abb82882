"""Chat formatting and training plan.

Templates are parameters: the tokenizer that owns a real template is not
part of this library, so a template is a set of marker strings and the
rendering is a column expression (``transform`` + ``array_join``)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaspark.functions.text import strip_ws

# The system prompt of the training and evaluation chats.
SYSTEM_PROMPT = (
    "You are an expert car repair assistant. Answer the user's question concisely "
    "and accurately. Be technically precise about parts, diagnostics, and procedures."
)

# The markers the template detection looks for, in priority order.
TURN_MARKER = "<|turn>user"
START_OF_TURN_MARKER = "<start_of_turn>user"


@dataclass(frozen=True)
class ChatTemplate:
    """Marker strings of a chat template. ``{role}`` in ``open`` is replaced
    by the role name after ``role_names`` mapping."""

    bos: str = "<bos>"
    open: str = "<|turn>{role}\n"
    close: str = "<turn|>\n"
    role_names: tuple = (("assistant", "model"),)
    generation_prompt: str = "<|turn>model\n"

    def instruction_part(self) -> str:
        return self.open.replace("{role}", "user")

    def response_part(self) -> str:
        return self.generation_prompt


TURN_TEMPLATE = ChatTemplate()
START_OF_TURN_TEMPLATE = ChatTemplate(
    open="<start_of_turn>{role}\n", close="<end_of_turn>\n", generation_prompt="<start_of_turn>model\n"
)
PLAIN_TEMPLATE = ChatTemplate(bos="", open="### {role}\n", close="\n", generation_prompt="### model\n")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message(role: str, content) -> Column:
    return F.struct(F.lit(role).alias("role"), _c(content).alias("content"))


def chat_messages(question="question", answer="answer", system: str | None = SYSTEM_PROMPT) -> Column:
    """``array<struct<role, content>>``: system, user, assistant (F18);
    contents forced to text (F6) and stripped. A null stays null."""
    msgs = []
    if system is not None:
        msgs.append(message("system", F.lit(system.strip())))
    msgs.append(message("user", strip_ws(_c(question).cast("string"))))
    if answer is not None:
        msgs.append(message("assistant", strip_ws(_c(answer).cast("string"))))
    return F.array(*msgs)


def _role_name(role: Column, template: ChatTemplate) -> Column:
    expr = role
    for src, dst in template.role_names:
        expr = F.when(role == src, F.lit(dst)).otherwise(expr)
    return expr


def render_chat(messages, template: ChatTemplate = TURN_TEMPLATE, add_generation_prompt: bool = False) -> Column:
    """One text per chat (F19): bos, then ``open(role) content close`` per
    message, then the generation prompt if asked for."""
    before, after = template.open.split("{role}", 1)

    def one(m):
        return F.concat(F.lit(before), _role_name(m["role"], template), F.lit(after),
                        F.coalesce(m["content"], F.lit("")), F.lit(template.close))

    body = F.array_join(F.transform(_c(messages), one), "")
    parts = [F.lit(template.bos), body]
    if add_generation_prompt:
        parts.append(F.lit(template.generation_prompt))
    return F.concat(*parts)


def template_kind(text) -> Column:
    """``turn`` if the text has the turn marker, else ``start_of_turn`` if it
    has that one, else null: unknown (F7)."""
    t = _c(text)
    return F.when(t.contains(TURN_MARKER), F.lit("turn")).when(t.contains(START_OF_TURN_MARKER), F.lit("start_of_turn"))


def _quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def response_spans(text, instruction_part: str, response_part: str) -> Column:
    """The parts of a rendered chat that count for training (F20): each
    piece after a response marker, cut at the next instruction marker."""
    parts = F.split(_c(text), _quote(response_part))
    after = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(after, lambda p: F.element_at(F.split(p, _quote(instruction_part)), 1))


def span_offsets(text, instruction_part: str, response_part: str) -> Column:
    """``array<struct<start, end>>`` of the response spans in characters (from
    0, end exclusive)."""
    parts = F.split(_c(text), _quote(response_part))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc, p):
        span = F.struct(acc["at"].alias("start"), (acc["at"] + F.length(F.element_at(F.split(p, _quote(instruction_part)), 1))).alias("end"))
        # the piece before the first marker is no response
        return F.struct((acc["at"] + F.length(p) + F.lit(len(response_part))).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(parts, zero, add)["spans"]
    return F.slice(spans, 2, F.greatest(F.size(spans) - 1, F.lit(0)))


def word_tokens(df: DataFrame, text: str, id_col: str = "id") -> DataFrame:
    """``id, token_no, start, end`` of the runs of characters that aren't
    blanks, tabs or line breaks: a tokenizer for ``response_mask``."""
    pieces = F.split(F.col(text), "(?<=[ \\t\\n\\r])(?=[^ \\t\\n\\r])")  # a word with the blanks behind it
    each = df.select(F.col(id_col).alias("_id"), F.posexplode(pieces).alias("_i", "_w"))
    before = Window.partitionBy("_id").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_w")).over(before), F.lit(0)).cast("int")
    word = F.regexp_replace("_w", "[ \\t\\n\\r]+$", "")
    own = each.select(F.col("_id").alias(id_col), F.col("_i").cast("long").alias("token_no"), start.alias("start"), F.length(word).alias("_n"))
    return own.where("_n > 0").select(id_col, "token_no", "start", (F.col("start") + F.col("_n")).alias("end"))


# Characters of a position bin of ``response_mask``.
MASK_BIN = 512


def response_mask(tokens: DataFrame, spans: DataFrame, id_col: str = "id", bin_chars: int = MASK_BIN) -> DataFrame:
    """``id, mask``: for each chat an array with 1 for every token that lies
    wholly in a response span, else 0 (F20). ``tokens``: ``id, token_no, start,
    end`` of any tokenizer; ``spans``: ``id, start, end``, not overlapping. An
    interval join by bins of the position: a token has one bin, a span those
    it covers, so a long chat's tokens meet only the spans near them. Chats
    without spans get zeros; chats without tokens have no row."""
    own = tokens.select(F.col(id_col).alias("_id"), "token_no", F.col("start").alias("_s"), F.col("end").alias("_e"),
                        F.floor(F.col("start") / F.lit(bin_chars)).alias("_bin"))
    full = spans.where("start < end").select(F.col(id_col).alias("_span_id"), "start", "end", F.explode(F.sequence(
        F.floor(F.col("start") / F.lit(bin_chars)), F.floor((F.col("end") - 1) / F.lit(bin_chars)))).alias("_span_bin"))
    inside = (own["_id"].eqNullSafe(full["_span_id"])) & (own["_bin"] == full["_span_bin"]) & (F.col("_s") >= F.col("start")) & (F.col("_e") <= F.col("end"))
    marked = own.join(full, inside, "left").select("_id", F.struct("token_no", F.col("start").isNotNull().cast("int").alias("on")).alias("t"))
    out = marked.groupBy("_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return out.select(F.col("_id").alias(id_col), F.col("t.on").alias("mask"))


# A prompt template of our own for generation requests (F8).
PROMPT_TEMPLATE = (
    "Generate {n} question-and-answer pair(s) about '{category}'. Return a JSON array of objects "
    'with exactly the keys "category", "question", "answer".'
)


def build_prompt(category, n: int = 1, template: str = PROMPT_TEMPLATE) -> Column:
    filled = template.replace("{n}", str(n))
    return F.replace(F.lit(filled), F.lit("{category}"), _c(category))


def training_plan(df: DataFrame, epochs: int = 10, batch_size: int = 4, grad_accumulation: int = 4,
                  warmup_ratio: float = 0.03) -> DataFrame:
    """Optimiser steps and warm-up steps for a training split (A11):
    ``ceil(n * epochs / (batch * accumulation))`` and ``ceil(steps * ratio)``."""
    per_step = batch_size * grad_accumulation
    n = F.count(F.lit(1))
    steps = F.ceil(n * F.lit(epochs) / F.lit(float(per_step)))
    return df.agg(n.cast("long").alias("n_rows"), steps.cast("long").alias("total_steps")).select(
        "n_rows", "total_steps", F.ceil(F.col("total_steps") * F.lit(float(warmup_ratio))).cast("long").alias("warmup_steps")
    )


def plan_numbers(n: int, epochs: int = 10, batch_size: int = 4, grad_accumulation: int = 4,
                 warmup_ratio: float = 0.03) -> tuple[int, int]:
    """Plain-Python restatement of ``training_plan`` for one known count."""
    steps = math.ceil(n * epochs / (batch_size * grad_accumulation))
    return steps, math.ceil(steps * warmup_ratio)
