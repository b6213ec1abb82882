"""Repair of conversations to the role sequence ``(s?(ua)+)?``.

Rows are put into order over ranges, so that a conversation with a third of
all rows lies in many of them. A row's symbol is its role's initial and its
fault. Every block of up to ``BLOCK`` rows of a conversation is collapsed to
runs of equal symbols, and its min-plus transition is the product of the
runs' transitions, each from cached binary powers of its symbol's. From the
transitions, taken from a conversation's end, each block gets the least
costs behind it; the last pass goes forward through a conversation's blocks,
unrolls the cheapest edits and digests the repaired text. It streams: it
holds a block, and no conversation, in memory (but for its audit, which is
its result; one digest of one text can't be taken in parts).

States: nothing yet (0), after a system row (1), user row (2), assistant row
(3); 0 and 3 may end. Given a state, what an edit may give is settled (user
after 0, 1 and 3, assistant after 2), so an audit has one repaired text.

Defined cases: null roles and texts are read as one space, null ids and turns
are one space in the damage key; null turns come first, rows of one turn in
the order of role, then text; a null conv_id is one conversation; repeated
rows are rows; an empty role can't be kept; a conversation without rows after
the damage, or whose rows all go, has an empty audit or one of deletions and
the empty text's hash; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.llm.common import materialise, prepare
from qaspark.operators.order import _B, _P, tag_ranges

BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, LEFT_TRUNCATED = 0, 1, 2, 5, 5
INF = 1 << 40
STATES = range(4)
FAULTS = ("", "blank", "duplicate", "truncated")
_SPACES = " \t\n\x0b\x0c\r"


# --- rows -------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage, with the order columns
    ``role0, text0, copy``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role0"), space("text").alias("text0"), fate.alias("fate"))
    rows = rows.where("fate <> 0").withColumn("copy", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text0", ".!?", "")).otherwise(F.col("text0"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role0"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "role0", "text0", "copy")


def _fault(first: Column) -> Column:
    """Number of a row's fault in ``FAULTS``."""
    solid = F.translate("text", _SPACES, "")
    cut = ~F.substring(solid, -1, 1).isin(".", "!", "?")
    return F.when(solid == "", 1).when(~first, 2).when(cut, 3).otherwise(0)


def marked_rows(conversations: DataFrame) -> DataFrame:
    """Damaged rows with their range, place and fault."""
    tagged = tag_ranges(damaged(conversations), [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role0"), F.col("text0"), F.col("copy")])
    tagged = tagged.select("conv_id", "turn", "role", "text", F.col(_B).alias("part"), (F.shiftleft(F.col(_B), 36) + F.col(_P)).alias("pos"))
    firsts = tagged.groupBy("conv_id", "role", "text").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    out = tagged.join(firsts, "pos", "left").withColumn("fault", _fault(F.coalesce("first", F.lit(False))))
    return materialise(out.drop("first"), "marked-turns")


# --- the transition of a symbol ------------------------------------------------

def symbol(role: str, fault: int) -> str:
    """Initial (``u``, ``a``, ``s`` or ``-``), then ``!`` if the row is
    truncated; ``x`` if it must go."""
    if fault in (1, 2):
        return "x"
    initial = role[:1] if role[:1] in ("u", "a", "s") else "-"
    return initial + ("!" if fault == 3 else "")


def _next(state: int) -> int:
    """State after a user or assistant row, whichever may follow."""
    return 3 if state == 2 else 2


@functools.cache
def choices(sym: str) -> tuple:
    """For each state, the edits of one row in ASCII order: initial, cost,
    state after."""
    extra = LEFT_TRUNCATED if sym.endswith("!") else 0
    out = []
    for q in STATES:
        own = [("D", DELETE, q)]
        if sym != "x":
            kept = 1 if sym[0] == "s" and q == 0 else _next(q) if sym[0] == ("a" if q == 2 else "u") else None
            if kept is not None:
                own.append(("K", KEEP + extra, kept))
            own.append(("R", REROLE + extra, _next(q)))
        out.append(tuple(own))
    return tuple(out)


def _product(x, y):
    return tuple(tuple(min(x[i][k] + y[k][j] for k in STATES) for j in STATES) for i in STATES)


def through(matrix, behind):
    """Least costs before, from a transition and the least costs behind."""
    return tuple(min(matrix[i][k] + behind[k] for k in STATES) for i in STATES)


def _inserts():
    step = [[0 if i == j else INF for j in STATES] for i in STATES]
    for q in STATES:
        step[q][_next(q)] = INSERT
    step = tuple(map(tuple, step))
    return _product(_product(step, step), step)


UNIT = tuple(tuple(0 if i == j else INF for j in STATES) for i in STATES)
INSERTS = _inserts()
BEHIND_ALL = through(INSERTS, (0, INF, INF, 0))


@functools.cache
def power(sym: str, k: int):
    """Transition of ``2 ** k`` rows of one symbol."""
    if k:
        half = power(sym, k - 1)
        return _product(half, half)
    one = [[INF] * 4 for _ in STATES]
    for q, own in enumerate(choices(sym)):
        for _, cost, to in own:
            one[q][to] = min(one[q][to], cost)
    return _product(INSERTS, one)


def runs(symbols) -> list[list]:
    out: list[list] = []
    for s in symbols:
        if out and out[-1][0] == s:
            out[-1][1] += 1
        else:
            out.append([s, 1])
    return out


def _before_run(sym: str, n: int, behind):
    """Least costs before ``n`` rows of one symbol, by the bits of ``n``."""
    k = 0
    while n:
        if n & 1:
            behind = through(power(sym, k), behind)
        n, k = n >> 1, k + 1
    return behind


def transition(symbols):
    """Min-plus transition of a block of rows."""
    out = UNIT
    for sym, n in runs(symbols):
        k = 0
        while n:
            if n & 1:
                out = _product(out, power(sym, k))
            n, k = n >> 1, k + 1
    return out


# --- passes over ordered rows -----------------------------------------------------

_COSTS = [f"c{i}{j}" for i in STATES for j in STATES]
_V = [f"v{i}" for i in STATES]


def _blocks(batches, conv_type):
    """A row with the transition of every block: rows of one conversation in
    one range, up to ``BLOCK``."""
    now = None  # conversation, range, first place, symbols

    def row(b):
        return (b[0], b[2], *[c for line in transition(b[3]) for c in line])

    for batch in batches:
        out = []
        for conv, part, pos, role, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "part", "pos", "role", "fault")], strict=True):
            if now is None or now[0] != conv or now[1] != part or len(now[3]) >= BLOCK:
                if now:
                    out.append(row(now))
                now = (conv, part, pos, [])
            now[3].append(symbol(role, fault))
        yield _batch(out, ["conv_id", "pos", *_COSTS], conv_type)
    if now:
        yield _batch([row(now)], ["conv_id", "pos", *_COSTS], conv_type)


def _batch(rows, names, conv_type):
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.record_batch([pa.array(c, conv_type if n == "conv_id" else None if rows and isinstance(c[0], str) else pa.int64()) for n, c in zip(names, cols, strict=True)], names)


def _behind(batches, conv_type):
    """From blocks with the last of a conversation first, the least costs
    behind each block."""
    conv, behind, begun = None, BEHIND_ALL, False
    for batch in batches:
        out = []
        for values in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "pos", *_COSTS)], strict=True):
            if not begun or values[0] != conv:
                conv, behind, begun = values[0], BEHIND_ALL, True
            out.append((conv, values[1], *behind))
            c = values[2:]
            behind = through((c[0:4], c[4:8], c[8:12], c[12:16]), behind)
        yield _batch(out, ["conv_id", "pos", *_V], conv_type)


class _Conversation:
    """Running result of one conversation."""

    def __init__(self):
        self.state, self.cost, self.audit, self.sha, self.lines = 0, 0, [], hashlib.sha256(), 0
        self.counts = [0, 0, 0, 0]
        self.illegal, self.initial = 0, None
        self.low = self.high = None
        self.turns = 0

    def line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def edit(self, what: str, cost: int, to: int, role: str = "", text: str = "") -> None:
        self.audit.append(what)
        self.cost += cost
        if what != "D":
            self.line(role if what == "K" else "user" if to == 2 else "assistant", text)
        self.state = to

    def seen(self, turn, role: str, fault: int) -> None:
        self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1

    def block(self, rows, behind) -> None:
        """Unroll a block's cheapest edits, given the costs behind it."""
        symbols = [symbol(role, fault) for _, role, _, fault in rows]
        spans, after = runs(symbols), [behind]
        for sym, n in reversed(spans):
            after.append(_before_run(sym, n, after[-1]))
        at = 0
        for (sym, n), end in zip(spans, reversed(after[:-1]), strict=True):
            costs = [end]
            for _ in range(n):
                costs.append(through(power(sym, 0), costs[-1]))
            for i in range(n):
                now, rest = costs[n - i], costs[n - i - 1]
                turn, role, text, fault = rows[at]
                self.seen(turn, role, fault)
                self.row(choices(sym), now, rest, role, text)
                at += 1

    def row(self, edits, now, rest, role: str, text: str) -> None:
        while True:
            for what, cost, to in edits[self.state]:
                if what > "I" and INSERT + now[_next(self.state)] == now[self.state]:
                    break  # an insert comes before K and R
                if cost + rest[to] == now[self.state]:
                    self.edit(what, cost, to, role, text)
                    return
            self.edit("I", INSERT, _next(self.state))

    def result(self) -> tuple:
        while BEHIND_ALL[self.state]:
            self.edit("I", INSERT, _next(self.state))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, *self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _results(batches, conv_type):
    """Results from rows ordered by conversation and place; before a block's
    rows stands the row with the costs behind it."""
    conv, now, held, behind = None, None, [], None
    for batch in batches:
        out = []
        for c, kind, turn, role, text, fault, *v in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "kind", "turn", "role", "text", "fault", *_V)], strict=True):
            if now is None or c != conv or kind < 2:
                if held:
                    now.block(held, behind)
                    held = []
                if now is None or c != conv:
                    if now:
                        out.append((conv, *now.result()))
                    conv, now = c, _Conversation()
            if kind == 1:
                behind = tuple(v)
            elif kind == 2:
                held.append((turn, role, text, fault))
        yield _result_batch(out, conv_type)
    if now:
        if held:
            now.block(held, behind)
        yield _result_batch([(conv, *now.result())], conv_type)


def _result_batch(rows, conv_type):
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 9
    types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["conv_id", *_RESULT])


def repair(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` for every conversation."""
    prepare(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    conv_type = pa.string() if kind == "string" else pa.int64()
    if kind != "string":
        kind, conversations = "bigint", conversations.withColumn("conv_id", F.col("conv_id").cast("long"))
    rows = marked_rows(conversations)
    ordered = rows.select("conv_id", "part", "pos", "role", "fault").repartition("part").sortWithinPartitions("part", "pos")
    costs = ", ".join(f"{c} long" for c in _COSTS)
    blocks = ordered.mapInArrow(lambda b: _blocks(b, conv_type), f"conv_id {kind}, pos long, {costs}")
    blocks = blocks.repartition("conv_id").sortWithinPartitions("conv_id", F.col("pos").desc())
    behind = blocks.mapInArrow(lambda b: _behind(b, conv_type), f"conv_id {kind}, pos long, " + ", ".join(f"{c} long" for c in _V))
    # kind 0: the conversation is there, 1: costs behind a block, 2: a row
    ids = conversations.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("kind"))
    every = ids.unionByName(behind.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    every = every.unionByName(rows.drop("part").withColumn("kind", F.lit(2)), allowMissingColumns=True)
    every = every.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")
    counts = ", ".join(f"{c} long" for c in _RESULT[:6])
    return every.mapInArrow(lambda b: _results(b, conv_type), f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


# --- DuckDB text --------------------------------------------------------------------

def _sql() -> str:
    """Forward over a conversation's rows: per state the least cost, audit
    and repaired text, as a struct whose order is that of the contract."""
    inf = 1000000000
    add = lambda s, c, a, t: f"{{'c': {s}.c + {c}, 'a': {s}.a || '{a}', 't': {s}.t || {t}}}"
    line = lambda s, role, text: f"case when {s}.t = '' then '' else chr(10) end || {role} || ':' || {text}"
    ins = lambda s, role: add(s, 5, "I", line(s, f"'{role}'", "''"))
    least = lambda *x: "list_min([" + ", ".join(x) + "])"
    never = f"{{'c': {inf}, 'a': '', 't': ''}}"
    when = lambda cond, x: f"case when {cond} then {x} else {never} end"
    keep = lambda s: add(s, "5 * tr", "K", line(s, "role", "text"))
    rerole = lambda s, role: add(s, "1 + 5 * tr", "R", line(s, f"'{role}'", "text"))
    drop = lambda s: add(s, 2, "D", "''")
    to_user = [x for s in ("s0", "s1", "n3") for x in (when("sym = 'u'", keep(s)), when("sym <> 'x'", rerole(s, "user")))]
    return f"""with recursive crc0(i, k, v) as (
  select i, 0, i from range(256) r(i)
  union all select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from crc0 where k < 8),
crc as (select list(v order by i) as t from crc0 where k = 8),
o as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
f as (select o.*, xor(list_reduce(list_transform(range(0, len(k)), lambda i: ascii(substr(k, i + 1, 1))::bigint),
        lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as int) + 1]), 4294967295), 4294967295) % 20 as fate from o, crc),
d as (select conv_id, turn, role as role0, text as text0, copy, case when fate = 4 then 'user' else role end as role,
        case when fate = 1 then '' when fate = 2 then translate(text, '.!?', '') else text end as text
      from f, range(2) r(copy) where fate <> 0 and (copy = 0 or fate = 3)),
n as (select *, row_number() over (partition by conv_id order by turn nulls first, role0, text0, copy) as i,
        translate(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') as solid from d),
p as (select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
        lag(left(role, 1)) over (partition by conv_id order by i) as before from n),
e as (select *, case when solid = '' then 'blank' when again then 'duplicate'
        when right(solid, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from p),
y as (select conv_id, i, role, text, case when fault = 'truncated' then 1 else 0 end as tr,
        case when fault in ('blank', 'duplicate') then 'x' when left(role, 1) in ('u', 'a', 's') then left(role, 1) else '-' end as sym from e),
ids as (select distinct conv_id from conversations),
z(conv_id, i, s0, s1, s2, s3) as (
  select conv_id, 0::bigint, {{'c': 0, 'a': '', 't': ''}}, {never}, {never}, {never} from ids
  union all
  select conv_id, i, {drop('s0')}, {least(drop('s1'), when("sym = 's'", keep('s0')))},
    {least(drop('n2'), *to_user)}, {least(drop('n3'), when("sym = 'a'", keep('n2')), when("sym <> 'x'", rerole('n2', 'assistant')))}
  from (select *, {least('s3', ins('n2', 'assistant'))} as n3 from (
    select z.conv_id, y.i, y.role, y.text, y.tr, y.sym, s0, s1, s3, {least('s2', ins('s0', 'user'), ins('s1', 'user'), ins('s3', 'user'))} as n2
    from z join y on y.conv_id is not distinct from z.conv_id and y.i = z.i + 1) q1) q2),
last_ as (select conv_id, max(i) as i from z group by conv_id),
g as (select z.conv_id, least_ as r from (
  select conv_id, i, {least('s0', 's3', ins('n2', 'assistant'))} as least_ from (
    select *, {least('s2', ins('s0', 'user'), ins('s1', 'user'), ins('s3', 'user'))} as n2 from z) q) z
  join last_ l on l.conv_id is not distinct from z.conv_id and l.i = z.i),
c as (select conv_id, case when count(turn) = 0 then 0 else max(turn) - min(turn) + 1 - count(distinct turn) end as gaps,
  count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
  count(*) filter (fault = 'truncated') as truncated,
  count(*) filter (before is not null and before || left(role, 1) not in ('su', 'ua', 'au')) as illegal from e group by conv_id)
select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, g.r.c::bigint as cost, g.r.a as audit,
  sha256(g.r.t) as repaired_sha256
from ids join g on g.conv_id is not distinct from ids.conv_id left join c on c.conv_id is not distinct from ids.conv_id"""


REPAIR_SQL = _sql()
