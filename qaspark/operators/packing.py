"""Exact packing of an ordered call log into budgeted slots.

The rule is greedy and sequential: a slot takes calls in order while their
tokens (and their number) stay within the budget, and the first call that
no longer fits opens the next slot. It is computed without a sequential pass
over the log:

1. *Where would a slot that opens here end?* For every call, the first call
   that no longer fits is a search in the prefix sums: calls, at their prefix
   sum, and probes, at the sum up to the call before plus the budget, are
   brought into one order over ranges, and a probe's count of calls before it
   is its answer.
2. *Which calls open a slot?* Those on the chain of such jumps from the first
   call. The log is cut into blocks of neighbouring calls; only calls that a
   jump from another block reaches can be a block's first opening, and they
   are at most as many as a slot's calls. For each of them its block tells
   the call at which its chain leaves. The chain over blocks is then found by
   pointer doubling, in rounds that grow with the logarithm of the number of
   blocks.
3. Every block follows the chain from its one first opening, and slots are
   numbered by the openings in earlier blocks.

A call above the budget has a slot of its own. Null or negative tokens count
as none. Calls are ordered by time, then id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaspark.operators.order import running_sums
from qaspark.session import ship_package

BLOCK = 1 << 16


def first_misfits(calls: DataFrame, order: list, tokens: str, budget: int, max_calls: int | None = None) -> DataFrame:
    """``calls`` with ``_pos`` (from 1, by ``order``) and ``_next``: the place
    of the first later call that doesn't fit into a slot opened here (one
    after the last call, if all fit)."""
    size = F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.lit(0))
    rows = calls.withColumn("_size", size.cast("long")).withColumn("_one", F.lit(1).cast("long"))
    placed = running_sums(rows, order, {"_run": "_size", "_pos": "_one"}).drop("_one").checkpoint(eager=True)
    ends = placed.select(F.col("_run").alias("_at"), F.lit(0).alias("_probe"), F.lit(1).cast("long").alias("_call"), F.lit(None).cast("long").alias("_pos"))
    probes = placed.select((F.col("_run") - F.col("_size") + F.lit(int(budget))).alias("_at"), F.lit(1).alias("_probe"), F.lit(0).cast("long").alias("_call"), "_pos")
    # calls sort before probes of the same value: a slot may be filled to the budget
    counted = running_sums(ends.unionByName(probes), ["_at", "_probe", "_pos"], {"_fit": "_call"}).where("_probe = 1")
    found = counted.select(F.col("_pos").alias("_p"), F.greatest(F.col("_fit"), F.col("_pos")).alias("_last"))
    nxt = F.col("_last") + 1
    if max_calls:
        nxt = F.least(nxt, F.col("_pos") + F.lit(int(max_calls)))
    return placed.join(found, F.col("_pos") == F.col("_p")).withColumn("_next", nxt.cast("long")).drop("_p", "_last", "_size", "_run")


def _in_blocks(jumps: DataFrame, marks: DataFrame, block: int) -> DataFrame:
    """Calls of each block in order, the block's marked calls before them."""
    of = lambda c: F.floor((F.col(c) - 1) / F.lit(block)).cast("long")
    rows = jumps.select(of("_pos").alias("_block"), F.lit(1).alias("_kind"), "_pos", "_next")
    entries = marks.select(of("_pos").alias("_block"), F.lit(0).alias("_kind"), "_pos", F.lit(None).cast("long").alias("_next"))
    return rows.unionByName(entries).repartition("_block").sortWithinPartitions("_block", "_kind", "_pos")


def _blocks(batches):
    """``marks, first place, jumps`` of one block after another."""
    block, parts = None, []

    def whole():
        kind, pos, nxt = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return block, pos[kind == 0], pos[kind == 1], nxt[kind == 1]

    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_block", "_kind", "_pos")]
        nxt = batch.column("_next").fill_null(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(cols[0])) + 1).tolist(), len(nxt)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if parts and cols[0][a] != block:
                yield whole()
                parts = []
            block = int(cols[0][a])
            parts.append((cols[1][a:b], cols[2][a:b], nxt[a:b]))
    if parts:
        yield whole()


def _exits(batches):
    """For each marked call, where its chain leaves the block: jumps inside
    the block are doubled until all point outside."""
    for _, marks, pos, nxt in _blocks(batches):
        if not len(marks) or not len(pos):
            continue
        first, to = pos[0], nxt.copy()
        while True:
            inside = to < first + len(pos)
            if not inside.any():
                break
            to[inside] = to[to[inside] - first]
        yield pa.record_batch([pa.array(marks), pa.array(to[marks - first])], ["_pos", "_to"])


def _openings(batches):
    """Every call with the number of openings of its block up to it."""
    for block, marks, pos, nxt in _blocks(batches):
        if not len(pos):
            continue
        opens = np.zeros(len(pos), np.int64)
        first = int(pos[0])
        at = int(marks[0]) if len(marks) else first + len(pos)
        while at < first + len(pos):
            opens[at - first] = 1
            at = int(nxt[at - first])
        yield pa.record_batch([pa.array(np.full(len(pos), block)), pa.array(pos), pa.array(np.cumsum(opens)), pa.array(opens)], ["_block", "_pos", "_upto", "_opens"])


def _on_chain(hops: DataFrame, start: DataFrame) -> DataFrame:
    """Nodes on the chain from ``start``: in round k the nodes less than
    2 ** k hops away are known, and hops reach 2 ** k nodes on."""
    known, hops = start, hops.checkpoint(eager=True)
    nodes, n_known = hops.select("_pos"), 1
    while True:
        further = known.join(hops, "_pos").select(F.col("_to").alias("_pos"))
        known = known.unionByName(further.join(nodes, "_pos", "left_semi")).distinct().checkpoint(eager=True)
        n = known.count()
        if n == n_known:
            return known
        n_known = n
        onward = hops.select(F.col("_pos").alias("_to"), F.col("_to").alias("_far"))
        hops = hops.join(onward, "_to").select("_pos", F.col("_far").alias("_to")).checkpoint(eager=True)


def pack_calls(calls: DataFrame, ts: str = "ts", id_col: str = "event_id", tokens: str = "tokens", budget: int = 4200,
               max_calls: int | None = None, block: int = BLOCK) -> DataFrame:
    """Exact greedy slots of calls in time order: ``id, slot`` (from 0) and
    ``opens``, whether the call opens its slot."""
    ship_package(calls.sparkSession)
    jumps = first_misfits(calls.select(id_col, ts, tokens), [ts, id_col], tokens, budget, max_calls)
    jumps = jumps.select(F.col(id_col).alias("_id"), "_pos", "_next").checkpoint(eager=True)
    start = calls.sparkSession.range(1, 2).select(F.col("id").alias("_pos"))
    crossing = F.floor((F.col("_next") - 1) / F.lit(block)) > F.floor((F.col("_pos") - 1) / F.lit(block))
    entries = jumps.where(crossing).select(F.col("_next").alias("_pos")).unionByName(start).distinct()
    hops = _in_blocks(jumps, entries.join(jumps.select("_pos"), "_pos", "left_semi"), block).mapInArrow(_exits, "_pos long, _to long")
    firsts = _on_chain(hops, start)
    rows = _in_blocks(jumps, firsts, block).mapInArrow(_openings, "_block long, _pos long, _upto long, _opens long").checkpoint(eager=True)
    per = rows.groupBy("_block").agg(F.sum("_opens").alias("_n"))  # a row for each block
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = rows.join(per.select("_block", before.alias("_before")), "_block")
    slots = numbered.select("_pos", (F.col("_before") + F.col("_upto") - 1).cast("long").alias("slot"), (F.col("_opens") == 1).alias("opens"))
    return jumps.join(slots, "_pos").select(F.col("_id").alias(id_col), "slot", "opens")
