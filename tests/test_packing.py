"""Exact packing against the sequential rule."""

import random

import pytest

from qaspark.operators.packing import pack_calls


def _greedy(calls, budget, max_calls):
    out, slot, used, n = {}, -1, 0, 0
    for ts, event_id, tokens in sorted(calls):
        tokens = max(tokens or 0, 0)
        opens = slot < 0 or used + tokens > budget or (max_calls and n >= max_calls)
        if opens:
            slot, used, n = slot + 1, 0, 0
        used, n = used + tokens, n + 1
        out[event_id] = (slot, bool(opens))
    return out


def _calls(rng):
    """A burst at one time holds a third of the calls; some are above the
    budget, empty or without tokens."""
    calls = [(rng.randrange(10_000), i, rng.choice([None, 0, 5, 40, 300, 999, 1000, 1001, 5000, -3])) for i in range(300)]
    return calls + [(777, 1000 + i, rng.choice([1, 2, 250])) for i in range(150)]


@pytest.mark.parametrize("max_calls,block", [(None, 7), (9, 64), (None, 1 << 16)])
def test_packing_equals_the_sequential_rule(spark, max_calls, block):
    calls = _calls(random.Random(block))
    df = spark.createDataFrame(calls, "ts long, event_id long, tokens long").repartition(5)
    got = pack_calls(df, budget=1000, max_calls=max_calls, block=block).collect()
    assert {r["event_id"]: (r["slot"], r["opens"]) for r in got} == _greedy(calls, 1000, max_calls)
    assert len(got) == len(calls)


def test_packing_edges(spark):
    none = spark.createDataFrame([], "ts long, event_id long, tokens long")
    assert pack_calls(none).count() == 0
    free = spark.createDataFrame([(1, i, None) for i in range(40)], "ts long, event_id long, tokens long")
    assert {(r["slot"], r["opens"]) for r in pack_calls(free, block=4).collect() if r["event_id"]} == {(0, False)}
