"""Groups of near copies that the stars don't merge: the prefix filter finds
every link, and a template whose texts have enough words of their own isn't
compared pair by pair."""

import random

import pytest

from qaspark.llm import neardup

DOC = "doc_id long, text string, key string"


def _edited(rng, words, edits, name):
    """The words with ``edits`` of them replaced, far from one another."""
    w = list(words)
    for i in range(edits):
        w[5 + 10 * i + rng.randrange(4)] = f"{name}e{i}"
    return w


def _components(sets, percent):
    low = list(range(len(sets)))
    near = [
        (i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            m = min(low[i], low[j])
            changed |= low[i] != m or low[j] != m
            low[i] = low[j] = m
    return low, near


def _run(spark, texts, percent, monkeypatch):
    pairs, with_registers = [], neardup._with_registers

    def counted(p, sets, at):
        pairs.append(p.count())
        return with_registers(p, sets, at)

    monkeypatch.setattr(neardup, "_with_registers", counted)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], DOC)
    got = neardup.near_duplicates(docs, percent=percent).collect()
    return {r["doc_id"]: r["component_id"] for r in got}, pairs


def _sets(texts):
    return [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]


@pytest.mark.parametrize("percent", [80, 85])
def test_links_beside_a_merged_group(spark, percent, monkeypatch):
    """Copies at every distance from one text, chains among them."""
    rng = random.Random(percent)
    base = [f"b{rng.randrange(10**6)}" for _ in range(150)]
    texts = [" ".join(_edited(rng, base, rng.choice([0, 1, 1, 2, 3, 4, 5, 6, 8]), f"d{i}")) for i in range(250)]
    for i in range(30):  # chains that start far from the base
        w = _edited(rng, base, 6, f"chain{i}")
        texts += [" ".join(w), " ".join(w[: 140 + rng.randrange(8)]), " ".join(w[:110] + [f"own{i}x{k}" for k in range(rng.randrange(30))])]
    rng.shuffle(texts)
    low, _ = _components(_sets(texts), percent)
    got, pairs = _run(spark, texts, percent, monkeypatch)
    assert got == dict(enumerate(low))
    assert 1 < len(set(low)) < len(low)


def test_a_template_below_the_threshold_stays_linear(spark, monkeypatch):
    """1,200 texts of one template, each with words of its own, linked with
    nothing, and 20 copies among them."""
    rng = random.Random(3)
    base = [f"b{rng.randrange(10**6)}" for _ in range(140)]
    plain = [" ".join([*base, *(f"own{i}x{k}" for k in range(24))]) for i in range(1200)]
    texts = plain + [f"{plain[7 * i]} end{i}" for i in range(20)]
    got, pairs = _run(spark, texts, 80, monkeypatch)
    assert got == {**{i: i for i in range(1200)}, **{1200 + i: 7 * i for i in range(20)}}
    assert sum(pairs) <= 12 * len(texts)


def test_a_shingle_of_many_holders_is_dealt(spark, monkeypatch):
    """The same rows with a deal of few holders."""
    monkeypatch.setattr(neardup, "HOLDERS", 8)
    rng = random.Random(9)
    base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join(_edited(rng, base, rng.choice([1, 2, 3, 4]), f"d{i}")) for i in range(120)]
    low, _ = _components(_sets(texts), 85)
    got, _ = _run(spark, texts, 85, monkeypatch)
    assert got == dict(enumerate(low))


def test_versions_of_an_id_and_repeated_rows(spark):
    """Repeated rows don't shift a prefix, versions of an id link apart."""
    rng = random.Random(4)
    base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(i, " ".join(_edited(rng, base, 5, f"d{i}")), "x") for i in range(40)]
    rows += [(100 + i, f"{t} end", "x") for i, t, _ in rows[:10]] + rows[:5]
    rows += [(0, " ".join(f"z{k}" for k in range(90)), "x"), (200, " ".join(f"z{k}" for k in range(89)), "x")]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, DOC), percent=80).collect()}
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t)
    ids = sorted(texts)
    low = {i: i for i in ids}
    near = [
        (i, j)
        for i in ids
        for j in ids
        if j < i and any(100 * len(x & y) >= 80 * len(x | y) for x in _sets(texts[i]) for y in _sets(texts[j]))
    ]
    for _ in ids:
        for i, j in near:
            low[i] = low[j] = min(low[i], low[j])
    assert got == low
