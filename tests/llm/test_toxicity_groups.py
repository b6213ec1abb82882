"""Batch scores of texts against a plain per-text version, and near copies in
one large group."""

import random
import re

import numpy as np

from qaspark.llm import neardup, toxicity

DOC = "doc_id long, text string, score double"


def _plain_grams(word):
    """Buckets of a word's n-grams in plain Python."""
    mask = 2**64 - 1

    def mix(x):
        x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 & mask
        return (x ^ (x >> 29)) % toxicity.BUCKETS

    chars = [1, *map(ord, word), 2]
    out = []
    for n in toxicity.NGRAMS:
        for i in range(len(chars) - n + 1):
            h = chars[i] + 1
            for c in chars[i + 1 : i + n]:
                h = (h * 0x9E3779B97F4A7C15 + c) & mask
            out.append(mix(h + n & mask))
    power, total = 1, 0
    for c in chars:
        power = power * 0xC2B2AE3D27D4EB4F & mask
        total = (total + (c + 7) * power) & mask
    return [*out, mix(total)]


def _plain_score(text, model):
    words = re.findall(r"\w+", (text or "").lower())
    s = [np.mean(model["scores"][_plain_grams(w)]) for w in words]
    bags = [np.mean(s[i : i + toxicity.BAG_WORDS]) for i in range(0, len(s), toxicity.BAG_WORDS)]
    a, b, c = model["curve"]
    logit, size = (max(bags) + model["bias"], np.log(len(bags))) if bags else (model["bias"], 0.0)
    p = 1 / (1 + np.exp(-np.clip(a * logit + b * size + c, -500, 500)))
    return p if words else min(p, 0.49)


def test_batch_scores_equal_plain_ones(monkeypatch):
    rng = np.random.default_rng(3)
    model = {"scores": rng.normal(0, 1, toxicity.BUCKETS), "bias": -0.3, "curve": np.array([1.1, -0.2, 0.4])}
    texts = [None, "", " .,! ", "a", "Ab_c 9x ÀÉ ß 中文 𝒳1 İx", "x" * 700 + " y", "one two three four", "\ud800 z", "a\x00b"]
    texts += [" ".join(random.Random(i).choices(["don't", "Wörter", "naïve", "x1"], k=i * 7)) for i in range(30)]
    for points in (1 << 18, 50):
        monkeypatch.setattr(toxicity, "POINTS", points)
        got = np.concatenate([toxicity.text_scores(p, model) for p in toxicity._parts(texts)])
        assert np.allclose(got, [_plain_score(t, model) for t in texts], atol=1e-12)


def _prose(rng, n):
    return " ".join(rng.choice("the of and to in er on an re he est ting thre".split()) + str(rng.randrange(30)) for _ in range(n))


def test_misspellings_long_texts_null_ids_and_one_class(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        w = _prose(rng, 40).split()
        bad = i % 3 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(40)] = rng.choice(["moronic", "idiotic", "scumbag"])
        rows.append((i, " ".join(w), 0.5))
        labels.append((i, int(bad)))
    calm = _prose(rng, 30_000)
    rows += [(9001, _prose(rng, 20) + " you idiotik idi0tic moronik scumbagg " + _prose(rng, 15), 0.5), (9002, calm, 0.5),
             (9003, calm[: len(calm) // 2] + " moronic idiotic scumbag moronic idiotic scumbag " + calm[len(calm) // 2 :], 0.5),
             (None, None, 0.5), (None, "moronic idiotic scumbag", 0.5), (9004, _prose(rng, 40), 0.5)]
    docs = spark.createDataFrame(rows, DOC)
    y = spark.createDataFrame(labels + [(None, 1), (1, 1), (1, 0)], "doc_id long, toxic long")
    got = toxicity.score(docs, toxicity.fit(docs, y)).collect()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[9001]["predicted"] == 1 and by[9003]["score"] > by[9002]["score"] and by[9004]["predicted"] == 0
    assert len(got) == len(rows) and sum(r["doc_id"] is None and not r["held_out"] for r in got) == 2
    one = toxicity.score(docs, toxicity.fit(docs, y.where("toxic = 1"))).collect()
    assert all(r["predicted"] == 0 for r in one)
    # a class whose texts are all over the bound is learnt from their beginnings
    long = spark.createDataFrame([(i, t + " " + t * 30 if i % 3 == 0 else t, 0.5) for i, t, _ in rows[:500]], DOC)
    model = toxicity.fit(long, y.where("doc_id is not null"))
    assert model["scores"].any()


def test_near_copies_of_one_group_stay_linear(spark):
    """Hundreds of near copies: linked as by brute force, with few pairs."""
    rng = random.Random(7)
    base = _prose(rng, 150).split()
    texts = []
    for _ in range(400):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(150)] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    pairs = []
    own = neardup._with_registers

    def counted(p, sets, percent):
        pairs.append(p.count())
        return own(p, sets, percent)

    neardup._with_registers = counted
    try:
        got = neardup.near_duplicates(spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], DOC)).collect()
    finally:
        neardup._with_registers = own
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for t in texts]
    low = list(range(400))
    near = [(i, j) for i in range(400) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            m = min(low[i], low[j])
            changed |= low[i] != m or low[j] != m
            low[i] = low[j] = m
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(low))
    assert sum(pairs) <= 8 * 400
