"""Resampling, repeated strings and conversation repair against brute force:
nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import itertools
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa

from qaspark.llm import importance, repair, repeats

DOC = "doc_id long, text string, n long, bucket string, key string, score double, start string, h string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", 0.5, "z", "w") for i, t in rows], DOC)


def _prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "dé", "x9", "of", "the"]) + str(rng.randrange(40)) for _ in range(n))


# --- op11 -------------------------------------------------------------------------

def _features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, w + [f"{a} {b}" for a, b in itertools.pairwise(w)]


def _resampled(rows, target):
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f in _features(x)[1]:
                counts[zlib.crc32(f.encode()) % 10_000] += 1
    gain = [math.floor(1000 * math.log((float(b) + 1) * (float(s.sum()) + 10_000) / ((float(a) + 1) * (float(t.sum()) + 10_000)))) for a, b in zip(s, t)]
    out = []
    for doc_id, x in rows:
        words, feats = _features(x)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_resample_equals_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "\x00\x1f -- \x7f", "word", "A" * 500 + " " + "b" * 70 + " c " + "é" * 40, "ÀÉ ß 中文 𝒳1", _prose(rng, 9000)]
    texts += [_prose(rng, rng.randrange(1, 90)) for _ in range(160)]
    rows = list(enumerate(texts)) + [(None, _prose(rng, 30)), (500, texts[20]), (501, texts[20])]
    target = [None, "", _prose(rng, 300), "alpha1 beta2"]
    for parts in (1, 7):
        docs = _docs(spark, rows).repartition(parts)
        got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == _resampled(rows, target)


def test_resample_edges(spark):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(_docs(spark, []), none).count() == 0
    # a third of all rows is one row again and again: equal scores, ranks of their own
    rng = random.Random(4)
    rows = [(7, _prose(rng, 25))] * 60 + [(i, _prose(rng, 25)) for i in range(100, 220)]
    got = importance.resample(_docs(spark, rows).repartition(5), none).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, 46)) and len({r["score"] for r in got if r["doc_id"] == 7}) == 1
    by_rank = sorted((r["rank"], -r["score"]) for r in got if r["rank"])
    assert [x for _, x in by_rank] == sorted(x for _, x in by_rank)
    assert max(-x for _, x in by_rank) >= max(r["score"] for r in got) and min(-x for _, x in by_rank) >= max(r["score"] for r in got if not r["rank"])


def test_features_of_long_words():
    text = b"a" * 64 + b" " + b"b" * 65 + b" c " + b"d" * 64
    _, bucket, words = importance.features(np.frombuffer(text, np.uint8), np.array([len(text)]))
    want = [zlib.crc32(f.encode()) % 10_000 for f in _features(text.decode())[1]]
    assert bucket.tolist() == want and words.tolist() == [4]


# --- op12 -------------------------------------------------------------------------

def _removed(rows):
    """Every window of 100 bytes, in the order of the ids."""
    seen, gone = set(), {}
    for k, (_, text) in enumerate(rows):
        data = (text or "").encode()
        out = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            w = data[p : p + 100]
            if w in seen:
                out[p : p + 100] = True
            seen.add(w)
        gone[k] = (data, out)
    res = []
    for k, (doc_id, _) in enumerate(rows):
        data, out = gone[k]
        spans = int((np.diff(np.concatenate(([0], out.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(data, out) if not g)
        res.append((doc_id, len(data), int(out.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(res, key=str)


def _repeating_rows(rng, n):
    shared = [_prose(rng, 30), "ü" * 70, _prose(rng, 14)[:101], "-" * 130, "ab" * 80]
    rows = [(0, None), (1, ""), (2, "x " * 9000), (3, "short"), (4, "y" * 99), (5, "y" * 99), (6, "z" * 100), (7, "z" * 101)]
    for i in range(10, n):
        own = _prose(rng, rng.randrange(1, 40))
        cut = rng.choice(shared)
        rows.append((i, own + cut + _prose(rng, rng.randrange(0, 20)) + rng.choice(["", cut, rng.choice(shared)[rng.randrange(60) :]])))
    whole = rows[-1][1]
    return rows + [(n, whole), (n + 1, whole[:50] + "!" + whole[50:]), (n + 2, whole[3:])]


def test_repeats_equal_brute_force(spark):
    rows = _repeating_rows(random.Random(8), 90)
    want = _removed(rows)
    for parts, group in ((1, repeats.GROUP_PIECES), (6, repeats.GROUP_PIECES), (3, 4)):  # the last splits crowded anchors
        got = repeats.remove_repeats(_docs(spark, rows).repartition(parts), group_pieces=group)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_repeats_edges(spark):
    assert repeats.remove_repeats(_docs(spark, [])).count() == 0
    rng = random.Random(9)
    a, b = _prose(rng, 40), _prose(rng, 40)
    # equal rows are one document, a null id comes last, other texts of one id follow each other
    got = repeats.remove_repeats(_docs(spark, [(None, a), (3, a), (3, a), (5, b), (5, b + "?")])).collect()
    by = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in got}
    assert by[(3, len(a.encode()))] == 0 and by[(None, len(a.encode()))] == len(a.encode()) and len(got) == 5
    assert sorted(r["n_removed"] for r in got if r["doc_id"] == 5) == [0, len(b.encode())]


def test_cut_texts_lose_no_window(spark, monkeypatch):
    """Texts over the unit are cut between windows."""
    monkeypatch.setattr(repeats, "UNIT", 400)
    rng = random.Random(10)
    data = np.frombuffer(_prose(rng, 800).encode(), np.uint8)
    ends = np.array([150, 151, 240, 3000, len(data)])
    start, n, place, _, _ = repeats.pieces(data, ends)
    windows = {w for s, k in zip(start.tolist(), n.tolist()) for w in range(s, s + k)}
    begins = [0, *ends[:-1].tolist()]
    assert windows == {p for b, e in zip(begins, ends.tolist()) for p in range(b, e - 99)} and int(n.sum()) == len(windows)
    assert ((place >= start + n - 1) & (place + 32 <= start + 100)).all()


def test_interval_expansion_equals_sorted_suffixes():
    rng = random.Random(11)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(100, 240))) for _ in range(12)]
    texts += [t[5:] + texts[0][:101] for t in texts[:5]] + [b"a" * 100, b"a" * 100]
    age = np.array(rng.sample(range(len(texts)), len(texts)))
    firsts = repeats.first_windows(texts, age)
    for t, own, first in zip(texts, age, firsts):
        for p in range(len(t) - 99):
            oldest = min(a for x, a in zip(texts, age) if t[p : p + 100] in x)
            assert first[p] == (oldest == own)


# --- op13 -------------------------------------------------------------------------

def _repaired(rows):
    """Damage and the cheapest repair by a table over rows and states."""
    out = {}
    ids = {r[0] for r in rows}
    for conv in ids:
        own = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role0, text0 = " " if role is None else role, " " if text is None else text
            fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if fate:
                text1 = "" if fate == 1 else re.sub(r"[.!?]", "", text0) if fate == 2 else text0
                own += [((turn is not None, turn or 0, role0, text0, k), turn, "user" if fate == 4 else role0, text1) for k in range(2 if fate == 3 else 1)]
        own = [x[1:] for x in sorted(own, key=lambda x: x[0])]
        seen, faults = set(), []
        for _, role, text in own:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        legal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        # paths by cost, then audit; emitted lines ride along
        best = {0: (0, "", ())}
        after = {0: "u", 1: "u", 2: "a", 3: "u"}

        def put(table, q, path):
            if q not in table or path[:2] < table[q][:2]:
                table[q] = path

        def inserted(table):
            table = dict(table)
            for _ in range(4):
                for q, (c, a, ls) in list(table.items()):
                    put(table, 3 if q == 2 else 2, (c + 5, a + "I", ls + (("assistant" if q == 2 else "user", ""),)))
            return table

        for (_, role, text), fault in zip(own, faults):
            now: dict = {}
            for q, (c, a, ls) in inserted(best).items():
                put(now, q, (c + 2, a + "D", ls))
                if fault in ("blank", "duplicate"):
                    continue
                more, to = 5 * (fault == "truncated"), 3 if q == 2 else 2
                if role[:1] == after[q]:
                    put(now, to, (c + more, a + "K", ls + ((role, text),)))
                if role[:1] == "s" and q == 0:
                    put(now, 1, (c + more, a + "K", ls + ((role, text),)))
                put(now, to, (c + 1 + more, a + "R", ls + (("assistant" if q == 2 else "user", text),)))
            best = now
        cost, audit, lines = min((p for q, p in inserted(best).items() if q in (0, 3)), key=lambda p: p[:2])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), legal, cost, audit, digest)
    return out


def _conversations(rng, n_rows, convs):
    texts = ["Yes.", "No!", "Well", "", " \t\n", "Why? ", None, "Good. Bye", "é…", "Ok?", "go on\x0b"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "agent"]
    return [(rng.choice(convs), rng.choice([None, *range(30)]), rng.choices(roles, [8, 8, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts)) for _ in range(n_rows)]


CONV = "conv_id long, turn long, role string, text string, pos long, kind string, fault string, part string, first string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", "c", "d") for r in rows], CONV)


def test_repair_equals_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    rows = _conversations(rng, 700, [None, *range(90)]) + _conversations(rng, 400, [1000])  # one holds a third
    rows += [(2000 + i, t, r, f"{t} fine.") for i in range(5) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += rows[:20]
    want = _repaired(rows)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(_table(spark, rows).repartition(5)).collect()}
    assert got == want
    assert repair.repair(_table(spark, [])).count() == 0


def test_blocks_and_powers(monkeypatch):
    """A conversation unrolls alike in blocks of any size."""
    rng = random.Random(13)
    pool = [("user", "q.", 0), ("assistant", "a.", 0), ("system", "s.", 0), ("tool", "t", 3), ("user", "", 1), ("assistant", "cut", 3)]
    rows = [x for _ in range(60) for x in [rng.choice(pool)] * rng.choice([1, 1, 2, 9, 70])]
    plain = repair.UNIT
    for role, _, fault in rows:
        plain = repair._product(plain, repair.power(repair.symbol(role, fault), 0))
    assert repair.transition([repair.symbol(r, f) for r, _, f in rows]) == plain
    results = set()
    for size in (1, 7, 64, len(rows)):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        behind = [repair.BEHIND_ALL]
        for p in reversed(parts):
            behind.append(repair.through(repair.transition([repair.symbol(r, f) for r, _, f in p]), behind[-1]))
        c = repair._Conversation()
        for p, v in zip(parts, reversed(behind[:-1])):
            c.block([(None, r, t, f) for r, t, f in p], v)
        out = c.result()
        assert out[5] == behind[-1][0]
        results.add(out)
    assert len(results) == 1


def test_repeats_hold_little_memory_at_once():
    """Numpy's memory in a task: hashing a megabyte of text, and transforms of many small groups and of one large one."""
    rng = np.random.default_rng(12)

    def peak(f):
        tracemalloc.start()
        try:
            f()
            return tracemalloc.get_traced_memory()[1] / 2**20
        finally:
            tracemalloc.stop()

    text = rng.integers(97, 122, 1 << 20, dtype=np.uint8)
    assert peak(lambda: repeats._pieces_of(text[: repeats.UNIT], np.array([repeats.UNIT]), 0)) < 20
    for size, limit in ((8, 20), (4096, 45)):
        rows = []
        for i in range(4096):
            if i % size == 0:
                base = rng.integers(97, 122, 168, dtype=np.uint8).tobytes()
            rows.append({"key": i // size, "text": base[:60] + b"%08d" % i + base[68:], "doc_id": i, "h": 0, "start": 0})
        batches = pa.Table.from_pylist(rows).to_batches(max_chunksize=500)
        assert peak(lambda: [None for _ in repeats._transforms(iter(batches))]) < limit
