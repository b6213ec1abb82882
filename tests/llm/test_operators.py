"""Operators against brute force on small fixtures: nulls, empty and long
texts, ties and repeated rows, empty tables, extra columns."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaspark.llm import ann, bpe, chat_tools, langid, mixing, neardup, pii, quality, toxicity, urls

DOC = "doc_id long, text string, lang string, source string, n_chars long, _ll string, a long, score string"


def _docs(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or {}).get(i, "s0"), len(t or ""), "x", 7, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:1], DOC) if rows else spark.createDataFrame([], DOC)


def _prose(rng, n):
    return " ".join(rng.choice("the of and to in er on an re he est ting onhe thre whst".split()) + str(rng.randrange(30)) for _ in range(n))


EDGE = [None, "", " \n\t ", "one", "a b c d e", "a b c d e", "x " * 9000, "ünï cödé \x1c²½ 𝒳 <|endoftext|> it's  two\r\n"]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    texts = list(EDGE)
    for n in (7, 12, 30, 80, 200, 400):
        words = _prose(rng, n).split()
        for edits in (0, 1, 2, 4, 8):
            w = list(words)
            for _ in range(edits):
                w[rng.randrange(n)] = f"edit{rng.randrange(10**6)}"
            texts += [" ".join(w), " ".join(w)]
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    low = list(range(len(texts)))
    for _ in texts:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and 100 * len(x & y) >= 85 * len(x | y):
                    low[i] = min(low[i], low[j])
    got = neardup.near_duplicates(_docs(spark, texts)).distinct().collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(s), low[i], low[i] == i) for i, s in enumerate(sets)
    }
    kept = neardup.keep_one_of_each(_docs(spark, texts))
    assert {r["doc_id"] for r in kept.collect()} == {i for i in low if low[i] == i} and kept.columns == _docs(spark, []).columns
    assert neardup.near_duplicates(_docs(spark, [])).count() == 0


def _with_similarity(words, percent):
    """The words with the last ones replaced, so that just this similarity of
    the shingles is kept."""
    n = len(words) - 4
    common = -(-2 * n * percent // (100 + percent))
    return words[: common + 4] + [f"other{i}" for i in range(n - common)]


def test_stage_links_from_80_percent(spark):
    import corpus_pipeline

    rng = random.Random(12)
    texts = []
    for _ in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        texts += [" ".join(words), " ".join(_with_similarity(words, 81))]
        texts += [" ".join(w := [f"v{rng.randrange(10**6)}" for _ in range(200)]), " ".join(_with_similarity(w, 78))]
    docs = _docs(spark, texts)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, None).collect())
    assert kept == [i for i in range(160) if i % 4 != 1]
    assert neardup.near_duplicates(docs).where("not kept").count() == 0
    for percent, (bands, rows) in neardup.SHAPES.items():
        assert (1 - (percent / 100) ** rows) ** bands < 2e-7
    with pytest.raises(ValueError):
        neardup.near_duplicates(docs, percent=70)


def test_one_row_of_each_group_with_equal_and_null_ids(spark):
    rng = random.Random(13)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(60)) for x in "abcd")
    rows = [(1, a), (1, a), (2, a), (3, b), (3, c), (4, b.upper()), (None, c), (None, d), (None, d), (9, None), (9, None), (8, ""), (None, ""), (None, None)]
    rows += [(2**63 - 1, "one of its own"), (-5, "another one")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 7, "y") for i, t in rows], DOC)
    want = {(1, a), (3, b), (3, c), (None, d), (9, None), (8, ""), (None, ""), (None, None), *rows[-2:]}
    for percent in (80, 85):
        out = neardup.keep_one_of_each(docs, percent=percent)
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        assert out.columns == docs.columns and len(got) == len(want) and set(got) == want
    # copies without an id, behind one with an id that is larger than any node
    got = neardup.keep_one_of_each(docs.where(F.col("text") == a).unionByName(docs.where("doc_id is null"))).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == sorted([(1, a), (0, c), (0, d), (0, ""), (0, "")])


def test_registers_estimate_similarity():
    rng = np.random.default_rng(1)
    for j in (0.5, 0.85, 0.95):
        x = rng.integers(0, 2**63, 2000).astype(np.uint64)
        common = int(2 * 1000 * j / (1 + j))
        a, b = np.unique(x[:1000]), np.unique(np.r_[x[:common], x[1000 : 2000 - common]])
        n = np.array([len(a)])
        est = neardup.estimate(neardup.registers(a)[None], neardup.registers(b)[None], n, np.array([len(b)]))[0]
        assert abs(est - j) < 0.12


def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    rng = random.Random(2)
    alphabet = "ab Zéß 1²\n\t\x1c\x85 　'.,-_%日本💡ª́"
    texts = EDGE + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(400)] + ["I'll don't 'sx ''s"]
    t = tokenizers.Tokenizer.from_file(bpe.default_path())
    got = {r["doc_id"]: r for r in bpe.digests(_docs(spark, texts)).collect()}
    decoded = {r["doc_id"]: r["decoded"] for r in bpe.decode(bpe.encode(_docs(spark, texts))).collect()}
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), repr(text)
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest() and decoded[i] == back
    assert bpe.digests(_docs(spark, [])).count() == 0


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16))
    x[50:120] = x[49]
    x[7] = 0
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(400, None), (420, [float("nan")] * 16), (440, [1.0]), (None, [1.0] * 16), (20, [float(v) for v in x[20]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as uid", "2 as key")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    ids = [i for i in range(300) if i != 7]
    for q in range(0, 300, 20):
        s = {i: float((x[q] * x[i]).sum()) for i in ids if i != q}
        assert [got[q][k] for k in range(1, 21)] == sorted(s, key=lambda i: (-s[i], i))[:20]
    assert set(got) == set(range(0, 300, 20))
    assert ann.nearest(df.where("false")).count() == 0


def test_hilbert_neighbours_are_adjacent():
    cells = np.array([(a, b) for a in range(8) for b in range(8)])
    order = cells[np.argsort(ann.hilbert_keys(cells, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_pseudonyms(spark):
    secret = "0123456789abcdef0123456789ABCDEF".lower()
    text = f"mail jo.d@mail.example.com, call +1 (743) 555-3824, card 4111111111111111, ip 10.200.3.44, born 1984-02-29, token = \"{secret}\", 999.1.1.1 is v3."
    got = {r["doc_id"]: r for r in pii.with_pseudonyms(_docs(spark, EDGE + [text, text]), finds_col="finds").collect()}
    a, b = got[len(EDGE)]["text"], got[len(EDGE) + 1]["text"]
    assert a == b and len(a) == len(text)
    for value in ("jo.d@mail", "743", "4111111111111111", "10.200.3.44", "1984-02-29", secret):
        assert value not in a
    assert "999.1.1.1 is v3." in a and pii.luhn(re.search(r"card (\d{16})", a)[1])
    assert all(got[i]["text"] == t for i, t in enumerate(EDGE))
    assert pii.with_pseudonyms(_docs(spark, [])).count() == 0
    assert pii.with_pseudonyms(_docs(spark, EDGE)).columns == _docs(spark, []).columns


def test_permutation_is_one_to_one():
    for size in (1, 2, 10, 97, 1000):
        assert sorted(pii.permute(i, size, b"k") for i in range(size)) == list(range(size))


def test_long_secrets_keep_no_runs():
    rng = random.Random(11)
    names = pii.Pseudonyms("k")
    for n, alphabet in ((257, "0123456789abcdef"), (2000, "0123456789abcdef"), (2000, "0123456789"), (2000, "abcXYZ0189+/_-")):
        secret = "".join(rng.choice(alphabet) for _ in range(n))
        secrets = [secret, secret[:-1] + ("1" if secret[-1] == "0" else "0"), ("1" if secret[0] == "0" else "0") + secret[1:]]
        outs = [names.replace(f'token = "{s}"')[0].split('"')[1] for s in secrets]
        assert len(set(outs)) == len(set(secrets)) and all(map(len, outs))
        for x, y in [*zip(secrets, outs), (outs[0], outs[1]), (outs[0], outs[2])]:
            assert len(x) == len(y) == n
            # separators stay and may lie side by side with equal characters
            same = "".join("=" if a == b else "#" for a, b in zip(x, y) if a.isalnum())
            assert max(map(len, same.split("#"))) < 12 and same.count("=") < len(same) / 4


def test_dates_of_either_reading():
    names = pii.Pseudonyms("k")
    days = ["25/12/1990", "31/01/2001", "13/02/2000", "29/02/2000", "12-25-1990", "01.31.2001", "05/12/1990", "25-12-1990"]
    for day in days:
        out, finds = names.replace(f"né le {day}, ok")
        a, sep, b, year = re.fullmatch(r"né le (\d\d)([-/.])(\d\d)[-/.](\d{4}), ok", out).groups()
        assert finds == {"date": 1} and out != f"né le {day}, ok" and sep == day[2]
        # a result is read the same way as its value
        for x, y in ((day[:2], a), (day[3:5], b)):
            assert int(y) <= 12 or int(x) > 12 or day in ("05/12/1990", "25-12-1990")
        assert 1900 <= int(year) <= 2099
    all_days = [f"{d:02d}/{m:02d}/{y}" for y in (1990, 2000) for m in range(1, 13) for d in range(1, 29)]
    assert len({names.replace(d)[0] for d in all_days}) == len(all_days)
    assert names.replace("31/02/2001 00/00/1999 1990-25-12 99.99.1999")[1] == {}
    iso, us = names.replace("1990-12-05")[0], names.replace("12/05/1990")[0]
    assert us == f"{iso[5:7]}/{iso[8:]}/{iso[:4]}"


def test_a_find_that_does_not_hold_is_read_as_other_kinds():
    out, finds = pii.Pseudonyms("k").replace("+1 4111 1111 1111 1111 and 999.1.1.1")
    assert finds == {"card": 1} and out.startswith("+1 ") and "4111 1111 1111 1111" not in out and out.endswith(" and 999.1.1.1")


def test_language_from_text_and_other_evidence(spark):
    rng = random.Random(4)
    words = {"en": "the and of thing other", "de": "der und nicht schön über", "fr": "le été où très que"}
    rows = [(i, " ".join(rng.choice(words[l].split()) for _ in range(30)), l, f"{l}.org") for i, l in enumerate(["en", "de", "fr"] * 30)]
    rows += [(900, None, "en", None), (901, "123 %%% 456", "de", "en.org"), (902, "", None, "de.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in langid.identify_documents(docs).collect()}
    assert all(got[i]["lang_found"] == l and got[i]["lang_kept"] for i, _, l, _ in rows[:90])
    assert all(got[i]["lang_found"] == "und" and not got[i]["lang_kept"] for i in (900, 901, 902))
    assert langid.keep_identified(docs).columns == docs.columns
    assert langid.keep_identified(docs.where("false")).count() == 0


def test_every_language_has_a_model(spark):
    rng = random.Random(14)
    rows, n = [], 70
    words = {f"l{i:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for i in range(n)}
    for i, (lang, w) in enumerate(words.items()):
        # the last languages have fewer rows, and the very last long texts only
        size = 900 if i == n - 1 else 40
        rows += [(len(rows) + k, " ".join(rng.choice(w) for _ in range(size)), lang, "s") for k in range(3 if i < n - 8 else 2)]
    assert min(len(r[1]) for r in rows if r[2] == "l69") > langid.SAMPLE_CHARS
    rows += [(1000, "x" * 5000, None, "s"), (1001, "", "zz", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.fit(docs)
    assert model[0] == [*sorted(words), "und"]
    scores = {r[0]: model[1][langid.trigram_ids(r[1])].sum(axis=0) for r in rows[:-2]}
    assert all(model[0][int(scores[r[0]].argmax())] == r[2] for r in rows[:-2])
    got = {r["doc_id"]: r for r in langid.identify_documents(docs, model).collect()}
    assert all(got[r[0]]["lang_found"] == r[2] and got[r[0]]["lang_kept"] for r in rows[:-2])
    # a language with short texts is fitted on those alone
    short = [(1, "ab cd ef", "xx", "s"), (2, "gh " * 3000, "xx", "s")]
    table = langid.fit(spark.createDataFrame(short, "doc_id long, text string, lang string, source string"))[1]
    assert table[langid.trigram_ids("gh gh")].max(axis=0)[0] < table[langid.trigram_ids("ab cd")].min(axis=0)[0]


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(6)
    texts, labels = list(EDGE), []
    for i in range(len(EDGE), 400):
        w = _prose(rng, 40).split()
        bad = i % 3 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(40)] = rng.choice(["moron", "idiot", "scum"])
        texts.append(" ".join(w))
        labels.append((i, 1, int(bad)))
    y = spark.createDataFrame(labels + [(0, 1, None)], "doc_id long, quality long, toxic long")
    docs = _docs(spark, texts)
    got = toxicity.score(docs, toxicity.fit(docs, y)).distinct().collect()
    truth = {i: t for i, _, t in labels}
    out = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(out) > 40 and sum(a == b for a, b in out) / len(out) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(texts)
    assert toxicity.score(docs.where("false"), toxicity.fit(docs.where("false"), y)).count() == 0


def test_mixture_meets_targets(spark):
    rng = random.Random(7)
    texts = EDGE[:5] + [_prose(rng, rng.randrange(1, 60)) for _ in range(600)]
    sources = {i: (None if i % 7 == 0 else f"s{min(i % 11, 3)}") for i in range(len(texts))}
    docs = _docs(spark, texts, sources)
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in rows)
    assert abs(sum(g[0]["target"] for g in by.values()) - total) < 1e-6 * total
    for g in by.values():
        assert g[0]["target"] <= 3 * g[0]["source_size"] + 1e-9
        assert abs(sum(r["taken"] for r in g) - g[0]["target"]) <= max(r["size"] for r in g)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["taken"] // r["size"] for r in rows if r["size"])
    assert mixing.mix(docs.where("false")).count() == 0


def test_quality_counts(spark):
    rep = "one two three four five six seven eight nine " * 4
    texts = [*EDGE, rep, "a line\nb\na line\n\n\n", "## $5 <b> %"]
    got = {r["doc_id"]: r for r in quality.judge(_docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        win = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        hit = {k + j for k, x in enumerate(win) if win.count(x) > 1 for j in range(8)} if len(win) < 500 else set(range(len(w)))
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got[i]["n_words"] == len(w) and got[i]["n_repeat_words"] == len(hit), repr((t or "")[:40])
        assert got[i]["word_chars"] == sum(map(len, w)) and got[i]["n_dup_lines"] == len(lines) - len(set(lines))
        assert got[i]["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
    assert quality.judge(_docs(spark, [])).count() == 0


def test_url_rules(spark):
    cases = {
        None: ("", "", None, "allow"), "no scheme": ("", "", None, "allow"),
        "http://A.Example.NET/en/1?x": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://x.net/a#b": ("x.net", "/a", "net/", "block"), "http://x.net": ("x.net", "", None, "allow"),
        "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"), "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://q.org/fr/z": ("q.org", "/fr/z", "org/fr/", "allow"), "http://spam-farm.example.org/en/": ("spam-farm.example.org", "/en/", None, "block"),
    }
    rows = [(i, u, "h") for i, u in enumerate(cases)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urls.filter_urls(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == list(cases.values())[r["page_id"]]
    assert urls.filter_urls(df.where("false")).count() == 0
    always = [*urls.compile_rules(), ("block", None, 5, r"/z$", [])]
    assert {r["page_id"]: r["verdict"] for r in urls.filter_urls(df, [("block", None, 5, "/z$", [])]).collect()}[7] == "block" and always


def test_tool_calls(spark):
    calls = [
        (1, 5, "a", "search", '{"limit": 3, "query":"x"}', ["b"]), (1, 6, "b", "search", '{"query": 5}', []),
        (1, 7, "c", "count", "no json", ["c"]), (1, 8, "d", "gone", "{}", ["nobody"]), (1, 8, "d", "gone", "{}", ["nobody"]),
        (None, 1, "z", "count", '{"text":"t","more":1}', None), (2, 1, None, None, None, None),
    ]
    results = [(1, 9, "a", "ok"), (1, 10, "q", "lost"), (1, 11, "a", "again")]
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, tool string, arguments string, depends_on array<string>")
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    got = {(x["conv_id"], x["call_id"]): x for x in chat_tools.link_tool_calls(c, r, chat_tools.SCHEMAS).collect()}
    a, b = got[1, "a"], got[1, "b"]
    assert (a["status"], a["level"], a["n_results"], b["status"], b["level"]) == ("linked", 1, 2, "unanswered", 0)
    assert a["json"] == '{"arguments":{"limit":3,"query":"x"},"call_id":"a","depends_on":["b"],"result":"ok","status":"linked","tool":"search"}'
    assert b["position"] < a["position"] and b["problems"] == "type:query"
    assert got[1, "c"]["status"] == "cyclic" and got[1, "c"]["problems"] == "arguments" and got[1, "q"]["status"] == "orphan"
    assert got[1, "d"]["n_calls"] == 2 and got[1, "d"]["problems"] == "tool;dependency"
    assert got[None, "z"]["status"] == got[2, None]["status"] == "no_id"
    assert chat_tools.link_tool_calls(c.where("false"), r.where("false"), chat_tools.SCHEMAS).count() == 0


def test_tool_calls_without_or_with_repeated_identifiers(spark):
    calls = [
        # a log that restarts at call_0; the second session's call_0 has no result
        (1, 1, "call_0", "count", '{"text":"s1"}', []), (1, 3, "call_1", "count", '{"text":"s1b"}', ["call_0"]),
        (1, 11, "call_0", "count", '{"text":"s2"}', ["call_1"]),
        (1, 21, "call_0", "count", '{"text":"s3"}', []), (1, 23, "call_1", "count", '{"text":"s3b"}', ["call_0"]),
        # two calls of one turn
        (2, 1, "p", "count", '{"text":"x"}', []), (2, 1, "p", "count", '{"text":"y"}', []),
        # no identifier
        (None, 1, "n", "count", '{"text":"n1"}', []), (None, 1, "n", "count", '{"text":"n2"}', ["n"]),
        (3, 1, None, "count", '{"text":"n3"}', []), (3, 1, None, "count", '{"text":"n4"}', []), (None, None, None, "gone", None, None),
    ]
    results = [
        (1, 2, "call_0", "r1"), (1, 4, "call_1", "r1b"), (1, 22, "call_0", "r3"), (1, 24, "call_1", "r3b"), (1, 25, "call_1", "late"),
        (2, 2, "p", "first"), (2, 3, "p", "second"), (None, 2, "n", "lost"), (3, 2, None, "lost too"), (None, None, None, "lost three"),
    ]
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, tool string, arguments string, depends_on array<string>")
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    rows = chat_tools.link_tool_calls(c, r, chat_tools.SCHEMAS).collect()
    found = {}
    for x in rows:
        j = json.loads(x["json"])
        found[x["conv_id"], x["call_id"], j.get("arguments", {}).get("text"), j.get("result")] = x
    assert len(rows) == len(found) == len(calls) + 3
    at = lambda *key: (found[key]["status"], found[key]["level"], found[key]["n_calls"], found[key]["n_results"])
    assert at(1, "call_0", "s1", "r1") == ("linked", 0, 3, 1) and at(1, "call_1", "s1b", "r1b") == ("linked", 1, 2, 1)
    assert at(1, "call_0", "s2", None) == ("unanswered", 2, 3, 0)
    assert at(1, "call_0", "s3", "r3") == ("linked", 0, 3, 1) and at(1, "call_1", "s3b", "r3b") == ("linked", 1, 2, 2)
    assert [tuple(m) for m in found[1, "call_1", "s3b", "r3b"]["more_results"]] == [(25, "late")]
    assert {(k[2], k[3]) in (("x", "first"), ("y", "second"), ("x", "second"), ("y", "first")) for k in found if k[0] == 2} == {True}
    for key in [(None, "n", "n1", None), (None, "n", "n2", None), (3, None, "n3", None), (3, None, "n4", None), (None, None, None, None)]:
        assert at(*key) == ("no_id", None, 1, 0)
    for key in [(None, "n", None, "lost"), (3, None, None, "lost too"), (None, None, None, "lost three")]:
        assert at(*key) == ("no_id", None, 0, 1)
    for conv in (1, 2, 3, None):
        n = sorted(x["position"] for x in rows if x["conv_id"] == conv)
        assert n == list(range(1, len(n) + 1))
    spread = chat_tools.link_tool_calls(c, r, chat_tools.SCHEMAS, more="rows").collect()
    assert len(spread) == len(rows) + 1 and "more_results" not in spread[0].asDict()
    assert [(x["call_id"], x["status"], x["level"]) for x in spread if '"late"' in x["json"]] == [("call_1", "orphan", None)]
