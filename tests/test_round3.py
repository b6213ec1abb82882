"""Selection without sorting, scoring in waves, truth of values, masks."""

import random
import re

import pandas as pd
from pyspark.sql import functions as F

from qaspark.operators import cases as K
from qaspark.operators import chat as CH
from qaspark.operators import split as S
from qaspark.operators import waves as W
from qaspark.operators.select import first_rows
from qaspark.session import scratch_path


def test_first_rows_equal_a_sort(spark):
    rng = random.Random(1)
    keys = [rng.choice([None, 0, -5, 7, 7, 7, 2**62, -(2**63), 2**63 - 1, rng.randrange(-(10**18), 10**18)]) for _ in range(400)]
    df = spark.createDataFrame([(k, i, "x") for i, k in enumerate(keys)], "k long, i long, payload string").repartition(4)
    want = sorted(range(len(keys)), key=lambda i: (keys[i] is not None, keys[i] or 0, i))
    for n in (0, 1, 20, 39, 40, 41, 97, 150, 260, 399, 400, 5000):
        got = first_rows(df, n, F.col("k"), ["i"]).collect()
        assert sorted(r["i"] for r in got) == sorted(want[:n]), n


def test_dense_keys_are_refined(spark):
    df = spark.range(0, 60_000, 1, 4).withColumnRenamed("id", "k")
    for n in (1, 4097, 33_333, 59_999):
        got = first_rows(df, n, F.col("k"), ["k"])
        assert got.agg(F.count("k"), F.max("k")).first() == (n, n - 1)


def test_sample_filters_rows_without_an_exchange(spark):
    df = spark.createDataFrame([(i, "payload " * 9) for i in range(500)], "id long, text string")
    got = S.eval_sample(df, 54)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 54 and S.eval_sample(df, 54).exceptAll(got).count() == 0


SPECS = [K.MetricSpec("m1", "M", "one"), K.MetricSpec("m2", "M", "two")]


def _work(spark, n):
    cases = spark.createDataFrame([(i, f"q{i}", "a", "bad" if i % 10 == 3 else "e") for i in range(n)], "idx long, input string, actual_output string, expected_output string")
    return K.scoring_worklist(cases, SPECS)


def test_waves_resume_and_score_no_pair_twice(spark):
    class Length:
        def score_batch(self, pdf):
            if (pdf["expected_output"] == "bad").any():
                raise RuntimeError("no")
            return pd.DataFrame({"score": [float(len(x)) for x in pdf["input"]], "error": [None] * len(pdf)})

    work, one, two = _work(spark, 60), scratch_path(spark, "journal"), scratch_path(spark, "journal")
    assert W.read_journal(spark, one).count() == 0
    assert W.score_in_waves(work, SPECS, Length, one, wave_rows=25, max_waves=1) == 1
    n = W.read_journal(spark, one).count()
    assert 0 < n < 120
    (spark.createDataFrame([(1,)], "x int").write.parquet(f"{one}/wave=999/_temporary/0"))  # a wave that was cut off
    assert W.score_in_waves(work, SPECS, Length, one, wave_rows=25) >= 2
    assert W.score_in_waves(work, SPECS, Length, one, wave_rows=25) == 0
    W.score_in_waves(work, SPECS, Length, two, wave_rows=1000)
    rows = [sorted(tuple(r) for r in W.read_journal(spark, p).select("idx", "metric", "spec_hash", F.coalesce("score", F.lit(-1.0)), "error").fillna("").collect()) for p in (one, two)]
    assert rows[0] == rows[1] and len(rows[0]) == 120 == len({r[:3] for r in rows[0]})
    assert all((r[3] == -1.0) == (r[0] % 10 == 3) and (r[4] != "") == (r[0] % 10 == 3) for r in rows[0])

    class Fixed:
        def score_batch(self, pdf):
            return pd.DataFrame({"score": [9.0] * len(pdf), "error": [None] * len(pdf)})

    # failed pairs again, and pairs of a metric whose definition has changed
    W.score_in_waves(work, SPECS, Fixed, one, retry_failed=True)
    latest = W.latest_scores(W.read_journal(spark, one))
    assert latest.count() == 120 and latest.where("error is not null").count() == 0 and latest.where("score = 9.0").count() == 12
    changed = [SPECS[0], K.MetricSpec("m2", "M", "another")]
    W.score_in_waves(work, changed, Fixed, one)
    assert W.latest_scores(W.read_journal(spark, one)).count() == 180


def test_truth_of_values(spark):
    cols = {
        "question": "0", "input": "cast(0 as decimal(5,2))", "query": "cast('nan' as double)",
        "answer": "array()", "expected_answer": "map()", "output": "false", "response": "''", "completion": "array('')",
        "context": "parse_json('[]')", "retrieval_context": "parse_json('0.0')", "reference": "cast('' as binary)", "passage": "parse_json('{\"a\":0}')",
    }
    df = spark.range(1).selectExpr(*[f"{v} as {k}" for k, v in cols.items()])
    assert K.detect_columns(df) == ("query", "completion", "passage")
    assert K.detect_columns(df.limit(0)) == (None, None, None)


def test_masks_of_long_chats(spark):
    rng = random.Random(4)
    ask, reply = "<|turn>user\n", "<|turn>model\n"
    texts = {0: "", 1: "no markers here", 2: reply + "only an answer", 3: None}
    for i in range(4, 9):
        texts[i] = "intro " + "".join(ask + "q " * rng.randrange(40) + "\n" + reply + "wörd é𝒳 \t" * rng.randrange(400) + "end\n" for _ in range(rng.randrange(1, 30)))
    df = spark.createDataFrame(list(texts.items()), "id long, text string").repartition(3)
    spans = df.select("id", F.explode(CH.span_offsets("text", ask, reply)).alias("s")).select("id", "s.start", "s.end")
    got = {r["id"]: r["mask"] for r in CH.response_mask(CH.word_tokens(df, "text"), spans, bin_chars=64).collect()}
    for i, text in texts.items():
        on = []
        for m in re.finditer(re.escape(reply), text or ""):
            end = text.find(ask, m.end())
            cut = text.find(reply, m.end())
            on.append((m.end(), min(x for x in (end, cut, len(text)) if x >= 0)))
        want = [int(any(a <= m.start() and m.end() <= b for a, b in on)) for m in re.finditer(r"[^ \t\n\r]+", text or "")]
        assert got.get(i, []) == want
