"""Property tests with seeded generators; brute force in plain Python."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from qaspark.operators import compare as CMP
from qaspark.operators import corpus as C
from qaspark.operators import load as L
from qaspark.operators import split as S
from qaspark.operators.order import reindex, running_sums, with_next


def _hot_rows(seed, n=400):
    """Rows where one key holds a third of everything, with time ties."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 12)
        rows.append((i, key, 1_700_000_000 + rnd.randint(0, 5000), rnd.randint(1, 900)))
    return rows


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_reindex_equals_global_row_number(spark, ranges):
    rows = _hot_rows(1)
    df = spark.createDataFrame(rows, "id long, key long, t long, v long")
    got = {r["id"]: r["rid"] for r in reindex(df, ["key", "t", "id"], "rid", num_ranges=ranges).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(order)}


def test_running_sums_equal_cumsum(spark):
    rows = _hot_rows(2)
    df = spark.createDataFrame(rows, "id long, key long, t long, v long")
    got = {r["id"]: r["s"] for r in running_sums(df, ["t", "id"], {"s": "v"}, num_ranges=5).collect()}
    acc, want = 0, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        acc += r[3]
        want[r[0]] = acc
    assert got == want


def test_with_next_equals_shift(spark):
    rows = _hot_rows(3)
    df = spark.createDataFrame(rows, "id long, key long, t long, v long")
    got = {r["id"]: r["v_next"] for r in with_next(df, ["key"], ["t", "id"], ["v"]).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "key", "t", "v"]).sort_values(["key", "t", "id"])
    pdf["nx"] = pdf.groupby("key")["v"].shift(-1)
    want = {int(i): (None if pd.isna(x) else int(x)) for i, x in zip(pdf["id"], pdf["nx"])}
    assert got == want


@pytest.mark.parametrize("keyed", [False, True])
def test_rolling_window_equals_brute_force(spark, keyed):
    rows = _hot_rows(4)
    df = spark.createDataFrame(rows, "event_id long, key long, t long, tokens long").withColumn(
        "ts", F.timestamp_seconds("t"))
    width = 600
    out = L.rolling_window(df, keys=["key"] if keyed else [], width_s=width, oldest=True)
    got = {r["event_id"]: (r["n_calls"], r["tokens_in_window"], r["oldest_us"]) for r in out.collect()}
    want = {}
    for e, k, t, v in rows:
        win = [(t2, v2) for e2, k2, t2, v2 in rows if (not keyed or k2 == k) and t - width < t2 <= t]
        want[e] = (len(win), sum(v2 for _, v2 in win), min(t2 for t2, _ in win) * 1_000_000)
    assert got == want


def test_empty_streaks_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([0, 0, 1, 2]), 1000 + i * 7 % 311, rnd.random() < 0.4) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, user long, ts long, empty boolean")
    got = sorted((r["user"], r["start_id"], r["length"]) for r in
                 L.empty_streaks(df, "user", "ts", "id", F.col("empty"), 3).collect())
    want = []
    for u in sorted({r[1] for r in rows}):
        seq = sorted([r for r in rows if r[1] == u], key=lambda r: (r[2], r[0]))
        cur = []
        for r in seq + [None]:
            if r is not None and r[3]:
                cur.append(r)
            elif cur:
                want.append((u, cur[0][0], len(cur)))
                cur = []
    assert got == sorted(want)


def test_split_is_partitioning_independent(spark):
    rows = [(i, f"g{i % 7}") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, category string")
    a = sorted(S.stratified_split(df).select("id", "split").collect())
    b = sorted(S.stratified_split(df.repartition(11)).select("id", "split").collect())
    assert a == b
    sizes = {r["category"]: r["n"] for r in S.stratified_split(df).groupBy("category").count()
             .withColumnRenamed("count", "n").collect()}
    assert all(v == 38 for v in sizes.values())


def test_dedupe_first_is_first_and_idempotent(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([" a", "a ", "b", "c\n", "c"])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, question string")
    once = C.dedupe_first(df)
    twice = C.dedupe_first(once)
    first = {}
    for i, q in rows:
        first.setdefault(q.strip(), i)
    assert sorted(r["id"] for r in once.collect()) == sorted(first.values())
    assert sorted(r["id"] for r in twice.collect()) == sorted(first.values())


def test_compare_runs_with_itself(spark):
    s = spark.createDataFrame([("Correctness", 0.5, 0.4), ("X", 0.2, 0.1)],
                              "metric string, avg_score double, pass_rate double")
    rows = CMP.compare_runs(s, s).collect()
    assert all(r["delta"] == 0.0 and r["verdict"] == "MARGINAL / FLAT" and not r["regressed"] for r in rows)


def test_batch_scorer_equals_column_scorer(spark):
    from qaspark.operators import score as SC

    rows = [(i, "TokenRecall", "q", " ".join(f"w{j}" for j in range(i % 5)), "w1 w2 W3 w4") for i in range(40)]
    wl = spark.createDataFrame(rows, "idx long, metric string, input string, actual_output string, "
                                     "expected_output string").withColumn("retrieval_context",
                                                                          F.lit(None).cast("array<string>"))
    col = {r["idx"]: r["score"] for r in SC.score_cases(wl.drop("metric"), [SC.TOKEN_RECALL]).collect()}
    bat = {r["idx"]: r["score"] for r in SC.score_with(wl, SC.TokenRecallBatchScorer).collect()}
    assert col == bat


def test_large_quota_rank_equals_window_rank(spark):
    """Above the group-limit threshold the prefix-count rank must equal the
    window rank; a hot group holds a third of the rows."""
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 5}") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, category string")
    small = sorted(S.balanced_sample(df, per_group=150).select("id", "rank").collect())
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100")
    try:
        large = sorted(S.balanced_sample(df, per_group=150).select("id", "rank").collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert small == large


def test_reindex_with_empty_ranges(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(20)], "id long, g long")
    got = sorted((r["id"], r["rid"]) for r in reindex(df, ["g", "id"], "rid", num_ranges=50).collect())
    order = sorted(range(20), key=lambda i: (i % 3, i))
    assert got == sorted((i, k + 1) for k, i in enumerate(order))


def test_cap_and_sample(spark):
    rows = [(i, f"g{i % 4}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, category string")
    assert sorted(r["id"] for r in C.cap_to_target(df, 120).collect()) == list(range(120))
    assert len({r["id"] for r in S.eval_sample(df, 50).collect()}) == 50
    assert S.eval_sample(df, 400).count() == 300


def test_null_group_is_split_and_audited(spark):
    rows = [(i, None if i % 3 == 0 else f"g{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, category string")
    got = S.stratified_split(df)
    assert got.where("category is null").count() == 20
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        assert sorted(r["id"] for r in S.stratified_split(df).collect()) == sorted(r["id"] for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    audit = S.split_audit(df, got).where("category is null").collect()
    assert sum(r["n"] for r in audit) == 20


def test_running_sums_keep_fractions_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.5), (4, None), (5, 0.5)], "id long, v double")
    got = [r["s"] for r in running_sums(df, ["id"], {"s": "v"}, num_ranges=3).orderBy("id").collect()]
    assert got == [0.0, 0.5, 1.0, 1.0, 1.5]


def test_top_up_keeps_all_held_rows(spark):
    schema = "id long, category string, question string, answer string"
    held = spark.createDataFrame([(i, "a", f"q{i}", "x") for i in range(6)], schema)
    out = C.top_up(held, spark.createDataFrame([(9, "b", "new", "y")], schema), 4)
    assert sorted(r["question"] for r in out.collect()) == [f"q{i}" for i in range(6)]


def test_top_up_equals_brute_force(spark):
    held = [(1, "a", "q1", "x"), (2, "a", "q2", "x")]
    cand = [(10, "b", " q2 ", "y"), (11, "b", "q3", "y"), (12, "b", "q3", "z"), (13, "b", "q4", "y"),
            (14, "b", "q5", "y")]
    schema = "id long, category string, question string, answer string"
    out = C.top_up(spark.createDataFrame(held, schema), spark.createDataFrame(cand, schema), 4)
    got = sorted((r["id"], r["question"]) for r in out.collect())
    # held first, then unseen first-seen candidates in id order, capped at 4, renumbered
    assert got == [(1, "q1"), (2, "q2"), (3, "q3"), (4, "q4")]
