"""Stream behaviour beyond the oracle rows: late rows and restarts."""

import random

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from qaspark.operators import cases as K
from qaspark.operators import score as SC
from qaspark.session import scratch_path
from qaspark.streaming import streams as ST
from tests.conftest import SF_SMALL


def test_late_rows_are_dropped(spark):
    r = E.queries()["stream_late"](spark, SF_SMALL).collect()[0]
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert r["n_late_windows_out"] == 0
    assert 0 < r["n_dropped"] <= r["n_late_input"]
    # everything but the late part is counted, except windows still open at the end
    assert total - r["n_late_input"] - 5 <= r["n_rows_out"] <= total - r["n_late_input"]


def test_resume_counts_every_row_once(spark):
    got = E.queries()["stream_resume"](spark, SF_SMALL)
    assert got.agg({"n": "sum"}).collect()[0][0] == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def _arrive(spark, base, parts, schema, job):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
        job(ST.file_stream(spark, f"{base}/src", spark.createDataFrame([], schema).schema), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")


def test_a_key_repeated_long_after_stays_dropped(spark):
    day = 86400
    rows = [(i, i * day, "k" + str(i % 7) if i % 11 else None, f"row {i}") for i in range(60)]
    schema = "doc_id long, at long, k string, payload string"
    job = lambda s, out, ckpt: ST.dedupe_stream(s, F.col("k"), ["doc_id"], out, ckpt)
    got = _arrive(spark, scratch_path(spark, "t-dedupe"), [rows[:25], rows[25:30], rows[30:]], schema, job)
    first = {}
    for i, _, k, payload in rows:
        if k is not None:
            first.setdefault(k, (i, payload))
    assert {r["question_key"]: (r["doc_id"], r["payload"]) for r in got.collect()} == first
    assert got.count() == len(first)


def test_streaks_across_batches_equal_a_loop(spark):
    rng = random.Random(5)
    # one key holds most rows; another is empty all the time
    rows = [(1 if rng.random() < 0.7 else rng.randrange(2, 6), t) for t in range(300)]
    rows = [(u, t, u == 5 or rng.random() < 0.6) for u, t in rows]
    want = {}
    for u, _, empty in rows:
        longest, current = want.get(u, (0, 0))
        current = current + 1 if empty else 0
        want[u] = (max(longest, current), current)
    job = lambda s, out, ckpt: ST.stall_stream(s, ["t"], out, ckpt, stall_after=4)
    parts = [rows[:100], rows[100:110], rows[110:]]
    got = ST.latest_per_key(_arrive(spark, scratch_path(spark, "t-stall"), parts, "user_id long, t long, empty boolean", job)).collect()
    assert {r["user_id"]: (r["longest"], r["current"]) for r in got} == want
    assert all(r["stalled"] == (r["longest"] >= 4) for r in got)


def test_a_batch_reads_its_own_rows_only(spark):
    """Rows read and keys looked up per batch don't grow with what was seen."""
    base = scratch_path(spark, "t-seen")
    schema = "doc_id long, k string, at timestamp, big decimal(30,5), tags array<string>"
    for b in range(21):
        rows = [(10**17 + b * 10 + i, f"k{b * 7 + i}" if i else "hot", None, None, ["a", None]) for i in range(10)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
    src = ST.file_stream(spark, f"{base}/src", max_files=1)
    q = ST.dedupe_stream(src, F.col("k"), ["doc_id"], f"{base}/out", f"{base}/ckpt")
    progress = [p for p in q.recentProgress if p["numInputRows"]]
    assert len(progress) == 21 and {p["numInputRows"] for p in progress} == {10}
    assert {p["stateOperators"][0]["numRowsUpdated"] for p in progress[1:]} <= set(range(10))
    out = spark.read.parquet(f"{base}/out")
    assert out.drop("question_key").dtypes == spark.createDataFrame([], schema).dtypes
    keys = [r["k"] for r in out.collect()]
    assert len(keys) == len(set(keys)) == 1 + 20 * 7 + 9
    assert out.where("k = 'hot'").first()["doc_id"] == 10**17


def test_streak_parts_are_compacted_and_may_run_again(spark, monkeypatch):
    rng = random.Random(6)
    steps = {}
    monkeypatch.setattr(ST, "run_batches", lambda rows, step, out, ckpt, mode="append": steps.update(step=step))
    schema = "user_id long, t long, empty boolean"
    none = spark.createDataFrame([], schema)
    base = scratch_path(spark, "t-parts")
    ST.stall_stream(none, ["t"], f"{base}/out", f"{base}/ckpt", stall_after=4, compact_every=3)
    read = []
    own = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: (read.append(p[0]), own(self, *p, **k))[1])
    want: dict = {}
    for epoch in range(8):
        rows = [(rng.choice([None, 1, 1, 1, 2, 3]), 100 * epoch + t, rng.random() < 0.7) for t in range(25)] if epoch != 4 else []
        for u, _, empty in rows:
            longest, current = want.get(u, (0, 0))
            current = current + 1 if empty else 0
            want[u] = (max(longest, current), current)
        for _ in range(2):  # the second run changes nothing
            read.clear()
            got = {r["user_id"]: (r["longest"], r["current"]) for r in steps["step"](spark.createDataFrame(rows, schema), epoch).collect()}
            assert got == {u: want[u] for u in {u for u, _, _ in rows}}
            names = sorted(p.rsplit("/", 1)[1] for p in read)
            assert names == sorted([f"part={e}" for e in range(epoch // 3 * 3, epoch + 1)] + [f"snapshot={epoch // 3 * 3 - 1}"] * (epoch >= 3))


def test_late_rows_over_more_than_a_hundred_batches(spark, tmp_path):
    import os
    from datetime import datetime, timedelta, timezone

    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = random.Random(7)
    t0 = datetime(2024, 3, 1, tzinfo=timezone.utc)
    latest, want = None, {}
    (tmp_path / "src").mkdir()
    for b in range(104):
        rows = [(b * 10 + i, t0 + timedelta(minutes=30 * b - rng.choice([0, 0, 20, 90, 200, 700])) if rng.random() < 0.95 else None) for i in range(3)]
        for i, ts in rows:
            end = ts and ts.replace(minute=0) + timedelta(hours=1)
            want[i] = bool(ts and latest and end <= latest - timedelta(hours=1))
        latest = max([x for _, x in rows if x] + [latest] * bool(latest), default=None)
        at = str(tmp_path / "src" / f"{b:03d}.parquet")
        pq.write_table(pa.table({"id": [i for i, _ in rows], "ts": pa.array([x for _, x in rows], pa.timestamp("us", "UTC"))}), at)
        os.utime(at, (1_700_000_000 + b, 1_700_000_000 + b))
    stream = ST.file_stream(spark, str(tmp_path / "src"), "id long, ts timestamp", max_files=1)
    base = scratch_path(spark, "t-late")
    ST.late_stream(stream, f"{base}/out", f"{base}/ckpt")
    got = ST.read_marked(spark, f"{base}/out").collect()
    assert {r["id"]: r["late"] for r in got} == want and len(got) == 312
    assert len({r["batch_id"] for r in got}) == 104 and 0 < sum(want.values()) < 312


def test_one_failing_case_and_list_fields(spark):
    class Picky:  # local, so that it travels to the workers by value
        def score_batch(self, pdf):
            if (pdf["input"] == "bad").any():
                raise RuntimeError("x" * 300)
            n = [len(c) if c is not None else 0 for c in pdf["retrieval_context"]]
            return pd.DataFrame({"score": [float(x) for x in n], "error": [None] * len(pdf)})

    answers = spark.createDataFrame(
        [(1, ["a ", "", None, "b"], "x", "y", ["c", " d"]), (2, ["bad"], "x", "y", None)],
        "idx long, question array<string>, generated_answer string, expected_answer string, context array<string>",
    )
    cases = K.test_cases(answers, True)
    got = {r["idx"]: r for r in cases.collect()}
    assert got[1]["input"] == "a\nb" and got[1]["retrieval_context"] == ["c\nd"] and got[2]["retrieval_context"] is None
    work = cases.coalesce(1).withColumn("metric", F.lit("m"))
    rows = {r["idx"]: r for r in SC.score_with(work, Picky).collect()}
    assert rows[1]["score"] == 1.0 and rows[1]["error"] is None
    assert rows[2]["score"] is None and rows[2]["error"] == "RuntimeError: " + "x" * 300
