"""Queries: streaming jobs, read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaspark.plans.registry import register
from qaspark.plans.sqltext import CALL_LOG, QA_DOCS, SCORE_LOG, strip, with_
from qaspark.session import scratch_path
from qaspark.sources.tables import load
from qaspark.streaming import streams as ST

_T0 = 1704067200  # 2024-01-01 00:00:00 UTC: arrival time of document 0


@register(
    "stream_dedupe",
    with_(QA_DOCS) + f"select distinct {strip('question')} as question_key from qa_docs",
)
def stream_dedupe(spark, sf_dir):
    """First-seen dedupe as documents arrive (document ``i`` at second
    ``i``): the first half arrives, the stream stops, the second half
    arrives and the stream resumes; copies across the stop are still
    left out."""
    base = scratch_path(spark, "stream-dedupe")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.timestamp_seconds(F.lit(_T0) + F.col("doc_id")).alias("ts"), "text")
    half = docs.agg(F.percentile_approx("doc_id", 0.5).alias("m")).collect()[0]["m"]  # one number
    for part in (F.col("doc_id") <= half, F.col("doc_id") > half):
        docs.where(part).write.mode("append").parquet(src)
        arrivals = ST.file_stream(spark, src, docs.schema)
        ST.dedupe_stream(arrivals, ST.question_key(), ["doc_id"], out, ckpt)
    return spark.read.parquet(out).select("question_key")


@register(
    "stream_load",
    with_(CALL_LOG) + """select cast(floor(epoch_us(ts) / 600000000) * 600 - k * 600 as bigint) as window_start,
       count(*) as n_calls, cast(sum(tokens) as bigint) as tokens
from call_log, range(0, 6) r(k) group by 1""",
)
def stream_load(spark, sf_dir):
    """Sliding-window call load in update mode: each batch appends the
    windows it changed, the watermark evicts finished windows from state,
    and the final value of a window is its row from the latest batch. The
    input arrives in two parts with a restart in between."""
    base = scratch_path(spark, "stream-load")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    ev = load(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"),
                                              F.floor(F.col("value") * F.lit(10.0)).cast("long").alias("tokens"))
    cut = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    for part in (cut, ~cut):
        ev.where(part).write.mode("append").parquet(src)
        ST.run_to_parquet(ST.load_stream(ST.file_stream(spark, src, ev.schema)), out, ckpt, mode="update")
    res = ST.latest_per_key(spark.read.parquet(out), "w")
    return res.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "n_calls", "tokens")


def _score_stream(ev):
    return ev.select(
        F.col("event_id").alias("idx"),
        F.when(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), F.lit("baseline"))
        .otherwise(F.lit("finetuned")).alias("run"),
        F.col("event_type").alias("metric"),
        F.least(F.col("value") / F.lit(100.0), F.lit(1.0)).alias("score"),
    )


@register(
    "stream_metrics",
    with_(SCORE_LOG) + """select run, metric, avg(score) as avg_score,
       avg(case when score >= 0.7 then cast(1.0 as double) else cast(0.0 as double) end) as pass_rate,
       count(score) as n
from score_log where score is not null group by run, metric""",
)
def stream_metrics(spark, sf_dir):
    """Running mean, pass rate and count per (run, metric) as score rows
    arrive in two parts with a restart in between; the per-metric state
    (a few keys) is kept in the checkpoint and the sink holds the full
    result table."""
    base = scratch_path(spark, "stream-metrics")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    cut = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (cut, ~cut):
        ev.where(part).write.mode("append").parquet(src)
        scores = _score_stream(ST.file_stream(spark, src, ev.schema))
        ST.run_to_parquet(ST.metrics_stream(scores), out, ckpt, mode="complete")
    return ST.latest_batch(spark.read.parquet(out))


@register(
    "stream_resume",
    "select event_type, count(*) as n, cast(sum(cast(value as decimal(12, 2))) as double) as total "
    "from events group by event_type",
)
def stream_resume(spark, sf_dir):
    """Stop after the first part of the input, add the rest, restart from
    the same checkpoint: every row is in the sink exactly once."""
    base = scratch_path(spark, "stream-resume")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    cut = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    ev.where(cut).write.mode("append").parquet(src)
    schema = ev.schema
    ST.run_to_parquet(ST.file_stream(spark, src, schema, max_files=1), out, ckpt)
    ev.where(~cut).write.mode("append").parquet(src)
    ST.run_to_parquet(ST.file_stream(spark, src, schema, max_files=1), out, ckpt)
    rows = spark.read.parquet(out)
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total"),
    )


STALL_AFTER = 3


@register(
    "stream_stall",
    f"""with s as (select user_id, ts, event_id, event_type = 'error' as e,
       sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id
           rows between unbounded preceding and current row) as island,
       row_number() over (partition by user_id order by ts desc, event_id desc) as back from events),
streaks as (select user_id, island, count(*) as length from s where e group by 1, 2),
last_ as (select user_id, island as last_island, e as last_empty from s where back = 1),
agg as (select u.user_id, coalesce(max(st.length), 0) as longest,
               coalesce(max(case when l.last_empty and st.island = l.last_island then st.length end), 0) as current
        from (select distinct user_id from events) u left join streaks st on st.user_id = u.user_id
             left join last_ l on l.user_id = u.user_id group by u.user_id)
select user_id, cast(longest as bigint) as longest, cast(current as bigint) as current,
       longest >= {STALL_AFTER} as stalled from agg""",
)
def stream_stall(spark, sf_dir):
    """Empty-round streaks as stream state: the first half of January
    arrives, the stream stops, the rest arrives and the stream resumes from
    its checkpoint, so streaks running across the cut continue from state."""
    base = scratch_path(spark, "stream-stall")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    cut = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (cut, ~cut):
        ev.where(part).write.mode("append").parquet(src)
        stream = ST.file_stream(spark, src, ev.schema)
        rounds = stream.select("user_id", "ts", "event_id", (F.col("event_type") == "error").alias("empty"))
        ST.stall_stream(rounds, ["ts", "event_id"], out, ckpt, stall_after=STALL_AFTER)
    return ST.latest_per_key(spark.read.parquet(out), "user_id")


_CUTS = """with e as (select epoch_us(ts) as us, ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' as late from events),
mark as (select (max(us) - 3600000000) // 1000 * 1000 as w from e where not late),
hours as (select us // 3600000000 * 3600000000 as s, count(*) as n from e where not late group by 1)
"""


def _arrivals(spark, sf_dir):
    """Early events, then those of late January, then those from between."""
    ev = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    early = F.col("ts") < F.lit("2024-01-10 00:00:00").cast("timestamp")
    late_jan = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp")
    return ev, (early, late_jan, ~early & ~late_jan)


def _late(spark, sf_dir):
    """Late rows behind the watermark are dropped (T6, N11): early events
    arrive first, late-January events next, then the events from between;
    each part is added and the stream restarted from the same checkpoint, so
    the arrival order is fixed and the watermark set by the second part is in
    force when the third arrives."""
    base = scratch_path(spark, "stream-late")
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    ev, parts = _arrivals(spark, sf_dir)
    for part in parts:
        ev.where(part).write.mode("append").parquet(src)
        stream = ST.file_stream(spark, src, ev.schema)
        agg = stream.withWatermark("ts", "1 hour").groupBy(F.window("ts", "60 minutes").alias("w")).agg(
            F.count(F.lit(1)).alias("n"))
        ST.run_to_parquet(agg, out, ckpt)
    windows = spark.read.parquet(out)
    n_between = ev.where(parts[2]).count()
    start = F.col("w.start")
    late_window = (start >= F.lit("2024-01-10 00:00:00").cast("timestamp")) & (
        start < F.lit("2024-01-20 00:00:00").cast("timestamp"))
    return windows.agg(F.count(F.lit(1)).alias("n_windows"), F.sum("n").alias("n_rows_out"),
                       F.count_if(late_window).cast("long").alias("n_late_windows_out")).select(
        "n_windows", "n_rows_out", "n_late_windows_out", F.lit(int(n_between)).cast("long").alias("n_late_input"))


def _marked(spark, ev, parts, name):
    """All rows with ``late``, as they arrive part by part."""
    base = scratch_path(spark, name)
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/checkpoint"
    for part in parts:
        ev.where(part).coalesce(1).write.mode("append").parquet(src)
    ST.late_stream(ST.file_stream(spark, src, ev.schema, max_files=1), out, ckpt)
    return ST.read_marked(spark, out)


@register(
    "stream_late",
    _CUTS + """select count(*) as n_windows, cast(sum(n) as bigint) as n_rows_out, cast(0 as bigint) as n_late_windows_out,
       (select count(*) from e, mark where late and us // 3600000000 * 3600000000 + 3600000000 <= w) as n_dropped,
       (select count(*) from e where late) as n_late_input
from hours, mark where s + 3600000000 <= w""",
)
def stream_late(spark, sf_dir):
    """The windows that the stream gives out, and the rows that it drops,
    counted in the table of late rows that a second stream keeps."""
    ev, parts = _arrivals(spark, sf_dir)
    n_dropped = _marked(spark, ev, parts, "stream-late-rows").where("late").count()
    return _late(spark, sf_dir).withColumn("n_dropped", F.lit(n_dropped).cast("long"))


_PERIOD_DAYS = 3  # of arrivals that form a batch; every tenth event arrives in the next one


@register(
    "stream_late_rows",
    f"""with e as (select event_id, epoch_us(ts) as us, epoch_us(ts) // {_PERIOD_DAYS * 86_400_000_000}
       + case when event_id % 10 = 0 then 1 else 0 end as period from events),
d as (select period, max(max(us)) over (order by period rows between unbounded preceding and 1 preceding) - 3600000000 as mark
      from e group by period)
select event_id, period, us // 3600000000 * 3600000000 + 3600000000 <= mark and mark is not null as late
from e join d using (period)""",
)
def stream_late_rows(spark, sf_dir):
    """Events that arrive three days a batch, every tenth a batch late: each
    row with its verdict."""
    ev = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    arrival = F.floor(F.unix_micros("ts") / F.lit(_PERIOD_DAYS * 86_400_000_000)) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    ev = ev.withColumn("period", arrival.cast("long"))
    periods = [r["period"] for r in ev.select("period").distinct().orderBy("period").collect()]  # one for each batch
    rows = _marked(spark, ev, [F.col("period") == p for p in periods], "stream-late-periods")
    return rows.select("event_id", "period", "late")


@register(
    "stream_late_windows",
    _CUTS + """select count(*) as n_windows, cast(sum(n) as bigint) as n_rows_out, cast(0 as bigint) as n_late_windows_out,
       (select count(*) from e where late) as n_late_input
from hours, mark where s + 3600000000 <= w""",
)
def stream_late_windows(spark, sf_dir):
    """What the late-row stream gives out: the windows closed by the
    watermark of the second part, and none of the late ones."""
    return _late(spark, sf_dir)
