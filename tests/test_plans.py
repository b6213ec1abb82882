"""Physical plan shape: pruning, group limits, no single-partition steps,
no Python in the column-scorer path."""

from pyspark.sql import functions as F

from qaspark.operators import corpus as C
from qaspark.operators import split as S
from qaspark.operators.order import running_sums
from qaspark.plans import derived as D
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_split_prunes_columns_and_limits_groups(spark):
    df = S.split_sizes(S.stratified_split(D.qa_docs(spark, SF_SMALL)))
    plan = _plan(df)
    assert "WindowGroupLimit" in plan
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_dedupe_is_a_partial_aggregate(spark):
    plan = _plan(C.dedupe_first(D.qa_docs(spark, SF_SMALL)))
    assert "Window" not in plan
    assert "HashAggregate" in plan and "partial_min(" in plan


def test_running_sums_have_no_single_partition(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = running_sums(ev, ["ts", "event_id"], {"s": "user_id"})
    # only the table of one row per range is ordered in one task
    assert _plan(out).count("SinglePartition") <= 1 and "BroadcastHashJoin" in _plan(out)
    ranged = ev.repartitionByRange(4, "ts", "event_id")
    assert "rangepartitioning" in _plan(ranged)


def test_column_scorers_stay_in_the_jvm(spark):
    from qaspark.plans.q_eval import _scores

    plan = _plan(_scores(spark, SF_SMALL))
    assert "Python" not in plan and "ArrowEval" not in plan


def test_filter_reaches_the_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").where(F.col("event_type") == "error").select("event_id")
    plan = _plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan


def test_ranges_need_no_literal_per_range(spark):
    """Offsets of 20,000 ranges come from a joined table: the plan has no
    array of literals and is made quickly."""
    import time

    from qaspark.operators import order as O

    tagged = spark.range(0, 200_000, 1, 64).select("id", (F.col("id") % 20_000).alias(O._B), F.floor(F.col("id") / 20_000).alias(O._P))
    start = time.perf_counter()
    plan = _plan(O.add_totals(tagged, {"n": F.count(F.lit(1))}))
    assert time.perf_counter() - start < 5
    assert len(plan) < 20_000 and "Join" in plan


def test_dedupe_first_is_a_hash_aggregate(spark):
    from qaspark.operators.corpus import dedupe_first

    plan = _plan(dedupe_first(spark.createDataFrame([(1, "a")], "id long, question string")))
    assert "HashAggregate" in plan
