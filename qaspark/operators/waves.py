"""Scoring in waves with a journal (X1 with X2).

A work list is scored by an external judge in bounded waves. Every wave is
committed to the journal before the next one begins, as a folder of its own
with one row for each (case, metric, metric definition). A run that starts
anew scores only pairs that the journal doesn't hold; a wave whose writing
was cut off is not in it. A lost executor repeats tasks of its wave only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaspark.operators.cases import MetricSpec, specs_frame
from qaspark.operators.score import score_with
from qaspark.session import ensure_checkpoint_dir

_KEY = ["idx", "metric", "spec_hash"]
_SCHEMA = "idx long, metric string, spec_hash string, score double, error string, wave int"


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all waves; none if there is no journal yet."""
    try:
        return spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)


def latest_scores(journal: DataFrame) -> DataFrame:
    """One row a pair: the entry of its last wave (a pair has several if
    failed ones were tried again)."""
    last = journal.groupBy(*_KEY).agg(F.max_by(F.struct("score", "error"), "wave").alias("e"))
    return last.select(*_KEY, "e.score", "e.error")


def score_in_waves(worklist: DataFrame, specs: list[MetricSpec], scorer_factory: Callable[[], object], journal: str,
                   wave_rows: int = 100_000, max_waves: int | None = None, retry_failed: bool = False) -> int:
    """Score the pairs of ``worklist`` (``idx, metric`` and the case's fields)
    that the journal doesn't hold, in waves of about ``wave_rows`` pairs, of
    which at most ``max_waves`` are run; returns how many were. A metric whose
    definition has changed is scored again. With ``retry_failed`` pairs with
    an error are, too."""
    spark = worklist.sparkSession
    ensure_checkpoint_dir(spark)
    held = read_journal(spark, journal)
    first = (held.agg(F.max("wave")).first()[0] or 0) + 1
    done = latest_scores(held)
    if retry_failed:
        done = done.where(F.col("error").isNull())
    hashes = F.broadcast(specs_frame(spark, specs).select("metric", "spec_hash"))  # a row for each metric
    pending = worklist.join(hashes, "metric").join(done.select(*_KEY), _KEY, "left_anti").checkpoint(eager=True)
    waves = -(-pending.count() // wave_rows)
    run = min(waves, max_waves) if max_waves is not None else waves
    for k in range(run):
        wave = pending.where(F.pmod(F.xxhash64(*_KEY), F.lit(waves)) == k)
        scored = score_with(wave, scorer_factory).join(hashes, "metric")
        scored.select(*_KEY, "score", "error").write.mode("overwrite").parquet(f"{journal.rstrip('/')}/wave={first + k}")
    return run
