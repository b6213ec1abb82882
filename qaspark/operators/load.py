"""Call-load analysis.

The reference throttles judge calls in process: a shared log of (time,
tokens) pruned to the last 60 s, at most 30 calls and 4,200 tokens per
window. Here the same rules are questions about a call log table.

Trailing windows are exact and skew-proof: for every call at time ``t`` the
load in ``(t - width, t]`` is ``P(upper probe) - P(lower probe)``, where
``P`` is a global prefix sum over (key, time) order built by range
partitioning (``qaspark.operators.order``), and the probes are extra rows
sorted after all calls at ``t`` and at ``t - width``. A key or a burst
holding a third of all calls is split across ranges like any other rows;
no per-key window puts it into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.functions.text import error_class, token_estimate  # noqa: F401 (re-exported)
from qaspark.operators.order import running_sums

# Retry back-off cap and factor, number of attempts.
BACKOFF_CAP_S = 10
BACKOFF_FACTOR_S = 2
MAX_RETRIES = 5

# The generator's categories, in order.
GENERATOR_CATEGORIES = (
    "Engine Diagnostics", "Transmission Systems", "Braking & Hydraulics",
    "Electrical & Canbus", "Suspension & Steering", "Exhaust Emissions",
    "Cooling & Thermal", "Fuel Delivery Systems", "HVAC Diagnostics",
)

_US = 1_000_000


def rolling_window(calls: DataFrame, ts: str = "ts", id_col: str = "event_id", keys=(),
                   width_s: int = 60, values=("tokens",), oldest: bool = False) -> DataFrame:
    """Per call: ``n_calls`` and ``<v>_in_window`` for each value column over
    the calls of the same key with time in ``(t - width, t]`` (W5). With
    ``oldest=True`` also ``oldest_us``: the earliest call time in that window."""
    keys = list(keys)
    width = int(width_s) * _US
    base = calls.select(*keys, F.col(id_col).alias("_id"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"),
                        *[F.col(v).cast("long").alias(f"_v_{v}") for v in values])
    rows = base.select(*keys, "_id", "_t", F.lit(0).alias("_kind"), F.lit(1).alias("_w"),
                       *[f"_v_{v}" for v in values])
    zero = [F.lit(0).cast("long").alias(f"_v_{v}") for v in values]
    hi = base.select(*keys, "_id", "_t", F.lit(1).alias("_kind"), F.lit(0).alias("_w"), *zero)
    lo = base.select(*keys, "_id", (F.col("_t") - width).alias("_t"), F.lit(2).alias("_kind"), F.lit(0).alias("_w"),
                     *zero)
    # probes sort after every call at the same (key, time): kind 1 and 2 > 0
    u = rows.unionByName(hi).unionByName(lo)
    sums = {"_c": "_w", **{f"_s_{v}": f"_v_{v}" for v in values}}
    pref = running_sums(u, keys + ["_t", F.when(F.col("_kind") == 0, 0).otherwise(1), "_id", "_kind"], sums)
    probes = pref.where(F.col("_kind") > 0).groupBy("_id").agg(
        *[F.max(F.when(F.col("_kind") == 1, F.col(c))).alias(f"hi{c}") for c in sums],
        *[F.max(F.when(F.col("_kind") == 2, F.col(c))).alias(f"lo{c}") for c in sums],
    )
    out = probes.select(
        "_id",
        (F.col("hi_c") - F.col("lo_c")).alias("n_calls"),
        *[(F.col(f"hi_s_{v}") - F.col(f"lo_s_{v}")).alias(f"{v}_in_window") for v in values],
        F.col("lo_c").alias("_lo_c"),
    )
    if oldest:
        # the oldest call in the window is the call right after the lower probe
        pos = pref.where(F.col("_kind") == 0).select(F.col("_c").alias("_pos"), F.col("_t").alias("oldest_us"))
        out = out.join(pos, F.col("_lo_c") + 1 == F.col("_pos"), "left").drop("_pos")
    return out.drop("_lo_c").withColumnRenamed("_id", id_col)


def rate_breaches(window: DataFrame, max_calls: int = 30, max_tokens: int = 4200, tokens: str = "tokens") -> DataFrame:
    """Calls the limiter would have held back: more than ``max_calls`` calls or
    ``max_tokens`` tokens in the window ending at the call."""
    return window.where((F.col("n_calls") > max_calls) | (F.col(f"{tokens}_in_window") > max_tokens))


def suggested_wait(window: DataFrame, calls: DataFrame, ts: str = "ts", id_col: str = "event_id",
                   width_s: int = 60, min_s: float = 1.0, max_s: float = 30.0) -> DataFrame:
    """Wait before the next call (F16): ``clamp(oldest + width + 1 - now, 1, 30)``
    seconds, with ``oldest`` the earliest call in the window ending at ``now``."""
    now = calls.select(F.col(id_col), F.unix_micros(F.col(ts).cast("timestamp")).alias("_now"))
    j = window.join(now, id_col)
    raw = (F.col("oldest_us") + F.lit((width_s + 1) * _US) - F.col("_now")) / F.lit(float(_US))
    return j.select(id_col, F.greatest(F.lit(float(min_s)), F.least(F.lit(float(max_s)), raw)).alias("wait_s"))


def budget_slots(calls: DataFrame, ts: str = "ts", id_col: str = "event_id", tokens: str = "tokens",
                 budget: int = 4200) -> DataFrame:
    """Per-minute token slots for calls in time order (W7):
    ``floor((running tokens before the call) / budget)``. The exact greedy
    packing of the reference is sequential; this floor form is the
    contract (a slot may overrun by part of one call)."""
    pref = running_sums(calls.select(id_col, ts, tokens), [ts, id_col], {"_run": tokens})
    return pref.select(id_col, F.floor((F.col("_run") - F.col(tokens)) / F.lit(budget)).cast("long").alias("slot"))


def empty_streaks(rounds: DataFrame, key: str, ts: str, id_col: str, empty, stop_after: int = 80) -> DataFrame:
    """Runs of consecutive empty rounds per key (W6, gaps and islands): the
    island of a round is the number of non-empty rounds up to it (a global
    prefix sum in (key, time) order, so per key it only grows). Streaks are
    then a partial aggregate per (key, island)."""
    flagged = rounds.select(key, ts, id_col, F.when(empty, 0).otherwise(1).alias("_ne"), empty.alias("_empty"),
                            F.lit(1).alias("_one"))
    # the same pass numbers the rounds, so the streak start is a min_by over
    # one long (fixed-width buffer: hash aggregate, not sort aggregate)
    pref = running_sums(flagged, [key, ts, id_col], {"_island": "_ne", "_pos": "_one"})
    streaks = pref.where(F.col("_empty")).groupBy(key, "_island").agg(
        F.min_by(F.col(id_col), F.col("_pos")).alias("start_id"),
        F.count(F.lit(1)).alias("length"),
    )
    return streaks.select(key, "start_id", "length", (F.col("length") >= stop_after).alias("stopped"))


def retry_schedule(failed: DataFrame, id_col: str = "event_id", max_retries: int = MAX_RETRIES) -> DataFrame:
    """Back-off before each retry of a failed call (F15): ``min(10, 2 * attempt)``
    seconds for attempts ``1 .. max_retries - 1``."""
    att = failed.select(id_col, F.explode(F.sequence(F.lit(1), F.lit(max_retries - 1))).alias("attempt"))
    return att.select(id_col, F.col("attempt").cast("long").alias("attempt"),
                      F.least(F.lit(BACKOFF_CAP_S), F.col("attempt") * BACKOFF_FACTOR_S).cast("long").alias("cooldown_s"))


def charged_tokens(actual, estimate):
    """Tokens charged to the log: reported usage, else the estimate."""
    return F.coalesce(actual, estimate)


def request_plan(rounds: DataFrame, id_col: str, categories=GENERATOR_CATEGORIES) -> DataFrame:
    """A category per generation round (L7): md5 of the round id, first 32
    bits as a number, modulo the number of categories; the category list is
    inlined as a literal array (no join)."""
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long")
    bucket = (h % F.lit(len(categories))).cast("long")
    names = F.array(*[F.lit(c) for c in categories])
    return rounds.select(F.col(id_col).alias("n"), bucket.alias("bucket")).withColumn(
        "category", F.element_at(names, F.col("bucket").cast("int") + 1))


def overlong(df: DataFrame, text: str, limit: int) -> DataFrame:
    """Rows whose text would be truncated at ``limit`` tokens (P9), with the
    estimate ``len // 4``."""
    est = F.floor(F.length(F.col(text)) / F.lit(4)).cast("long")
    return df.withColumn("tokens", est).where(F.col("tokens") > limit)
