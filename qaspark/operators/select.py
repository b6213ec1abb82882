"""The first ``n`` rows of an order, without sorting.

The n-th smallest key is found by histograms: rows are counted in equal
stretches of the keys' range (a partial aggregate over one column), the
stretch that holds the n-th key is divided again, and so on until it holds
few keys or one. The rows are then a filter of the table. Only the histogram
(at most ``STRETCHES`` rows) or the few keys left reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.session import ensure_checkpoint_dir

STRETCHES = 1024
FEW_KEYS = 4096

_K = "_qs_sel"


def _nth(keys: DataFrame, n: int, low: int, high: int) -> tuple[int, int, int]:
    """The n-th smallest key of ``low..high``, how many rows below it are
    wanted too, and how many rows have it."""
    below = 0
    while True:
        width = -(-(high - low + 1) // STRETCHES)
        own = keys.where(F.col(_K).between(low, high))
        place = F.col(_K).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        stretch = F.floor(place / F.lit(width).cast("decimal(20,0)")).cast("long") if width > 1 else place.cast("long")
        for r in sorted(own.groupBy(stretch.alias("s")).count().collect()):
            if below + r["count"] >= n:
                break
            below += r["count"]
        low, high = low + r["s"] * width, min(high, low + (r["s"] + 1) * width - 1)
        if low == high:
            return low, below, r["count"]
        if r["count"] <= FEW_KEYS:
            few = sorted(x[_K] for x in keys.where(F.col(_K).between(low, high)).collect())
            key = few[n - below - 1]
            return key, below + few.index(key), few.count(key)


def first_rows(df: DataFrame, n: int, key: Column, order: list) -> DataFrame:
    """The first ``n`` rows by ``key`` (a whole number; nulls first), those of
    the last key by ``order``; all rows if there are fewer."""
    keyed = df.withColumn(_K, key.cast("long"))
    ensure_checkpoint_dir(df.sparkSession)
    keys = keyed.select(_K).checkpoint(eager=True)  # one column; the rows are read once more, for the filter
    r = keys.agg(F.count(F.lit(1)).alias("n"), F.count(_K).alias("known"), F.min(_K).alias("low"), F.max(_K).alias("high")).first()
    if r["n"] <= n:
        return df
    empty = r["n"] - r["known"]
    if n <= empty:
        return keyed.where(F.col(_K).isNull()).orderBy(*order).limit(n).drop(_K)
    last, below, ties = _nth(keys.where(F.col(_K).isNotNull()), n - empty, r["low"], r["high"])
    wanted = n - empty - below
    if wanted == ties:
        return keyed.where(F.col(_K).isNull() | (F.col(_K) <= last)).drop(_K)
    sure = keyed.where(F.col(_K).isNull() | (F.col(_K) < last))
    return sure.unionByName(keyed.where(F.col(_K) == last).orderBy(*order).limit(wanted)).drop(_K)
