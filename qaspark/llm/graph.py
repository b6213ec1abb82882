"""Connected components of an edge list, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.llm.common import materialise


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges ``u > v``. Minima
    are partial aggregates, and the joins are on a key that is unique on one
    side, so a hub with very many edges can be split."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low2 = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low2.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for every node that has an edge and isn't the
    smallest of its component, the smallest node it reaches. Alternates
    large-star and small-star steps until the edges are a star forest, which
    takes a number of rounds that grows with the logarithm of the longest
    path; every round's table is written to the shared folder."""
    flat = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = materialise(flat, "edges")
    last = _fingerprint(now)
    while last[0]:
        now = materialise(_round(now), "edges")
        mark = _fingerprint(now)
        if mark == last:
            break
        last = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
