"""Nearest neighbours by inner product over shifted Hilbert curves.

Every vector is projected onto a few random directions, shifted and placed
on a Hilbert curve, once per ordering. Spark range-partitions each ordering;
a query scores the rows within a window of its place, and the windows of all
orderings are merged. An exact check follows: rows lie in blocks of
neighbours on the first curve, and a block whose bound (inner product with
its centre plus query length times its radius) can't reach the query's
current worst neighbour is skipped; the others are scored. The result is
exact, whatever the windows found; on clustered vectors most blocks are
skipped, on isotropic ones hardly any.

Equal vectors enter once, with their smallest ids (as many as a result can
show). Queries and blocks meet in a grid of bounded cells; no cell grows
with the input.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id or vectors of another
length than the commonest (the smaller on a tie); repeated rows count once;
fewer candidates than asked for are all returned; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaspark.llm.common import materialise, prepare

K = 20
QUERY_EVERY = 20
CURVES, AXES, BITS = 3, 8, 7
WINDOW_ROWS = 48
BLOCK_ROWS, BLOCKS_PER_CELL, QUERIES_PER_CELL = 256, 64, 1024
# Allowance for the order of summation when bounds and scores are compared.
SLACK = 1e-9


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer grid cells (rows x axes)."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        p = q - one
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(set_, p, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        flip ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def curve_keys(vectors: np.ndarray, scale: float, curve: int) -> np.ndarray:
    """Keys of one ordering: its own directions and its own shift."""
    rng = np.random.Generator(np.random.PCG64([20240711, curve, vectors.shape[1]]))
    axes = rng.standard_normal((vectors.shape[1], AXES))
    axes /= np.linalg.norm(axes, axis=0)
    shift = rng.random(AXES)
    side = 1 << BITS
    # four standard deviations of a projected coordinate span the grid
    place = (vectors @ axes) / max(scale, 1e-300) / 8 + 0.5 + (shift - 0.5) / side * 8
    return hilbert_keys(np.clip(np.floor(place * side), 0, side - 1), BITS)


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64) if len(column) else np.empty((0, 1))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, the same for a pair wherever it's scored."""
    return (a * b).sum(axis=-1)


def _ordered(scale: float, curves: range):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                v = _matrix(pdf["v"])
                for c in curves:
                    yield pdf.assign(curve=c, key=curve_keys(v, scale, c))[["curve", "key", "uid", "asked", "v"]]

    return run


def _windows(k: int):
    """Best rows of each query's window; ``batches`` are in curve order."""

    def score(buf: pd.DataFrame, first: int, last: int) -> pd.DataFrame | None:
        asked = np.flatnonzero(buf["asked"].to_numpy()[first:last]) + first
        if not len(asked):
            return None
        v, ids, curve = _matrix(buf["v"]), buf["uid"].to_numpy(), buf["curve"].to_numpy()
        rows = []
        for part in np.array_split(asked, max(1, len(asked) // 64)):
            at = np.clip(part[:, None] + np.arange(-WINDOW_ROWS, WINDOW_ROWS + 1), 0, len(v) - 1)
            s = _dots(v[part][:, None, :], v[at])
            s[curve[at] != curve[part][:, None]] = -np.inf
            best = np.argsort(-s, axis=1, kind="stable")[:, : 2 * k]
            rows.append(
                pd.DataFrame(
                    {
                        "uid": np.repeat(ids[part], best.shape[1]),
                        "found": np.take_along_axis(ids[at], best, 1).ravel(),
                        "score": np.take_along_axis(s, best, 1).ravel(),
                    }
                )
            )
        out = pd.concat(rows).drop_duplicates(["uid", "found"])
        return out[np.isfinite(out["score"])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buf, done = None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            buf = pdf if buf is None else pd.concat([buf, pdf], ignore_index=True)
            ready = max(done, len(buf) - WINDOW_ROWS)
            if (out := score(buf, done, ready)) is not None:
                yield out
            cut = max(0, ready - WINDOW_ROWS)
            buf, done = buf.iloc[cut:].reset_index(drop=True), ready - cut
        if buf is not None and (out := score(buf, done, len(buf))) is not None:
            yield out

    return run


def _packed(rows: int):
    """Rows of one partition, in order, as blocks of one matrix each."""

    def block(pdf: pd.DataFrame) -> tuple:
        v = _matrix(pdf["v"])
        floor = pdf["floor"].to_numpy(np.float64) if "floor" in pdf else np.zeros(len(pdf))
        return int(pdf["uid"].iloc[0]), pdf["uid"].to_numpy(np.int64).tobytes(), v.tobytes(), floor.tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buf = None
        for pdf in batches:
            buf = pdf if buf is None else pd.concat([buf, pdf], ignore_index=True)
            out = []
            while len(buf) >= rows:
                out.append(block(buf.iloc[:rows]))
                buf = buf.iloc[rows:]
            if out:
                yield pd.DataFrame(out, columns=["block", "ids", "vectors", "floors"])
        if buf is not None and len(buf):
            yield pd.DataFrame([block(buf)], columns=["block", "ids", "vectors", "floors"])

    return run


def _cell(k: int):
    """Scores of one cell's queries against its blocks, unless a block's
    bound lies under a query's floor."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, qs in left.iterrows():
            uid = np.frombuffer(qs["ids"], np.int64)
            q = np.frombuffer(qs["vectors"], np.float64).reshape(len(uid), -1)
            floor = np.frombuffer(qs["floors"], np.float64) - SLACK
            length = np.linalg.norm(q, axis=1)
            best_s, best_i = np.full((len(uid), k), -np.inf), np.zeros((len(uid), k), np.int64)
            for _, rows in right.iterrows():
                ids = np.frombuffer(rows["ids"], np.int64)
                v = np.frombuffer(rows["vectors"], np.float64).reshape(len(ids), -1)
                centre = v.mean(axis=0)
                radius = np.sqrt(((v - centre) ** 2).sum(axis=1).max())
                near = np.flatnonzero(q @ centre + length * radius + SLACK >= np.maximum(floor, best_s[:, -1]))
                if not len(near):
                    continue
                s = q[near] @ v.T
                hit = s >= np.maximum(floor, best_s[:, -1] - SLACK)[near][:, None]
                for row in np.flatnonzero(hit.any(axis=1)):
                    at, cols = near[row], np.flatnonzero(hit[row])
                    exact = _dots(q[at], v[cols])
                    all_s, all_i = np.r_[best_s[at], exact], np.r_[best_i[at], ids[cols]]
                    order = np.lexsort((all_i, -all_s))[:k]
                    best_s[at], best_i[at] = all_s[order], all_i[order]
            keep = np.isfinite(best_s)
            at = np.nonzero(keep)[0]
            out.append(pd.DataFrame({"uid": uid[at], "found": best_i[keep], "score": best_s[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"uid": [], "found": [], "score": []})

    return run


def nearest(rows: DataFrame, k: int = K, query_every: int = QUERY_EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible
    by ``query_every``, the ``k`` other rows of largest inner product."""
    spark = rows.sparkSession
    prepare(spark)
    # adding 0.0 makes -0.0 and 0.0 one value
    v = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))
    ok = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0.0)
    )
    sizes = ok.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    ok = ok.where(F.size("v") == (sizes[0]["d"] if sizes else 0)).withColumns({"h1": F.xxhash64("v"), "h2": F.hash("v")})

    # equal vectors become one, with their smallest ids
    slim = ok.select("h1", "h2", "vec_id").distinct()
    rank = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    few = slim.withColumn("_r", rank).where(F.col("_r") <= k + 1)
    is_query = F.pmod("vec_id", F.lit(query_every)) == 0
    uniq = slim.groupBy("h1", "h2").agg(F.min("vec_id").alias("uid"), F.max(is_query).alias("asked"))
    uniq = materialise(uniq, "equal")
    ids = materialise(few.join(uniq, ["h1", "h2"]).select(F.col("uid").alias("found"), "vec_id"), "ids")
    queries = slim.where(is_query).join(uniq, ["h1", "h2"]).select("uid", F.col("vec_id").alias("query_id"))
    vectors = ok.join(uniq, ["h1", "h2"]).where("vec_id = uid").select("uid", "asked", "v").dropDuplicates(["uid"])
    vectors = materialise(vectors, "vectors")

    row = vectors.agg(F.avg(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("sq"), F.count(F.lit(1)).alias("n"), F.sum(F.col("asked").cast("long")).alias("q"))
    stats = row.withColumn("d", F.lit(sizes[0]["d"] if sizes else 1)).first()
    n, n_asked = stats["n"], stats["q"] or 0
    scale = float(((stats["sq"] or 1.0) / stats["d"]) ** 0.5)
    on_curve = "curve int, key long, uid long, asked boolean, v array<double>"
    order = ["curve", "key", "uid"]

    curves = vectors.mapInPandas(_ordered(scale, range(CURVES)), on_curve).repartitionByRange(*order).sortWithinPartitions(*order)
    windows = curves.mapInPandas(_windows(k + 1), "uid long, found long, score double").distinct()
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "found")
    windows = materialise(windows.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r"), "windows")
    floors = windows.groupBy("uid").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n"))
    floors = floors.select("uid", F.when(F.col("n") > k, F.col("s")).otherwise(float("-inf")).alias("floor"))

    one = vectors.mapInPandas(_ordered(scale, range(1)), on_curve).repartitionByRange(*order).sortWithinPartitions(*order)
    packed = "block long, ids binary, vectors binary, floors binary"
    blocks = one.drop("asked").mapInPandas(_packed(BLOCK_ROWS), packed)
    asked = one.where("asked").join(floors, "uid", "left").select("key", "uid", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    asked = asked.repartitionByRange("key", "uid").sortWithinPartitions("key", "uid").mapInPandas(_packed(BLOCK_ROWS), packed)
    across = max(1, -(-n // (BLOCK_ROWS * BLOCKS_PER_CELL)))
    down = max(1, -(-n_asked // QUERIES_PER_CELL))
    cell = lambda df, own, other, m_own, m_other: df.withColumn(own, F.pmod(F.xxhash64("block"), F.lit(m_own))).withColumn(
        other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m_other - 1).cast("long")))
    )
    left = cell(asked, "i", "j", down, across).groupBy("i", "j")
    right = cell(blocks, "j", "i", across, down).groupBy("i", "j")
    checked = left.cogroup(right).applyInPandas(_cell(k + 1), "uid long, found long, score double")

    merged = windows.unionByName(checked).distinct()
    merged = merged.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")
    shown = merged.join(ids, "found")
    by_id = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    shown = shown.withColumn("_r", F.row_number().over(by_id)).where(F.col("_r") <= k + 1)
    lists = shown.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("l"))
    own = queries.join(lists, "uid").select("query_id", F.filter("l", lambda x: x["vec_id"] != F.col("query_id")).alias("l"))
    out = own.select("query_id", F.posexplode(F.slice("l", 1, k)).alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
