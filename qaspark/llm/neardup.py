"""Near duplicates by HyperMinHash.

A document's set holds its distinct five-word shingles (A-Z lower-cased).
Each shingle hash falls into one of ``BUCKETS`` buckets; a bucket keeps the
smallest value seen as a 16-bit register: its count of leading zeros plus
ten mantissa bits. Buckets that got no shingle borrow the register of the
first filled bucket in a fixed random order of their own, so that every
register agrees between two documents with a probability equal to their
Jaccard similarity, whatever the size of the sets.

Bands of ``ROWS`` registers are hashed to keys. In a group of documents with
one key, the smallest is compared with each of the others (a star, not all
pairs): first in the groups of ``FIRST_BANDS`` bands, which link most near
copies, then in those of all bands the member with the fewest shingles of its
own with the others that don't lie in its component yet. What is left are the
documents of groups that lie in different components after that. They meet by
an exact prefix filter: shingles are ordered by the number of these documents
that hold them, and a pair that is a link has a shingle in common among the
rarest of both, the fewer the higher the threshold. A shingle that several
components hold joins the documents outside its largest component with the
others; one that very many hold is dealt over several keys. A pair is first
held against the collision-corrected Jaccard estimate of the registers (with a
wide margin) and then confirmed on the full sets. Copies with an equal set
enter as one.

The least similarity of a link is a parameter; the bands follow from it. A
pair at 0.85 shares none of 50 bands of 8, and one at 0.80 none of 70 bands
of 7, with a probability of about 1e-7, and less above it.

Defined cases: null or empty texts and texts without words have an empty set
and link with nothing; rows with a null id link with nothing and are their
own group; equal rows get equal results; rows that share an id but not a
text count as versions of one document, linked if any version links.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaspark.llm.common import materialise, prepare
from qaspark.llm.graph import components
from qaspark.operators.order import reindex

SHINGLE = 5
BANDS, ROWS = 50, 8
BUCKETS = BANDS * ROWS
MANTISSA = 10
THRESHOLD_PERCENT = 85
# Least similarity in percent -> bands and their rows.
SHAPES = {85: (BANDS, ROWS), 80: (70, 7)}
# Standard deviations by which an estimate may lie under the threshold.
MARGIN = 7.0
# Ids of candidate documents up to this many rows (16 MB) are broadcast to
# pick their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

# Bands whose groups are compared before those of all bands.
FIRST_BANDS = 8

# Holders of one shingle that a key of the last join takes.
HOLDERS = 4096

_SKETCH_SCHEMA = "doc_id long, n_shingles long, h1 long, h2 long, regs binary"
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: xor-shift and multiply steps."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(seed)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Word -> 64-bit hash, emptied when it grows past a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 50_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(text: str | None, known: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    with np.errstate(over="ignore"):
        if n < SHINGLE:
            total = np.uint64(n)
            for i in range(n):
                total = total + h[i] * _ODD[i]
            s = np.array([total], np.uint64)
        else:
            s = sum((h[i : n - SHINGLE + 1 + i] * _ODD[i] for i in range(1, SHINGLE)), h[: n - SHINGLE + 1] * _ODD[0])
    return np.unique(_mix(s, 1))


def shape_of(percent: int) -> tuple[int, int]:
    """Bands and rows for links of at least so many percent."""
    fit = [p for p in SHAPES if p <= percent]
    if not fit:
        raise ValueError(f"no bands for a similarity of {percent} percent; the least is {min(SHAPES)}")
    return SHAPES[max(fit)]


@functools.lru_cache(maxsize=2)
def _borrow_order(buckets: int) -> np.ndarray:
    """For each bucket, the rank of every bucket in its fixed random order."""
    rng = np.random.Generator(np.random.PCG64(20240711))
    return rng.permuted(np.tile(np.arange(buckets, dtype=np.uint16), (buckets, 1)), axis=1)


def registers(shingles: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """The ``buckets`` registers of a non-empty set, empty ones borrowed."""
    bucket = ((shingles >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    value = _mix(shingles, 2) >> np.uint64(11)  # 53 bits
    low = np.full(buckets, np.uint64(2**64 - 1))
    np.minimum.at(low, bucket.astype(np.int64), value)
    filled = np.flatnonzero(low != np.uint64(2**64 - 1))
    v = low[filled]
    zeros = 53 - np.frexp(v.astype(np.float64))[1]
    rest = (v << (zeros + 1).astype(np.uint64)) & np.uint64(2**53 - 1)
    reg = np.zeros(buckets, np.uint16)
    reg[filled] = ((np.minimum(zeros, 62).astype(np.uint16) + 1) << MANTISSA) | (rest >> np.uint64(53 - MANTISSA)).astype(np.uint16)
    empty = np.flatnonzero(low == np.uint64(2**64 - 1))
    if len(empty):
        reg[empty] = reg[filled[_borrow_order(buckets)[np.ix_(empty, filled)].argmin(axis=1)]]
    return reg


def _sketches(batches, buckets: int):
    known = _WordHashes()
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            s = shingle_hashes(text, known)
            if len(s):
                digest = xxhash.xxh128_digest(s.tobytes())
                h1, h2 = np.frombuffer(digest, np.int64)
                rows.append((doc_id, len(s), int(h1), int(h2), registers(s, buckets).tobytes()))
            else:
                rows.append((doc_id, 0, 0, 0, None))
        out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "h1", "h2", "regs"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def _collisions(n_a: np.ndarray, n_b: np.ndarray, buckets: int) -> np.ndarray:
    """Chance that the registers of one bucket agree though its two smallest
    shingles differ: over each count of leading zeros, the chance that both
    minima fall into one mantissa cell."""
    la, lb = n_a / buckets, n_b / buckets
    both = la + lb
    total = np.zeros(len(la))
    for z in range(40):
        top = 2.0**-z
        cell = top / 2 / 2**MANTISSA
        total += cell * la * lb / both * (np.exp(-both * top / 2) - np.exp(-both * top))
    return total / np.maximum(1 - np.exp(-both), 1e-12)


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of rows of registers."""
    same = (regs_a == regs_b).mean(axis=1)
    chance = _collisions(n_a.astype(float), n_b.astype(float), regs_a.shape[1])
    return np.clip((same - chance) / (1 - chance), 0, 1)


def _likely(batches, percent: int, buckets: int):
    """Pairs whose estimate isn't clearly below the threshold."""
    level = percent / 100
    for pdf in batches:
        if len(pdf):
            a = np.frombuffer(b"".join(pdf["regs_a"]), np.uint16).reshape(-1, buckets)
            b = np.frombuffer(b"".join(pdf["regs_b"]), np.uint16).reshape(-1, buckets)
            n_a, n_b = pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy()
            filled = buckets * (1 - np.exp(-np.minimum(n_a, n_b) / buckets))
            low = level - MARGIN * np.sqrt(level * (1 - level) / np.maximum(filled, 1))
            pdf = pdf[estimate(a, b, n_a, n_b) >= low]
        yield pdf[["a", "b"]]


def _confirmed(batches, percent: int):
    """Pairs that reach the threshold on their full sets."""
    known: _WordHashes = _WordHashes()
    sets: dict = {}

    def of(text):
        if text not in sets:
            if len(sets) > 64:
                sets.clear()
            sets[text] = shingle_hashes(text, known)
        return sets[text]

    for pdf in batches:
        keep = []
        for ta, tb in zip(pdf["text_a"], pdf["text_b"], strict=True):
            x, y = of(ta), of(tb)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(len(x) > 0 and 100 * common >= percent * (len(x) + len(y) - common))
        yield pdf.loc[np.array(keep, bool), ["a", "b"]]


def _shingles(batches):
    """Shingles of documents; a version is a text of an id."""
    known = _WordHashes()
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            s = shingle_hashes(text, known)
            version = xxhash.xxh64_intdigest(s.tobytes()) >> 1
            for part in np.split(s.view(np.int64), range(10_000, len(s), 10_000)):
                yield pd.DataFrame({"doc_id": doc_id, "version": version, "n": len(s), "s": part})


def _band(regs: str, i: Column, rows: int) -> Column:
    """The registers of band ``i``."""
    return F.substring(F.col(regs), i * (2 * rows) + 1, F.lit(2 * rows))


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the given distinct ids."""
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids.hint("shuffle_hash"), "doc_id", "left_semi")


def _prefixes(docs: DataFrame, ids: DataFrame, percent: int) -> DataFrame:
    """``doc_id, version, n, s, r``: the rarest shingles of the documents
    ``ids`` that others of them hold too. ``r`` is the number of a document's
    shingles from this one to the commonest, so two documents whose first
    common shingle it is have at most the smaller ``r`` in common. Shingles
    with too small an ``r`` for any link are left out."""
    rows = _texts_of(docs, ids).mapInPandas(_shingles, "doc_id long, version long, n long, s long")
    rows = materialise(rows, "shingles")
    held = rows.groupBy("s").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    # equal rows of a document get equal ranks
    order = Window.partitionBy("doc_id", "version").orderBy(F.desc("held"), F.desc("s"))
    ranked = rows.join(held, "s").select("doc_id", "version", "n", "s", F.dense_rank().over(order).cast("long").alias("r"))
    return materialise(ranked.where(F.col("r") * 100 >= F.col("n") * percent), "prefixes")


def _reaches(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether so many common shingles make a link."""
    return common * (100 + percent) >= (n_a + n_b) * percent


def _meeting(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of documents of different components ``c`` that meet at
    a shingle of their prefixes. The smaller document of a link holds it in
    the part of its prefix that is long enough for one of its own size."""
    inner = _reaches(F.col("r"), F.col("n"), F.col("n"), percent)
    rows = prefixes.select("*", inner.alias("inner"))
    parts = rows.groupBy("s", "c").agg(F.count(F.lit(1)).alias("held"), F.max("inner").alias("inner"))
    shared = parts.groupBy("s").agg(
        F.max_by("c", F.struct("held", "c")).alias("major"),
        F.count(F.lit(1)).alias("parts"),
        F.sum("held").alias("held"),
        F.max("inner").alias("any_inner"),
    )
    shared = shared.where("parts > 1 and any_inner").select("s", "major", F.ceil(F.col("held") / HOLDERS).cast("int").alias("deals"))
    rows = materialise(rows.join(shared, "s"), "holders")
    dealt = F.pmod(F.xxhash64("doc_id"), F.col("deals")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("deals") - 1))

    def side(x: str, where: str, deal: Column) -> DataFrame:
        cols = [F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "n", "r", "c")]
        return rows.where(where).select("s", deal.alias("deal"), *cols)

    possible = (F.col("c_u") != F.col("c_v")) & (F.col("n_u") <= F.col("n_v"))
    possible &= _reaches(F.least("r_u", "r_v"), F.col("n_u"), F.col("n_v"), percent)
    minor = side("u", "inner and c <> major", every).join(side("v", "true", dealt), ["s", "deal"]).where(possible)
    major = side("u", "inner and c = major", dealt).join(side("v", "c <> major", every), ["s", "deal"]).where(possible)
    pair = [F.least("doc_id_u", "doc_id_v").alias("a"), F.greatest("doc_id_u", "doc_id_v").alias("b")]
    return minor.select(*pair).unionByName(major.select(*pair)).distinct()


def _with_registers(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of sizes that allow a link, with both registers."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    )


def _links(near: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are links, from pairs with registers; texts
    are read for ids in likely pairs only."""
    bands, rows = shape_of(percent)
    may = functools.partial(_likely, percent=percent, buckets=bands * rows)
    likely = materialise(near.mapInPandas(may, "a long, b long").distinct(), "pairs")
    ids = likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = _texts_of(docs, ids)
    text = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    full = likely.join(text("a"), "a").join(text("b"), "b")
    return materialise(full.mapInPandas(functools.partial(_confirmed, percent=percent), "a long, b long").distinct(), "links")


def _mixed(grouped: DataFrame, found: DataFrame) -> DataFrame:
    """Members of groups that hold several components ``c``."""
    labelled = grouped.join(found, grouped.doc_id == found.node, "left").select(
        "key", "a", "doc_id", F.coalesce("component", "doc_id").alias("c")
    )
    keys = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    return labelled.join(keys, "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id,
    kept``. Documents of a similarity of at least ``percent`` are linked.
    Extra columns of ``docs`` are not read."""
    spark = docs.sparkSession
    n_bands, n_rows = shape_of(percent)
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketched = materialise(docs.mapInPandas(functools.partial(_sketches, buckets=n_bands * n_rows), _SKETCH_SCHEMA), "sketches")
    full = sketched.where("n_shingles > 0 and doc_id is not null")
    # written before it is joined, so that a hot group of copies can be split
    smallest = materialise(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "copies")
    member = full.select("doc_id", "h1", "h2").join(smallest, ["h1", "h2"]).select("doc_id", "rep")
    sets = materialise(
        full.join(smallest, ["h1", "h2"]).where("doc_id = rep").select("doc_id", "n_shingles", "regs").distinct(), "sets"
    )

    keys = F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda i: F.xxhash64(i, _band("regs", i, n_rows)))
    bands = sets.select("doc_id", F.posexplode(keys).alias("band", "key"))
    centres = bands.groupBy("key").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    grouped = materialise(bands.join(centres, "key").select("key", "band", "a", "doc_id"), "groups")
    stars = grouped.where((F.col("a") != F.col("doc_id")) & (F.col("band") < FIRST_BANDS)).select("a", F.col("doc_id").alias("b")).distinct()
    stars = materialise(stars, "stars")
    links = _links(_with_registers(stars, sets, percent), docs, percent)
    mixed = materialise(_mixed(grouped, components(links)), "mixed")
    prefixes = _prefixes(docs, materialise(mixed.select("doc_id").distinct(), "crowd"), percent)
    bound = materialise(prefixes.groupBy("doc_id").agg(F.max("r").alias("r"), F.min("n").alias("n")), "bounds")
    able = mixed.join(bound, "doc_id")
    # the centre is the member with the fewest shingles of its own
    typical = F.struct(F.col("r") / F.col("n"), -F.col("doc_id"))
    centre = able.groupBy("key").agg(F.max_by(F.struct("doc_id", "c", "r", "n"), typical).alias("centre"))
    more = able.join(centre, "key").where("c <> centre.c")
    more = more.where(_reaches(F.least("r", "centre.r"), F.col("n"), F.col("centre.n"), percent))
    more = more.select(F.least("doc_id", "centre.doc_id").alias("a"), F.greatest("doc_id", "centre.doc_id").alias("b")).distinct()
    more = materialise(more.select("a", "b").join(stars, ["a", "b"], "left_anti"), "stars")  # no pair is compared twice
    links = links.unionByName(_links(_with_registers(more, sets, percent), docs, percent))

    left = materialise(_mixed(mixed.drop("c"), components(links)).select("doc_id", "c").distinct(), "left")
    rest = _meeting(prefixes.join(left, "doc_id"), percent).join(stars.unionByName(more), ["a", "b"], "left_anti")
    rest = materialise(rest, "rest")
    whole = components(links.unionByName(_links(_with_registers(rest, sets, percent), docs, percent)))

    cls = member.join(whole, member.rep == whole.node, "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component_id")
    )
    # an id with versions of different texts lies in the smallest component of any
    cls = cls.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return sketched.select("doc_id", "n_shingles").join(cls, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def _own_nodes(docs: DataFrame, unique: DataFrame) -> DataFrame:
    """One row for each id and text of ``docs``, with a ``_node`` that is no
    id of ``unique``, in the order of the ids (null last)."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = docs.groupBy("doc_id", "text").agg(F.first(F.struct(F.lit(1).alias("_one"), *rest)).alias("_rest"))
    one = materialise(one.withColumns({"_no_id": F.col("doc_id").isNull(), "_id": F.col("doc_id").cast("long")}), "repeated")
    n = one.count()
    ends = unique.agg(F.min(F.col("doc_id").cast("long")).alias("lo"), F.max(F.col("doc_id").cast("long")).alias("hi")).first()
    free = (ends["hi"] or 0) + 1
    if free + n >= 2**63:
        free = ends["lo"] - n
    named = reindex(one, ["_no_id", "_id", "text"], "_node", start=free)
    cols = [F.col(c) if c in ("doc_id", "text") else F.col(f"_rest.{c}").alias(c) for c in docs.columns]
    return materialise(named.select("_node", "_no_id", "_id", *cols), "repeated")


def keep_one_of_each(docs: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row of each group of ``docs``: the first by id (null last), and one
    only of rows with equal ids; columns unchanged. Rows that share an id but
    not a text, and rows without an id, are documents of their own here. Rows
    without an id and without words are no copies of anything; they stay."""
    columns = docs.columns
    docs = docs.select("*", (F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^ \t-\r]")).alias("_bare"))
    bare = docs.where("_bare").select(*columns)
    docs = docs.where("not _bare").select(*columns)
    ids = docs.where("doc_id is not null")
    often = materialise(ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_often")), "often")
    on = ids["doc_id"] == often["_often"]
    unique = ids.join(often, on, "left_anti")
    nodes = _own_nodes(ids.join(often, on, "left_semi").unionByName(docs.where("doc_id is null")), unique)
    if nodes.isEmpty():
        dropped = near_duplicates(ids, percent=percent).where("not kept").select(F.col("doc_id").alias("_dropped"))
        return ids.join(dropped, ids["doc_id"] == dropped["_dropped"], "left_anti").unionByName(bare)
    every = unique.select(F.col("doc_id").cast("long").alias("doc_id"), "text").unionByName(nodes.select(F.col("_node").alias("doc_id"), "text"))
    found = near_duplicates(every, percent=percent).select(F.col("doc_id").alias("_node"), "component_id")
    found = found.join(nodes.select("_node", "_no_id", "_id"), "_node", "left")
    order = F.struct(F.coalesce("_no_id", F.lit(False)).alias("no_id"), F.coalesce("_id", "_node").alias("id"), F.col("_node").alias("node"))
    found = materialise(found.select("_node", "component_id", order.alias("_order")), "found")
    first = found.groupBy("component_id").agg(F.min("_order").alias("_first"))
    dropped = found.join(first, "component_id").where("_order <> _first").select(F.col("_node").alias("_dropped"))
    dropped = materialise(dropped, "dropped")
    out = unique.join(dropped, unique["doc_id"] == dropped["_dropped"], "left_anti")
    more = nodes.join(dropped, nodes["_node"] == dropped["_dropped"], "left_anti").select(*columns)
    return out.unionByName(more).unionByName(bare)
