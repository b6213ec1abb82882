"""Importance resampling towards a target distribution.

Features are the words of a text and its pairs of neighbouring words, counted
with repeats in hashed buckets. A bucket's gain is the logarithm of its share
in the target over its share in the corpus, as an array that every task gets
(its size is fixed); a document's weight is the mean gain of its features. A
document is drawn if weight plus its own Gumbel noise is among the highest.

Exact ranks come from sorting by regular sampling: every partition sorts its
own run and gives each ``step``-th row as a regular sample; the samples, a
fixed number for each partition of the shuffle, give splitters; rows are
exchanged by segment and sorted there, and the counts of the segments before
give each segment's first rank. Segments that lie behind the last drawn rank
aren't sorted at all.

Defined cases: null texts have no features (weight 0) and no words; equal
scores go to the smaller id, null ids last (their noise is that of the text
``7:null``), rows with one id in the order of the scored table; equal rows
get equal scores and ranks of their own; empty tables give no rows, and an
empty target gives gains against no counts; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaspark.llm.common import materialise, prepare
from qaspark.llm.repeats import text_units

BUCKETS = 10_000
SEED = 7
DRAWN_PERCENT = 25
LEAST_WORDS = 20
# Regular samples for each partition of the exchange, and so the bound of
# what goes to the driver: as many times spark.sql.shuffle.partitions.
SAMPLES = 32

# Words up to this length are hashed in numpy, longer ones one by one.
_SHORT = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@functools.cache
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of each byte, and for each length the four byte tables that
    carry a checksum over so many more bytes."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1).astype(np.uint32)
    now = (np.arange(256, dtype=np.uint32)[None, :] << np.array([0, 8, 16, 24], np.uint32)[:, None]).astype(np.uint32)
    carry = [now]
    for _ in range(_SHORT):
        now = crc[now & 255] ^ (now >> 8)
        carry.append(now)
    return crc, np.stack(carry)


def _words(buf: np.ndarray, ends: np.ndarray):
    """Lower-cased bytes, and starts, lengths and texts of their words."""
    low = _LOWER[buf]
    inside = _IN_WORD[low]
    edge = ends[ends < len(buf)]
    before = np.concatenate(([False], inside[:-1]))[: len(buf)]
    before[edge] = False
    after = np.concatenate((inside[1:], [False]))[: len(buf)]
    after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return low, start, np.flatnonzero(inside & ~after) + 1 - start, np.searchsorted(ends, start, "right")


def _word_crcs(low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    table, _ = _crc_tables()
    order = np.argsort(-np.minimum(size, _SHORT + 1).astype(np.int16), kind="stable")
    s, n = start[order], size[order]
    crc = np.full(len(s), 0xFFFFFFFF, np.uint32)
    longer = np.searchsorted(-n, -_SHORT, "left")  # of more than _SHORT bytes
    for p in range(int(n[longer]) if longer < len(n) else 0):
        to = np.searchsorted(-n, -p, "left")
        c = crc[longer:to]
        crc[longer:to] = table[(c ^ low[s[longer:to] + p]) & 255] ^ (c >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(longer):
        crc[i] = zlib.crc32(low[s[i] : s[i] + n[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _carried(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    _, carry = _crc_tables()
    return carry[size, 0, crc & 255] ^ carry[size, 1, (crc >> 8) & 255] ^ carry[size, 2, (crc >> 16) & 255] ^ carry[size, 3, crc >> 24]


def features(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature of a buffer of whole texts, and the
    number of words of each text."""
    low, start, size, of = _words(buf, ends)
    crc = _word_crcs(low, start, size)
    pair = np.flatnonzero(of[1:] == of[:-1])
    spaced = _carried(crc[pair], np.ones(len(pair), np.int64)) ^ np.uint32(zlib.crc32(b" "))
    n = size[pair + 1]
    both = _carried(spaced, np.minimum(n, _SHORT)) ^ crc[pair + 1]
    for i in np.flatnonzero(n > _SHORT).tolist():
        at = start[pair[i] + 1]
        both[i] = zlib.crc32(low[at : at + n[i]].tobytes(), int(spaced[i]))
    bucket = np.concatenate((crc, both)) % np.uint32(BUCKETS)
    return np.concatenate((of, of[pair])), bucket.astype(np.int64), np.bincount(of, minlength=len(ends))


def _counts(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, buf, ends in text_units(batch.column("text")):
            total += np.bincount(features(buf, ends)[1], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "n"])


def _text(df: DataFrame):
    return F.coalesce(F.col("text"), F.lit("")).cast("string").cast("binary").alias("text")


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket (``BUCKETS`` rows reach the driver)."""
    rows = texts.select(_text(texts)).mapInArrow(_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln(...))`` of smoothed target over corpus shares."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{SEED}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(batches, gain):
    worth = np.frombuffer(gain.value, np.int64)
    for batch in batches:
        n_words, n_features, weight = [], [], []
        for _, buf, ends in text_units(batch.column("text")):
            of, bucket, words = features(buf, ends)
            n = np.bincount(of, minlength=len(ends))
            total = np.bincount(of, worth[bucket], len(ends)).astype(np.int64)
            n_words.append(words)
            n_features.append(n)
            weight.append(np.where(n > 0, total // np.maximum(n, 1), 0))
        if n_words:
            n_words, n_features, weight = (np.concatenate(x) for x in (n_words, n_features, weight))
            score = weight + np.array([noise(i) for i in batch.column("doc_id").to_pylist()], np.int64)
            cols = [pa.array(x.astype(np.int64)) for x in (n_words, n_features, weight, score)]
            yield pa.record_batch([batch.column("doc_id"), *cols], ["doc_id", "n_words", "n_features", "weight", "score"])


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    spark = docs.sparkSession
    prepare(spark)
    gain = spark.sparkContext.broadcast(gains(bucket_counts(docs), bucket_counts(target)).tobytes())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text(docs))
    return rows.mapInArrow(lambda b: _scores(b, gain), "doc_id long, n_words long, n_features long, weight long, score long")


def _key(row) -> tuple:
    """Place in the order of ranks: high scores, small ids, null ids last."""
    return -row["score"], row["doc_id"] is None, row["doc_id"] or 0, row["at"]


def _segments(batches, splitters):
    """Number of each row's segment: how many splitters lie at or before it."""
    keys = splitters.value
    low = np.array([k[0] for k in keys], np.int64)
    for batch in batches:
        down = -batch.column("score").to_numpy()
        segment = np.searchsorted(low, down, "left")
        for i in np.flatnonzero(segment != np.searchsorted(low, down, "right")).tolist():  # equal to a splitter's score
            row = {c: batch.column(c)[i].as_py() for c in ("score", "doc_id", "at")}
            segment[i] = bisect_left(keys, _key(row))
        yield batch.append_column("segment", pa.array(segment.astype(np.int64)))


def ranked(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` (``doc_id, score, at`` and others; ``at`` has no value twice)
    with ``rank`` from 1 by ``_key``, null beyond ``count``."""
    spark = rows.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("at")]
    n_segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    step = max(1, rows.count() // (n_segments * SAMPLES))
    place = F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
    runs = rows.select("score", "doc_id", "at").sortWithinPartitions(*order).withColumn("place", place)
    samples = sorted(_key(r) for r in runs.where(F.col("place") % step == step - 1).select("score", "doc_id", "at").toLocalIterator())
    keys = [samples[i * len(samples) // n_segments] for i in range(1, n_segments)] if len(samples) >= n_segments else samples
    splitters = spark.sparkContext.broadcast(keys)
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", segment long"
    dealt = materialise(rows.mapInArrow(lambda b: _segments(b, splitters), schema), "segments")
    sizes = dealt.groupBy("segment").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = F.broadcast(sizes.select("segment", before.alias("before")))  # a row for each segment
    dealt = dealt.join(firsts, "segment")
    inside = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    near = dealt.where(F.col("before") < count).withColumn("rank", (F.col("before") + inside).cast("long"))
    near = near.withColumn("rank", F.when(F.col("rank") <= count, F.col("rank")))
    far = dealt.where(F.col("before") >= count).withColumn("rank", F.lit(None).cast("long"))
    return near.unionByName(far).drop("segment", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``;
    of those with ``least_words``, ``percent`` % are drawn."""
    scored = materialise(score(docs, target).withColumn("at", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = ranked(able, percent * able.count() // 100)
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 from a table that follows from its polynomial, once for each
# different feature.
RESAMPLE_SQL = """with recursive crc0(i, k, v) as (
  select i, 0, i from range(256) r(i)
  union all select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from crc0 where k < 8),
crc as (select list(v order by i) as t from crc0 where k = 8),
texts as (select true as own, doc_id, text from documents union all select false, null, text from benchmark),
w as (select own, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from texts),
f as (select own, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from w),
n as (select own, doc_id, f, count(*) as n from f group by all),
u as (select f, hex(encode(f)) as hx from (select distinct f from n)),
h as (select f, xor(list_reduce(list_transform(range(0, len(hx) // 2), lambda i: cast('0x' || substr(hx, 2 * i + 1, 2) as bigint)),
        lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as int) + 1]), 4294967295), 4294967295) % 10000 as bucket from u, crc),
b as (select own, doc_id, bucket, sum(n) as n from n join h using (f) group by all),
st as (select bucket, sum(case when own then n else 0 end) as s, sum(case when own then 0 else n end) as t from b group by bucket),
g as (select bucket, floor(1000 * ln((t + 1)::double * ((select sum(s) from st) + 10000)::double
        / ((s + 1)::double * ((select sum(t) from st) + 10000)::double)))::bigint as gain from st),
wt as (select doc_id, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n)::double)::bigint as weight
       from b join g using (bucket) where own group by doc_id),
sc as (select w.doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || coalesce(w.doc_id::varchar, 'null')), 1, 8) as bigint) + 0.5::double)
         / 4294967296::double)))::bigint as score from w left join wt on wt.doc_id = w.doc_id where own),
r as (select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from sc where n_words >= 20)
select sc.doc_id, n_features, weight, score, case when r <= 25 * n // 100 then r end as rank from sc left join r using (doc_id)"""
