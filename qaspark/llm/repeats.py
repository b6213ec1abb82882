"""Removal of long repeated byte strings (suffix-array dedup).

Every 100-byte window of a text is filed under an anchor: the 32-byte string
with the smallest hash among the 69 that it holds. Equal windows have equal
anchors, so a run of neighbouring windows with one anchor (a piece of 100 to
168 bytes) can be compared with the pieces of that anchor alone, and no
window is lost. Anchors seen once hold no repeats; they are left out by a
bitmap of bounded size, whose false alarms cost work but change nothing.

Equal pieces count as one, the first. The different pieces of an anchor go
to a Burrows-Wheeler transform of a bounded number of whole anchor groups.
Common prefixes come from it in breadth-first backward extension: a border
of length l lies between two rows of one first byte where the rows they
stand for one byte later are parted by a border of length below l. Borders
are found by increasing length, only rows not parted yet go on, and the
expansion stops at the least length of a match (100). Rows not parted then
start equal windows; all but the first are repeats.

Groups with more different pieces than a task may hold are dealt again by
longer anchors: the windows are halved by their place around the anchor, and
the bytes that all windows of a half share are the new anchor, until a group
is small enough or the anchor is the whole window.

Defined cases: null texts are empty; texts under 100 bytes lose nothing; null
ids come after all others; rows with one id and different texts are ordered
by a hash of the text; equal rows (id and text) are one document and get
equal results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.llm.common import materialise, prepare

LENGTH = 100
ANCHOR = 32
WINDOW = LENGTH - ANCHOR + 1  # anchors in a window of LENGTH bytes
# Bytes that are hashed at once. Hashing takes some 45 times that memory, in
# each of an executor's Python workers.
UNIT = 1 << 18
# Different pieces of one anchor that one transform may hold.
GROUP_PIECES = 8192
# Pieces from which a transform takes no further group.
HELD_PIECES = 1024
# Bits of the bitmaps of repeated anchors: the input's size in bytes over 4,
# within these powers of two (16 to 128 MB at most for each of the two).
BITMAP_POWERS = (22, 30)
_BITMAP_BITS = 32768  # of one row of bitmap_construct_agg
# Prefixes are sorted to this length, over LENGTH: ties beyond it don't matter.
_SORTED = 128

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_ODD = [_U(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0x9FB21C651E98DF25, 0xA0761D6478BD642F)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def pieces(buf: np.ndarray, ends: np.ndarray):
    """``start, windows, anchor place, anchor, digest`` of the pieces of a
    buffer that holds whole texts up to ``ends``. A buffer over ``UNIT`` is
    cut between windows; a cut parts a piece in two and loses no window."""
    found = [_pieces_of(buf[at : at + UNIT + LENGTH - 1], ends - at, at) for at in range(0, len(buf) - LENGTH + 1, UNIT)]
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, _U, _U))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _pieces_of(buf: np.ndarray, ends: np.ndarray, at: int):
    n_windows = len(buf) - LENGTH + 1
    h = buf.astype(_U) + _U(1)
    step, power = 1, _BASE
    while step < ANCHOR:
        h = h[:-step] * _U(power) + h[step:]
        step, power = 2 * step, power * power % 2**64
    h = _mix(h)
    low = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=_U)
    step = 1
    while 2 * step <= WINDOW:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if WINDOW > step:
        low = np.minimum(low[: step - WINDOW], low[WINDOW - step :])
    place = (low & _U(0xFFFFFFFF)).astype(np.int64)
    # windows that run over the end of a text
    over = np.zeros(n_windows + 1, np.int32)
    inner = ends[(ends > 0) & (ends < len(buf))]
    np.add.at(over, np.clip(inner - LENGTH + 1, 0, n_windows), 1)
    np.add.at(over, np.clip(inner, 0, n_windows), -1)
    valid = np.cumsum(over[:-1]) == 0
    before = np.concatenate(([False], valid[:-1]))
    turn = np.concatenate(([True], place[1:] != place[:-1]))
    opens = valid & (turn | ~before)
    cuts = np.append(np.flatnonzero(opens | (before & ~valid)), n_windows)
    start = np.flatnonzero(opens)
    n = cuts[np.searchsorted(cuts, start) + 1] - start
    last = start + n + LENGTH - 1 - ANCHOR
    parts = (start, start + 32, start + 64, np.minimum(start + 96, last), np.minimum(start + 128, last), last)
    digest = _mix(sum((h[p] * o for p, o in zip(parts, _ODD, strict=True)), n.astype(_U)))
    return start + at, n, place[start] + at, h[place[start]], digest


def text_units(texts: pa.BinaryArray):
    """First row, buffer and ends of runs of texts of up to ``UNIT`` bytes,
    longer texts by themselves."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(at, at[row] + UNIT, "right")) - 1)
        yield row, data[at[row] : at[to]], at[row + 1 : to + 1] - at[row]
        row = to


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(batches):
    for batch in batches:
        for _, buf, ends in text_units(batch.column("text")):
            _, _, _, key, digest = pieces(buf, ends)
            yield pa.record_batch([_signed(key), _signed(digest)], ["key", "digest"])


def _has(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    bit = key & _U(8 * len(bitmap) - 1)
    return (bitmap[bit >> _U(3)] >> (bit & _U(7)).astype(np.uint8)) & 1 == 1


def _candidates(batches, maps):
    """Pieces of repeated anchors, with their bytes if there are different
    pieces of the anchor."""
    repeated, mixed = (np.frombuffer(x, np.uint8) for x in maps.value)
    for batch in batches:
        ids, hashes = batch.column("doc_id"), batch.column("h")
        for row, buf, ends in text_units(batch.column("text")):
            start, n, place, key, _ = pieces(buf, ends)
            keep = _has(repeated, key)
            start, n, place, key = (x[keep] for x in (start, n, place, key))
            raw = buf.tobytes()
            text = [raw[s : s + k + LENGTH - 1] if m else None for s, k, m in zip(start.tolist(), n.tolist(), _has(mixed, key).tolist(), strict=True)]
            of = np.searchsorted(ends, start, "right")
            begins = np.concatenate(([0], ends[:-1]))[of] if len(of) else of
            rows = pa.array(of + row)
            yield pa.record_batch(
                [_signed(key), pa.array(text, pa.binary()), ids.take(rows), hashes.take(rows), pa.array(start - begins), pa.array(n), pa.array(place - start)],
                ["key", "text", "doc_id", "h", "start", "n", "off"],
            )


def equal_prefix_rows(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``symbols`` (uint16, every text closed by a symbol of
    its own) and, for each row, whether it shares less than ``length``
    symbols with the row before: breadth-first over the transform. Places
    are 32 bits wide, wide temporaries go as soon as they are used."""
    n = len(symbols)
    order = _suffix_order(symbols)
    bwt = symbols[order - 1]
    later = np.argsort(bwt, kind="stable").astype(np.int32)  # row of the suffix one symbol on
    first = bwt[later]
    parted = np.empty(n, bool)
    parted[0] = True
    parted[1:] = first[1:] != first[:-1]  # common prefixes of length 0
    del bwt, first
    open_rows = np.flatnonzero(~parted).astype(np.int32)
    for _ in range(1, length):
        interval = np.cumsum(parted, dtype=np.int32)
        now = interval[later[open_rows]] != interval[later[open_rows - 1]]
        if not now.any():
            break
        parted[open_rows[now]] = True
        open_rows = open_rows[~now]
    return order, parted


def _heads(head: np.ndarray) -> np.ndarray:
    """For each row, the last row up to it that is a head."""
    rows = np.arange(len(head), dtype=np.int32)
    rows[~head] = 0
    return np.maximum.accumulate(rows, out=rows)


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions ordered by their first ``_SORTED`` symbols (prefix doubling
    from four packed symbols, only on ranks that several positions share)."""
    n = len(symbols)
    packed = np.zeros(n, _U)
    for k in range(4):
        packed[: n - k] |= symbols[k:].astype(_U) << _U(48 - 16 * k)
    order = np.argsort(packed, kind="stable").astype(np.int32)
    packed = packed[order]
    head = np.concatenate(([True], packed[1:] != packed[:-1]))
    del packed
    rank = np.zeros(n + _SORTED, np.int32)
    rank[order] = _heads(head)
    step = 4
    while step < _SORTED:
        shared = np.flatnonzero(~(head & np.append(head[1:], True))).astype(np.int32)
        if not len(shared):
            break
        at = order[shared]
        key = rank[at].astype(np.int64) * (n + 1) + rank[at + np.int32(step)]
        by = np.argsort(key, kind="stable")
        order[shared] = at = at[by]
        key = key[by]
        del by
        head[shared] = np.concatenate(([True], key[1:] != key[:-1]))
        del key
        rank[at] = _heads(head)[shared]
        step *= 2
    return order


def first_windows(texts: list[bytes], age: np.ndarray) -> list[np.ndarray]:
    """For each text, which of its windows no older text holds (``age``: a
    place of its own for each text, smaller is older). A text holds no
    window twice."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)  # after the closing symbol
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + np.uint16(len(texts))
    symbols[ends - 1] = np.arange(len(texts))
    order, parted = equal_prefix_rows(symbols, LENGTH)
    own = age.astype(np.int32)[np.searchsorted(ends, order, "right").astype(np.int32)]
    oldest = np.minimum.reduceat(own, np.flatnonzero(parted))
    first = np.empty(len(symbols), bool)
    first[order] = own == oldest[np.cumsum(parted, dtype=np.int32) - 1]
    begins = ends - sizes - 1
    return [first[b : b + s - LENGTH + 1] for b, s in zip(begins.tolist(), sizes.tolist(), strict=True)]


def _runs(mask: np.ndarray):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2] - edges[::2]


def _transforms(batches):
    """Windows that come first, as runs, from rows ordered by anchor:
    transforms of whole groups, of ``HELD_PIECES`` pieces together or of one
    larger group."""
    held: list = []

    def done(rows):
        if len(rows) == 1:
            firsts = [np.ones(len(rows[0][1]) - LENGTH + 1, bool)]
        else:
            age = np.empty(len(rows), np.int64)
            age[sorted(range(len(rows)), key=lambda i: rows[i][2:])] = np.arange(len(rows))
            firsts = first_windows([r[1] for r in rows], age)
        out = []
        for row, first in zip(rows, firsts, strict=True):
            begin, n = _runs(first)
            out += [(row[3] if not row[2] else None, row[4], row[5] + b, k) for b, k in zip(begin.tolist(), n.tolist(), strict=True)]
        cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols], ["doc_id", "h", "start", "n"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("key", "text", "doc_id", "h", "start")]
        for key, text, doc_id, h, start in zip(*cols, strict=True):
            if len(held) >= HELD_PIECES and key != held[-1][0]:
                yield done(held)
                held = []
            held.append((key, text, doc_id is None, doc_id or 0, h, start))
    if held:
        yield done(held)


def _longer_anchors(batches):
    """Both halves of each piece's windows by their place around the anchor,
    keyed by the bytes that all windows of a half share."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            middle = (r["lo"] + r["hi"]) // 2
            for lo, hi in ((r["lo"], middle), (middle + 1, r["hi"])):
                a, b = max(r["off"] - hi, 0), min(r["off"] - lo, r["n"] - 1)
                if a <= b:
                    shared = r["text"][r["off"] - lo : r["off"] - hi + LENGTH]
                    key = xxhash.xxh3_64_intdigest(b"%d,%d,%d:" % (r["key"], lo, hi) + shared) - 2**63
                    out.append({**r, "key": key, "text": r["text"][a : b + LENGTH], "start": r["start"] + a, "n": b - a + 1, "off": r["off"] - a, "lo": lo, "hi": hi})
        yield pa.RecordBatch.from_pylist(out, schema=batch.schema)


def _oldest(rows: DataFrame, *more: str) -> DataFrame:
    """One row for each anchor and text, the first in the corpus."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "start")).alias("o")
    out = rows.groupBy("key", "text").agg(first, *[F.max(c).alias(c) for c in more])
    return out.select("key", "text", "o.doc_id", "o.h", "o.start", *more)


def _small_groups(rows: DataFrame, group_pieces: int) -> DataFrame:
    """``rows`` with crowded anchors replaced by longer ones."""
    done, step = [], 0
    rows = rows.withColumns({"lo": F.lit(0), "hi": F.lit(WINDOW - 1)})
    while True:
        crowded = materialise(rows.groupBy("key").count().where(F.col("count") > group_pieces).select("key"), "crowded-anchors")
        if crowded.isEmpty():
            break
        done.append(rows.join(crowded, "key", "left_anti"))
        dealt = rows.join(crowded, "key", "left_semi").mapInArrow(_longer_anchors, rows.schema)
        rows = materialise(_oldest(dealt, "n", "off", "lo", "hi").select(rows.columns), f"anchors-{step}")
        step += 1
    for part in done:
        rows = rows.unionByName(part)
    return rows


def _removed(batches, maps):
    """Results of documents with their windows that come first."""
    repeated = np.frombuffer(maps.value[0], np.uint8)
    for batch in batches:
        firsts, out = batch.column("firsts"), []
        for row, buf, ends in text_units(batch.column("text")):
            start, n, _, key, _ = pieces(buf, ends)
            keep = _has(repeated, key)
            begins = np.concatenate(([0], ends[:-1]))
            change = np.zeros(len(buf) + 1, np.int32)  # windows of repeated anchors that don't come first
            np.add.at(change, start[keep], 1)
            np.add.at(change, start[keep] + n[keep], -1)
            for i, begin in enumerate(begins.tolist()):
                own = firsts[row + i]
                if own.is_valid and len(own):
                    own = own.values
                    s, k = own.field("start").to_numpy() + begin, own.field("n").to_numpy()
                    np.add.at(change, s, -1)
                    np.add.at(change, s + k, 1)
            at = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            cover = np.zeros(len(buf) + LENGTH, np.int32)
            cover[at] += 1
            cover[at + LENGTH] -= 1
            gone = np.cumsum(cover[: len(buf)]) > 0
            for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
                own = gone[begin:end]
                n_gone = int(own.sum())
                kept = buf[begin:end][~own] if n_gone else buf[begin:end]
                out.append((end - begin, n_gone, len(_runs(own)[0]) if n_gone else 0, hashlib.sha256(kept.tobytes()).hexdigest()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _bitmaps(docs: DataFrame) -> list[bytes]:
    """Bitmaps of the anchors seen more than once, and of those of them with
    different pieces."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    power = min(max(int(size / 4).bit_length(), BITMAP_POWERS[0]), BITMAP_POWERS[1])
    seen = docs.mapInArrow(_anchors, "key long, digest long").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    bit = F.col("key").bitwiseAND(2**power - 1)
    again = seen.where("n > 1").select(
        F.shiftright(bit, 15).alias("bucket"), bit.bitwiseAND(_BITMAP_BITS - 1).alias("bit"), (F.col("low") != F.col("high")).alias("mixed"))
    rows = again.groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("repeated"), F.bitmap_construct_agg(F.when(F.col("mixed"), F.col("bit"))).alias("mixed"))
    maps = [np.zeros(2**power // 8, np.uint8) for _ in range(2)]
    for r in rows.toLocalIterator():
        for m, name in zip(maps, ("repeated", "mixed"), strict=True):
            m[r["bucket"] * 4096 : (r["bucket"] + 1) * 4096] = np.frombuffer(r[name], np.uint8)
    return [m.tobytes() for m in maps]


def remove_repeats(docs: DataFrame, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of
    ``docs``: bytes covered by a string of ``LENGTH`` bytes that starts
    earlier too (in a smaller id, or earlier in the same text) are removed,
    all strings judged on the input."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit("")).cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
    maps = spark.sparkContext.broadcast(_bitmaps(own.select("text")))
    found = own.mapInArrow(lambda b: _candidates(b, maps), "key long, text binary, doc_id long, h long, start long, n long, off long")
    found = materialise(_oldest(found, "n", "off"), "repeat-pieces")
    alone = found.where("text is null").select("doc_id", "h", "start", "n")
    groups = _small_groups(found.where("text is not null"), group_pieces).select("key", "text", "doc_id", "h", "start")
    groups = groups.repartition("key").sortWithinPartitions("key")
    firsts = alone.unionByName(groups.mapInArrow(_transforms, "doc_id long, h long, start long, n long"))
    firsts = firsts.groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "n")).alias("firsts"))
    firsts = firsts.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    joined = own.join(firsts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    return joined.select("doc_id", "text", "firsts").mapInArrow(
        lambda b: _removed(b, maps), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


# Windows as hex text, cut from blocks of 500 starts; the first of each window
# stays, a byte goes if a repeat starts at it or up to 99 bytes before.
REPEATS_SQL = """with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as hx, strlen(coalesce(text, '')) as nb from documents),
s as (select doc_id, hx, nb, unnest(range(0, nb, 500)) as p from d),
p as (select doc_id, nb, p, substr(hx, 2 * p + 1, 1198) as part from s),
j as (select doc_id, nb, p, part, unnest(range(500)) as j from p),
b as (select doc_id, nb, p + j as i, substr(part, 2 * j + 1, 2) as x, substr(part, 2 * j + 1, 200) as g from j where p + j < nb),
w as (select *, i <= nb - 100 and row_number() over (partition by g order by doc_id, i) > 1 as again from b),
c as (select doc_id, i, x, coalesce(max(case when again then i end)
        over (partition by doc_id order by i range between 99 preceding and current row), -1) >= 0 as gone from w),
e as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as opens from c),
g as (select doc_id, count(*) filter (gone) as n_removed, count(*) filter (opens) as n_spans,
             string_agg(x, '' order by i) filter (not gone) as kept from e group by doc_id)
select d.doc_id, cast(nb as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, ''))) as kept_sha256 from d left join g on g.doc_id = d.doc_id"""
