"""Byte-level BPE encoding and decoding by a distinct-word table.

Tasks split texts into words with the tokenizer's pattern and count them by
block (a run of documents of bounded size). A document becomes the codes of
its words, by position, in its block's word list (ranks by frequency, so that
they press well); only these codes and the lists are shuffled, never texts.
The lists of all blocks are brought together by word hash, each distinct word
is encoded once, and its ids go back to the blocks that hold it, where they
are put in the words' positions. Ids are decoded through the vocabulary's
table from id to piece, which is as large as the vocabulary and is broadcast.

Blocks are cut while the table is read, so both passes over the texts must
see the same rows in the same order, as scans of files do; other inputs are
written to the shared folder first (``stored=False``). A block's name is a
fingerprint of its rows: if a pass saw others, its words would be missed and
the job would fail rather than return wrong ids.

Defined cases: null and empty texts have no ids and decode to an empty text;
the vocabulary's special tokens in a text become their ids; repeated rows get
equal rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.llm.common import materialise, prepare

BLOCK_CHARS = 6_000_000
# Fixed value: the split pattern of the tokenizer's byte-level step.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same over texts of a few kinds of characters only, which the standard
# library's faster expressions can tell apart.
_PLAIN = r"'(?:s|t|re|ve|m|ll|d)| ?[{0}]+| ?[0-9]+| ?[^\s0-9{0}]+|\s+(?!\S)|\s+"
_LATIN_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def _special(path: str) -> tuple[str, ...]:
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f)["added_tokens"])


class Splitter:
    """Texts into the words that the tokenizer encodes apart."""

    def __init__(self, special: tuple[str, ...]):
        # white space is the Unicode property, which leaves out \x1c-\x1f
        self._any = regex.compile(PATTERN.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self._ascii = re.compile(_PLAIN.format("A-Za-z")).findall
        self._latin = re.compile(_PLAIN.format(_LATIN_LETTERS)).findall
        self._odd = re.compile(f"[^\t-\r -~{_LATIN_LETTERS}]").search
        self._special = special
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def _find(self, text: str) -> list[str]:
        if self._odd(text):
            return self._any(text)
        return self._ascii(text) if text.isascii() else self._latin(text)

    def words(self, text: str) -> list[str]:
        if self._cut is None or not any(s in text for s in self._special):
            return self._find(text)
        out = []
        for part in self._cut.split(text):
            out += [part] if part in self._special else self._find(part)
        return out


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _pack(codes: np.ndarray, press) -> bytes:
    """Codes byte plane by byte plane, compressed."""
    return press.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(data: bytes, press) -> np.ndarray:
    planes = np.frombuffer(press.decompress(data), np.uint8).reshape(4, -1)
    return planes.T.copy().view("<u4").ravel().astype(np.int64)


class _Block:
    """Rows of one block; its name is a fingerprint of them, in order."""

    def __init__(self):
        self.ids, self.size, self._mark = [], 0, xxhash.xxh3_64()

    def add(self, doc_id, text: str) -> None:
        self.ids.append(doc_id)
        self.size += len(text)
        self._mark.update(f"{doc_id}\0{len(text)}\0".encode() + text.encode("utf-8", "surrogatepass"))

    def name(self) -> int:
        return int(np.uint64(self._mark.intdigest()).astype(np.int64))


def _ranks(counts: np.ndarray) -> np.ndarray:
    """Word numbers (by first appearance) in falling order of frequency."""
    return np.argsort(-counts, kind="stable")


def _texts(batches: Iterator[pd.DataFrame]):
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            yield doc_id, text or ""


def _words_of(special, buckets: int):
    """Word lists of blocks, dealt out by word hash: the words of a row are
    pressed together with their codes."""

    def rows(block: _Block, counts: Counter) -> pd.DataFrame:
        words = np.array([w.encode("utf-8", "surrogatepass") for w in counts], dtype=object)
        words = words[_ranks(np.fromiter(counts.values(), np.int64, len(counts)))]
        bucket = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        press, out = zstandard.ZstdCompressor(level=3), []
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(part):
                mine = words[part]
                lengths = np.array([len(w) for w in mine], "<u4")
                out.append((int(bucket[part[0]]), block.name(), _pack(part, press), _pack(lengths, press), press.compress(b"".join(mine))))
        return pd.DataFrame(out, columns=["bucket", "block", "codes", "lengths", "words"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, block, counts = Splitter(special).words, _Block(), Counter()
        for doc_id, text in _texts(batches):
            counts.update(split(text))
            block.add(doc_id, text)
            if block.size >= BLOCK_CHARS:
                yield rows(block, counts)
                block, counts = _Block(), Counter()
        if block.ids:
            yield rows(block, counts)

    return run


def _documents_of(special):
    """Documents as the codes of their words, by position."""

    def rows(block: _Block, known: dict, codes: list) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(known), np.int64)
        for c in codes:
            np.add.at(counts, c, 1)
        rank = np.empty(len(known), np.int64)
        rank[_ranks(counts)] = np.arange(len(known))
        press, name = zstandard.ZstdCompressor(level=3), block.name()
        for start in range(0, len(codes), 2_000):
            part = slice(start, start + 2_000)
            packed = [_pack(rank[c], press) for c in codes[part]]
            yield pd.DataFrame({"block": name, "doc_id": pd.array(block.ids[part], dtype="Int64"), "n_words": len(known), "codes": packed})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, block, known, codes = Splitter(special).words, _Block(), _Codes(), []
        for doc_id, text in _texts(batches):
            found = split(text)
            codes.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
            block.add(doc_id, text)
            if block.size >= BLOCK_CHARS:
                yield from rows(block, known, codes)
                block, known, codes = _Block(), _Codes(), []
        if block.ids:
            yield from rows(block, known, codes)

    return run


@functools.lru_cache(maxsize=1)
def _tokenizer(data: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode_bucket(shared):
    """The distinct words of one bucket, encoded once, as rows of ids for
    each block that holds some of them."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokenizer, unpress = _tokenizer(shared.value), zstandard.ZstdDecompressor()
        table, held = _Codes(), []
        for lengths, words in zip(pdf["lengths"], pdf["words"], strict=True):
            ends = np.cumsum(_unpack(lengths, unpress)).tolist()
            flat = unpress.decompress(words)
            held.append(np.fromiter((table[flat[a:b]] for a, b in zip([0, *ends], ends, strict=False)), np.int64, len(ends)))
        distinct = [w.decode("utf-8", "surrogatepass") for w in table]
        lengths, ids = [], []
        for start in range(0, len(distinct), 5_000):
            found = [e.ids for e in tokenizer.encode_batch(distinct[start : start + 5_000], add_special_tokens=False)]
            lengths.append(np.array([len(x) for x in found], np.int64))
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.int64))
        length, flat = np.concatenate(lengths), np.concatenate(ids)
        begin = np.cumsum(length) - length
        press, out = zstandard.ZstdCompressor(level=3), []
        for block, codes, words in zip(pdf["block"], pdf["codes"], held, strict=True):
            out.append((block, codes, _pack(length[words], press), _pack(flat[_spans(begin[words], length[words])], press)))
        return pd.DataFrame(out, columns=["block", "codes", "lengths", "ids"])

    return run


def _spans(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indexes of consecutive spans."""
    return np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)


def _ids(docs: pd.DataFrame, words: pd.DataFrame) -> Iterator[np.ndarray]:
    """The ids of a block's documents: their words' ids in position."""
    unpress = zstandard.ZstdDecompressor()
    parts = [[_unpack(x, unpress) for x in words[c]] for c in ("codes", "lengths", "ids")]
    codes, length, flat = (np.concatenate([np.empty(0, np.int64), *p]) for p in parts)
    flat = flat.astype(np.int32)
    n = int(docs["n_words"].iloc[0])
    begin_of, length_of = np.full(n, -1), np.zeros(n, np.int64)
    begin_of[codes], length_of[codes] = np.cumsum(length) - length, length
    if n and begin_of.min() < 0:
        raise ValueError("a block's words are incomplete: its rows changed between two reads")
    for data in docs["codes"]:
        c = _unpack(data, unpress)
        yield flat[_spans(begin_of[c], length_of[c])]


def _place(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    if not len(docs):
        return pd.DataFrame({"doc_id": [], "ids": []})
    return pd.DataFrame({"doc_id": docs["doc_id"].to_numpy(), "ids": list(_ids(docs, words))})


def text_of(ids: list[int], table: list[bytes]) -> str:
    """Decoded text: ids joined to their pieces."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")


def _digest(shared):
    """Digests of a block's documents, so that only they leave the task."""

    def run(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        table, rows = shared.value, []
        if len(docs):
            for doc_id, found in zip(docs["doc_id"], _ids(docs, words), strict=True):
                ids = found.tolist()
                of_ids = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
                rows.append((doc_id, len(ids), of_ids, hashlib.sha256(text_of(ids, table).encode()).hexdigest()))
        out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return run


def _by_block(docs: DataFrame, path: str, stored: bool):
    """Coded documents and encoded words, grouped by block."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not stored:
        docs = materialise(docs, "texts")
    with open(path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    special = _special(path)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = docs.mapInPandas(_words_of(special, buckets), "bucket int, block long, codes binary, lengths binary, words binary")
    encoded = words.groupBy("bucket").applyInPandas(_encode_bucket(shared), "block long, codes binary, lengths binary, ids binary")
    coded = docs.mapInPandas(_documents_of(special), "block long, doc_id long, n_words int, codes binary")
    return coded.groupBy("block").cogroup(encoded.groupBy("block"))


def encode(docs: DataFrame, path: str | None = None, stored: bool = False) -> DataFrame:
    """``doc_id, ids`` for every row. ``stored`` says that ``docs`` is read
    from files, row order included; other inputs are written first."""
    return _by_block(docs, path or default_path(), stored).applyInPandas(_place, "doc_id long, ids array<int>")


def pieces(path: str) -> list[bytes]:
    """Bytes of every id of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    # the visible characters that stand for the 256 bytes: printable ones for
    # themselves, the others numbered from 256
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    table = {i: bytes(byte[c] for c in piece) for piece, i in data["model"]["vocab"].items()}
    table |= {t["id"]: t["content"].encode() for t in data["added_tokens"]}
    return [table.get(i, b"") for i in range(max(table) + 1)]


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``."""
    spark = encoded.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(pieces(path or default_path()))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        for ids in batches:
            yield pd.Series([text_of(x.tolist(), table) for x in ids], dtype=object)

    return encoded.withColumn("decoded", F.pandas_udf(run, "string")("ids"))


def digests(docs: DataFrame, path: str | None = None, stored: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row."""
    path = path or default_path()
    shared = docs.sparkSession.sparkContext.broadcast(pieces(path))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _by_block(docs, path, stored).applyInPandas(_digest(shared), schema)
