"""Toxicity by subword-bag embeddings.

A word is the mean of the vectors of its character n-grams (hashed into a
fixed number of buckets, word boundaries marked), a bag is the mean of its
words, and a linear softmax over the bag says toxic or not. Vectors and
softmax are trained together in numpy on a bounded sample of labelled rows,
so an unseen misspelling is scored by the n-grams it shares.

A text is read as bags of ``BAG_WORDS`` words; its score is that of its
likeliest bag, so a few words in a long text aren't averaged away; training
takes the log-sum-exp of a text's bags. Since a bag's logit is a mean over
its words, scoring needs one number per n-gram bucket. A logistic curve over the likeliest bag's logit and the number
of bags, fitted on the rest of the sample under the labels' true shares,
turns logits into probabilities.

Defined cases: null and empty texts, and texts without words, get the score
of an empty bag (the bias alone, under 0.5); repeated rows get equal rows;
null labels are left out of training; without labels of both classes every
score is near 0; extra columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaspark.llm.common import prepare


BUCKETS, DIMENSIONS = 1 << 17, 4
NGRAMS = (3, 4, 5)
BAG_WORDS = 3
# Bounds of the training sample: rows of each class, characters of a row.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 2_500, 6_000
# Part of the sample that is kept from training and calibrates the scores.
CALIBRATED = 0.25
STEPS, RATE, DECAY, FLOOR = 80, 0.3, 0.01, 0.2
POINTS = 1 << 18  # characters that are hashed at once
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@functools.cache
def _in_word() -> np.ndarray:
    """For each code point, whether it belongs to a word (``\\w``)."""
    out = np.zeros(0x110000, bool)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out[np.frombuffer("".join(re.findall(r"\w", every)).encode("utf-32-le"), np.uint32)] = True
    return out


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)


def _grams(points: np.ndarray, start: np.ndarray, size: np.ndarray):
    """Buckets of the n-grams of words given by their places: for each n the
    buckets and the words they are of; at last each whole word's bucket. All
    n-grams are hashed at once, by a polynomial over the code points of the
    words between boundary marks."""
    n_words = len(start)
    padded = size + 2
    begin = np.cumsum(padded) - padded
    total = int(padded.sum())
    of = np.repeat(np.arange(n_words), padded)
    place = np.arange(total) - begin[of]
    chars = points[np.clip(start[of] + place - 1, 0, len(points) - 1)].astype(np.uint64)
    chars[begin], chars[begin + padded - 1] = 1, 2
    left = padded[of] - place  # code points from here to the word's end
    h = chars + np.uint64(1)
    out = []
    for n in range(2, max(NGRAMS) + 1):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + chars[n - 1 :]
        if n in NGRAMS:
            whole = np.flatnonzero(left[: len(h)] >= n)
            out.append((_mix(h[whole] + np.uint64(n)), of[whole]))
    power = np.full(int(padded.max()), np.uint64(0xC2B2AE3D27D4EB4F))
    power = np.multiply.accumulate(power)
    out.append((_mix(np.add.reduceat((chars + np.uint64(7)) * power[place], begin)), np.arange(n_words)))
    return out


def word_scores(points: np.ndarray, start: np.ndarray, size: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Mean score of each word's n-grams, ``POINTS`` code points at a time."""
    out = []
    upto = np.cumsum(size + 2)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + POINTS)))
        total, n = np.zeros(to - at), np.zeros(to - at)
        for bucket, of in _grams(points, start[at:to], size[at:to]):
            total += np.bincount(of, scores[bucket], to - at)
            n += np.bincount(of, minlength=to - at)
        out.append(total / n)
        at = to
    return np.concatenate(out) if out else np.zeros(0)


def _words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], _in_word()[points].view(np.int8), [0]))))
    return edge[::2], edge[1::2] - edge[::2]


class Bags:
    """Texts as bags of word numbers, with the words' n-grams in one array."""

    def __init__(self, texts: list[str]):
        vocabulary: dict[str, int] = {}
        words, doc, bag = [], [], []
        n_bags = 0
        for i, text in enumerate(texts):
            found = _WORD.findall(text.lower())
            words += [vocabulary.setdefault(w, len(vocabulary)) for w in found]
            doc += [i] * len(found)
            bag += [n_bags + j // BAG_WORDS for j in range(len(found))]
            n_bags += -(-len(found) // BAG_WORDS)
        self.words, self.doc, self.bag = (np.array(x, np.int64) for x in (words, doc, bag))
        self.doc_of_bag = np.zeros(n_bags, np.int64)
        self.doc_of_bag[self.bag] = self.doc
        size = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
        grams = _grams(_code_points("".join(vocabulary)), np.cumsum(size) - size, size) if len(size) else []
        self.grams = np.concatenate([b for b, _ in grams] or [np.zeros(0, np.int64)])
        self.word_of_gram = np.concatenate([w for _, w in grams] or [np.zeros(0, np.int64)])
        self.n_grams = np.bincount(self.word_of_gram, minlength=len(size)).astype(np.float64)


def gram_scores(state: dict) -> np.ndarray:
    """Per n-gram bucket, its share of the logit of toxic against not."""
    return state["vec"] @ (state["w"][:, 1] - state["w"][:, 0])


def _fit_vectors(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Bucket scores and bias of a bag's logit, by full-batch Adam steps on
    the vectors, the softmax weights and the bias together. A text's logit is
    the log-sum-exp of its bags' logits, so that the bags that stand out get
    the gradient."""
    bags = Bags(texts)
    rng = np.random.Generator(np.random.PCG64(7))
    state = {"vec": rng.normal(0, 0.01, (BUCKETS, DIMENSIONS)), "w": rng.normal(0, 0.5, (DIMENSIONS, 2)), "b": np.zeros(1)}
    if not len(bags.words):
        return gram_scores(state), 0.0
    first = {k: np.zeros_like(v) for k, v in state.items()}
    second = {k: np.zeros_like(v) for k, v in state.items()}
    n_docs, n_bags, n_words = len(y), len(bags.doc_of_bag), len(bags.n_grams)
    size = np.bincount(bags.bag, minlength=n_bags)
    start = np.searchsorted(bags.doc_of_bag, np.arange(n_docs))
    some = np.flatnonzero(np.bincount(bags.doc_of_bag, minlength=n_docs))
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for step in range(1, STEPS + 1):
        word = np.bincount(bags.word_of_gram, gram_scores(state)[bags.grams], n_words) / bags.n_grams
        logit = np.bincount(bags.bag, word[bags.words], n_bags) / size + state["b"][0]
        top = np.maximum.reduceat(logit, start[some])
        up = np.zeros(n_docs)
        up[some] = top
        e = np.exp(logit - up[bags.doc_of_bag])
        total = np.bincount(bags.doc_of_bag, e, n_docs)
        p = 1 / (1 + np.exp(-np.clip(up + np.log(np.maximum(total, 1e-300)), -50, 50)))
        d_doc = (p - y) * weight / np.maximum(total, 1e-300)
        d_logit = d_doc[bags.doc_of_bag] * e
        d_word = np.bincount(bags.words, (d_logit / size)[bags.bag], n_words) / bags.n_grams
        d_gram = np.bincount(bags.grams, d_word[bags.word_of_gram], BUCKETS)
        out = state["w"][:, 1] - state["w"][:, 0]
        d_w = state["vec"].T @ d_gram
        grads = {"vec": d_gram[:, None] * out, "w": np.stack([-d_w, d_w], 1), "b": np.array([d_logit.sum()])}
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            scale = np.sqrt(second[k] / (1 - 0.99**step))
            # the floor keeps n-grams with little evidence to small steps
            move = first[k] / (1 - 0.9**step) / (scale + FLOOR * scale.max() + 1e-12)
            state[k] = (1 - DECAY if k == "vec" else 1.0) * state[k] - RATE * move
    return gram_scores(state), float(state["b"][0])


def _curve(features: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression by Newton steps, classes weighted to ``share``."""
    x = np.c_[features, np.ones(len(y))]
    weight = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(c))
        c = c - np.clip(np.linalg.solve(h, x.T @ (weight * (p - y)) + 0.1 * c), -2, 2)
    return c


def train(texts: list[str], labels: list[int], share: float | None = None) -> dict:
    """Model from texts and labels; ``share`` is the part of toxic rows among
    all labelled ones (None: as in the sample). Every fourth text of a class
    calibrates."""
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        return {"scores": np.zeros(BUCKETS), "bias": 0.0, "curve": np.array([0.0, 0.0, -100.0])}
    nth = np.zeros(len(y), np.int64)
    for c in (0, 1):
        nth[y == c] = np.arange((y == c).sum())
    apart = nth % round(1 / CALIBRATED) == 0
    if len(set(y[~apart])) < 2:
        apart[:] = False
    fitted = [t for t, a in zip(texts, apart, strict=True) if not a]
    scores, bias = _fit_vectors(fitted, y[~apart])
    model = {"scores": scores, "bias": bias, "curve": np.array([1.0, 0.0, 0.0])}
    if apart.any() and len(set(y[apart])) == 2:
        features = np.stack(bag_features([t for t, a in zip(texts, apart, strict=True) if a], scores, bias)[:2], 1)
        model["curve"] = _curve(features, y[apart], y.mean() if share is None else share)
    return model


def bag_features(texts: list[str | None], scores: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text, the logit of its likeliest bag, the logarithm of its
    number of bags, and whether it has a word; all texts at once."""
    low = [(t or "").lower() for t in texts]
    points = _code_points("\n".join(low))
    ends = np.cumsum([len(t) + 1 for t in low])
    start, size = _words(points)
    s = word_scores(points, start, size, scores)
    n_words = np.bincount(np.searchsorted(ends, start, "right"), minlength=len(low))
    some = np.flatnonzero(n_words)
    logit, bags = np.full(len(low), float(bias)), np.zeros(len(low))
    if len(some):
        first = np.cumsum(n_words) - n_words  # word of each text
        n_bags = -(-n_words // BAG_WORDS)
        begin = np.cumsum(n_bags) - n_bags
        text = np.repeat(np.arange(len(low)), n_bags)
        cuts = first[text] + BAG_WORDS * (np.arange(int(n_bags.sum())) - begin[text])
        means = np.add.reduceat(s, cuts) / np.diff(np.append(cuts, len(s)))
        logit[some] = np.maximum.reduceat(means, begin[some]) + bias
        bags[some] = np.log(n_bags[some])
    return logit, bags, n_words > 0


def text_scores(texts: list[str | None], model: dict) -> np.ndarray:
    """Probabilities of whole texts."""
    logit, size, some = bag_features(texts, model["scores"], model["bias"])
    a, b, c = model["curve"]
    p = 1 / (1 + np.exp(-np.clip(a * logit + b * size + c, -500, 500)))
    return np.where(some, p, np.minimum(p, 0.49))


def _parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts of up to ``POINTS`` characters, longer ones alone."""
    part, n = [], 0
    for t in texts:
        if part and n + len(t or "") > POINTS:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t or "")
    if part:
        yield part


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Model from labelled rows that aren't held out: of each class at most
    ``SAMPLE_PER_CLASS`` texts, chosen by the hash of the id, those of at most
    ``SAMPLE_CHARS`` characters first; of a longer one, so many characters are
    learnt from. Only texts and labels enter the model. An id with several
    labels is learnt with each; a null id isn't learnt from."""
    known = labels.select(F.col("doc_id"), F.col("toxic").alias("_y")).where(F.col("_y").isin(0, 1) & ~held_out(F.col("doc_id")))
    share = known.agg(F.avg("_y").alias("s")).first()["s"]
    ok = docs.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"), (F.length("text") > SAMPLE_CHARS).alias("_long")).where(F.length("text") > 0)
    ids = known.join(ok.groupBy("doc_id").agg(F.min("_long").alias("_long")), "doc_id").distinct()
    rank = F.row_number().over(Window.partitionBy("_y").orderBy("_long", F.xxhash64("doc_id"), "doc_id"))
    ids = ids.withColumn("_r", rank).where(F.col("_r") <= SAMPLE_PER_CLASS).select("doc_id", "_y")
    # at most twice SAMPLE_PER_CLASS ids
    rows = ok.join(F.broadcast(ids), "doc_id").orderBy("doc_id", "text").limit(4 * SAMPLE_PER_CLASS).collect()
    return train([r["text"] for r in rows], [r["_y"] for r in rows], share)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.concatenate([text_scores(p, shared.value) for p in _parts(texts.tolist())] or [np.zeros(0)]))

    scored = docs.select("doc_id", F.pandas_udf(run, "double")("text").alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
