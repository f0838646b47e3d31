"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text (byte classes, word and line shapes, repetition) are
binned at quantiles of the training rows; trees grow level by level from
gradient histograms, and the fitted forest is flattened into arrays, so that a
batch is scored by one gather per level over all trees.

The model is fitted on a bounded sample of labelled rows (``sample`` rows, by
hash of their id; a documented parameter).  Rows whose crc32(doc_id as text) mod
3 is 1 never take part.  Scoring is one narrow pass over all documents.

Edge cases: a null text is the empty text; a null ``doc_id`` is not held out and
never labelled; rows with null labels or labels other than 0 and 1 don't train;
an id labelled twice trains with each label; without two classes of labelled
rows every score is the labelled rows' mean (0.5 without any); repeated rows
get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import slices

_CLASS = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 newline, 6 sentence mark, 7 non-ASCII
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[ord(c) for c in " \t\r\x0b\x0c"]] = 4
_CLASS[ord("\n")] = 5
_CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 6
_CLASS[128:] = 7

FEATURES = ("log_bytes", "lower", "upper", "digit", "blank", "newline", "mark", "non_ascii", "other",
            "byte_entropy", "top_symbol", "exclaim", "log_words", "word_len", "word_len_sd", "long_words",
            "short_words", "distinct_words", "top_word", "top3_words", "symbol_ended", "upper_words",
            "title_words", "repeat_pairs", "log_lines", "line_len", "distinct_lines", "top_line",
            "stop_ended_lines", "compress")


def statistics(raw: bytes) -> list[float]:
    """The values of ``FEATURES`` for a text in UTF-8."""
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASS, weights=counts, minlength=8) / n
    p = counts[counts > 0] / n
    symbols = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    words = raw.split()
    m = len(words)
    lens = np.fromiter(map(len, words), np.int64, m)
    freq: dict[bytes, int] = {}
    for w in words:
        freq[w] = freq.get(w, 0) + 1
    top = sorted(freq.values(), reverse=True)[:3] or [0]
    lasts = np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)
    firsts = np.frombuffer(b"".join(w[:1] for w in words), np.uint8)
    seconds = np.frombuffer(b"".join(w[1:2] or b"a" for w in words), np.uint8)
    lines = raw.split(b"\n")
    by_line: dict[bytes, int] = {}
    for x in lines:
        by_line[x] = by_line.get(x, 0) + 1
    full = [x for x in lines if x]
    pairs = len(set(zip(words, words[1:])))
    d = max(m, 1)
    return [
        float(np.log1p(n)), shares[1], shares[2], shares[3], shares[4], shares[5], shares[6], shares[7], shares[0],
        float(-(p * np.log2(p)).sum()), max(counts[33:48].max(), counts[58:65].max(), counts[91:97].max()) / n,
        counts[33] / max(symbols, 1), float(np.log1p(m)), float(lens.mean()) if m else 0.0,
        float(lens.std()) if m else 0.0, float((lens > 12).sum()) / d, float((lens <= 2).sum()) / d,
        len(freq) / d, top[0] / d, sum(top) / d, float((_CLASS[lasts] == 0).sum()) / d,
        float(((_CLASS[firsts] == 2) & (_CLASS[seconds] == 2)).sum()) / d, float((_CLASS[firsts] == 2).sum()) / d,
        1.0 - pairs / max(m - 1, 1), float(np.log1p(len(lines))), n / len(lines), len(by_line) / len(lines),
        max(by_line.values()) / len(lines), sum(x[-1:] in b".!?" for x in full) / max(len(full), 1),
        len(zlib.compress(raw, 1)) / n]


@dataclass
class Forest:
    """Trees as arrays: node i of tree t goes to child 2i+1 (+1 if its bin is over ``cut``)."""

    edges: list[np.ndarray]
    feature: np.ndarray  # [trees, inner nodes]
    cut: np.ndarray      # [trees, inner nodes]
    leaf: np.ndarray     # [trees, leaves]
    start: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        rows, trees = np.arange(len(bins))[:, None], np.arange(len(self.leaf))[None, :]
        inner = self.feature.shape[1]
        node = np.zeros((len(bins), len(self.leaf)), np.int64)
        while len(self.leaf) and node[0, 0] < inner:
            right = bins[rows, self.feature[trees, node]] > self.cut[trees, node]
            node = 2 * node + 1 + right
        return self.start + self.leaf[trees, node - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        bins: int = 64, l2: float = 1.0, least: float = 1.0) -> Forest:
    """Boosted trees for the logistic loss; a node splits if both sides keep ``least`` of hessian."""
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    inner, leaves, wide = 2 ** depth - 1, 2 ** depth, x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) if len(y) else np.zeros(0)
             for j in range(wide)]
    start = float(np.log(mean / (1 - mean)))
    if len(np.unique(y)) < 2:
        return Forest(edges, np.zeros((0, inner), int), np.zeros((0, inner), int), np.zeros((0, leaves)), start)
    forest = Forest(edges, np.zeros((trees, inner), int), np.full((trees, inner), bins), np.zeros((trees, leaves)), start)
    code = forest.bins(x)
    flat = code + np.arange(wide) * bins
    margin = np.full(len(y), start)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = y - prob, prob * (1 - prob)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (wide * bins) + flat).ravel()
            g, h = (np.bincount(at, np.repeat(v, wide), width * wide * bins).reshape(width, wide, bins).cumsum(2)
                    for v in (grad, hess))
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt ** 2 / (ht + l2)
            gain[(h < least) | (ht - h < least)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            ids = first + np.arange(width)
            forest.feature[t, ids] = best // bins
            forest.cut[t, ids] = np.where(good, best % bins, bins)
            node = 2 * node + 1 + (code[np.arange(len(y)), forest.feature[t, node]] > forest.cut[t, node])
        leaf = node - inner
        forest.leaf[t] = rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + l2)
        margin += forest.leaf[t, leaf]
    return forest


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = 20000) -> Forest:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_y"))
             .distinct().orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [statistics(t or b"") for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch([b.column("_id"), b.column("_y"), pa.array(rows, pa.list_(pa.float64()))],
                                  names=["_id", "_y", "x"])

    # the sample is bounded: at most ``sample`` ids are sent out
    rows = (docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(known), "_id")
            .mapInArrow(scan, "_id long, _y int, x array<double>")
            .orderBy(F.xxhash64("_id"), "_id", "_y", "x").limit(sample).collect())
    x = np.array([r.x for r in rows], np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([r._y for r in rows], np.float64))


def score_quality(docs: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """``docs`` with the score in 0..1 as its last column, in one narrow pass."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)  # a few thousand numbers, whatever the corpus
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            x = np.array([statistics(t or b"") for t in b.column(at).cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sent.value.score(x), pa.float64())],
                                             names=[*b.schema.names, name])

    return docs.mapInArrow(scan, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: one row per document with its score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score_quality(rows, train(rows, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    name = "_score"
    while name in map(str.lower, docs.columns):
        name += "_"
    return score_quality(docs, train(docs, labels), name).filter(F.col(name) >= 0.5).drop(name)
