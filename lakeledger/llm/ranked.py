"""Ranked lexical search: hybrid of term-at-a-time and document-at-a-time.

``build_index`` writes an inverted index in segments of about ``segment_terms``
terms; a segment holds whole documents and all their terms.  ``search`` scans it
once for each block of queries, of bounded size, which is broadcast.  A task goes
through its segments and keeps the ``k`` best documents of each query, whose least
score is the threshold for all that follow.  Per query and segment:

1. Term at a time: the shortest lists, up to ``short_postings`` postings in all, are
   summed into accumulators.  These become one iterator, bounded by their maximum.
2. Document at a time: that iterator and the long lists, each bounded by its
   greatest contribution, are merged by pivot.  Documents before the pivot cannot
   reach the threshold; all iterators skip to it by binary search.

Skipping is exact: only documents whose bound is under the ``k``-th score go.
Scores are whole numbers (see :func:`rank`).  Numbers of documents, lengths and
document frequencies are counted over all documents.

Edge cases: a null text, or one without terms, is no document and no query; null
ids are kept and sort last among equal scores; every row is a document or a query
of its own, so rows that repeat one are ranked again; an empty table on either
side gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, slices

#: Bytes of a text as they count for terms: ASCII letters lower-cased, other ASCII but digits a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))
#: Numbers of the term weight and of the term frequency's saturation; fixed values.
WEIGHT, FREQUENCY, SATURATION, MEAN_SHARE = 1000, 1_000_000_000, 8, 75

SEGMENT = ("doc_ids array<long>, lengths binary, n_terms long, terms array<string>, dfs array<int>, "
           "docs binary, tfs binary")
BLOCK_BYTES = 8 << 20


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def _segment(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
    """Postings by term, in the order of documents."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = pa.array([t for w in words for t in w], pa.binary()).dictionary_encode()
    n = len(flat.dictionary)
    key = flat.indices.to_numpy().astype(np.int64) * len(words) + np.repeat(np.arange(len(words)), lengths)
    key, tfs = np.unique(key, return_counts=True)
    dfs = np.bincount(key // len(words), minlength=n)
    row = [ids, lengths.astype("<i4").tobytes(), int(lengths.sum()), flat.dictionary.cast(pa.string()).to_pylist(),
           dfs.tolist(), (key % len(words)).astype("<i4").tobytes(), tfs.astype("<i4").tobytes()]
    kinds = [pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()),
             pa.binary(), pa.binary()]
    names = ["doc_ids", "lengths", "n_terms", "terms", "dfs", "docs", "tfs"]
    return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def build_index(docs: DataFrame, segment_terms: int = 1 << 20) -> DataFrame:
    """The written segments of ``docs`` (doc_id, text)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, held = [], [], 0
        for b in slices(batches, "text", 4 << 20):
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if w := terms_of(t):
                    ids.append(i)
                    words.append(w)
                    held += len(w)
                    if held >= segment_terms:
                        yield _segment(ids, words)
                        ids, words, held = [], [], 0
        if ids:
            yield _segment(ids, words)

    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, SEGMENT),
                       "postings")


def _query_terms(items: DataFrame) -> DataFrame:
    """``row, item_id, term, n``: the terms of each row of ``items``, with their counts."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows, ids, terms, n = [], [], [], []
            for r, i, t in zip(*[b.column(c).to_pylist() for c in ("row", "item_id", "text")]):
                for term, c in Counter(terms_of(t)).items():
                    rows.append(r)
                    ids.append(i)
                    terms.append(term.decode())
                    n.append(c)
            yield pa.record_batch([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()),
                                   pa.array(terms, pa.string()), pa.array(n, pa.int64())],
                                  names=["row", "item_id", "term", "n"])

    own = items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"),
                       "text")
    return materialise(own.mapInArrow(scan, "row long, item_id long, term string, n long"), "query-terms")


def _blocks(queries: DataFrame) -> Iterator[list[tuple]]:
    """Queries in lists of about BLOCK_BYTES, read partition by partition; one larger query is a list of its own."""
    block, held = [], 0
    for q in queries.toLocalIterator():
        size = sum(40 + len(t) for t in q.terms)
        if block and held + size > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((q.row, q.item_id, list(q.terms), list(q.weights)))
        held += size
    if block:
        yield block


class _Merge:
    """Document-at-a-time merge of bounded iterators, each (bound, documents, scores), by pivot."""

    def __init__(self, lists: list[tuple[int, list[int], list[int]]]):
        self.at = [[docs[0], 0, bound, docs, scores] for bound, docs, scores in lists]

    def run(self, threshold: int) -> Iterator[tuple[int, int]]:
        """Documents with their scores; the caller sends the threshold it has after each."""
        at = self.at
        first = lambda it: it[0]
        while True:
            at.sort(key=first)
            bound, pivot = 0, None
            for it in at:
                bound += it[2]
                if bound >= threshold:
                    pivot = it[0]
                    break
            if pivot is None:
                return
            ended = False
            if at[0][0] == pivot:
                score = 0
                for it in at:
                    if it[0] != pivot:
                        break
                    score += it[4][it[1]]
                    it[1] += 1
                    if it[1] < len(it[3]):
                        it[0] = it[3][it[1]]
                    else:
                        it[0], ended = math.inf, True
                threshold = yield pivot, score
            else:
                for it in at:
                    if it[0] >= pivot:
                        break
                    it[1] = bisect_left(it[3], pivot, it[1] + 1)
                    if it[1] < len(it[3]):
                        it[0] = it[3][it[1]]
                    else:
                        it[0], ended = math.inf, True
            if ended:
                self.at = at = [it for it in at if it[0] is not math.inf]


def accumulate(lists: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Term at a time: the sums of several lists as one list and its bound."""
    docs, where = np.unique(np.concatenate([d for _, d, _ in lists]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    np.add.at(sums, where, np.concatenate([s for _, _, s in lists]))
    return int(sums.max()), docs, sums


def hybrid(lists: list[tuple[int, np.ndarray, np.ndarray]], k: int, threshold: int,
           short_postings: int) -> Iterator[tuple[int, int]]:
    """Documents and scores that may be among the ``k`` best; see :class:`_Merge` for the threshold."""
    if sum(b for b, _, _ in lists) < threshold:
        return
    lists.sort(key=lambda x: len(x[1]))
    n, held = 0, 0
    while n < len(lists) and held + len(lists[n][1]) <= short_postings:
        held += len(lists[n][1])
        n += 1
    if n > 1:
        lists = [accumulate(lists[:n]), *lists[n:]]
        sums = lists[0][2]
        if len(sums) >= k:  # the other lists only add
            threshold = max(threshold, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
    if len(lists) == 1:  # nothing to merge with
        _, docs, sums = lists[0]
        near = sums >= threshold
        lists = [(lists[0][0], docs[near], sums[near])]
    yield from _Merge([(b, d.tolist(), s.tolist()) for b, d, s in lists if len(d)]).run(threshold)


def search(index: DataFrame, queries: DataFrame, n_docs: int, n_terms: int, k: int = 10,
           short_postings: int = 2048) -> DataFrame:
    """``row, item_id, rank, doc_id, score`` for ``queries`` (row, item_id, terms, weights)."""
    spark = index.sparkSession
    schema = "row long, item_id long, doc_id long, score long"

    def searcher(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            vocabulary = sorted({t for _, _, terms, _ in block for t in terms})
            number = {t: i for i, t in enumerate(vocabulary)}
            asked = [[(number[t], w) for t, w in zip(terms, weights) if w > 0] for _, _, terms, weights in block]
            wanted = pa.array(vocabulary, pa.string())
            best: list[list[tuple]] = [[] for _ in block]
            for b in slices(batches, "docs", 1):
                c = {n: b.column(n)[0] for n in b.schema.names}
                ids = c["doc_ids"].values.to_pylist()
                m = 100 - MEAN_SHARE + MEAN_SHARE * np.frombuffer(c["lengths"].as_py(), "<i4").astype(np.int64) \
                    * n_docs // n_terms
                bounds = np.concatenate(([0], np.cumsum(c["dfs"].values.to_numpy())))
                docs, tfs = (np.frombuffer(c[n].as_py(), "<i4") for n in ("docs", "tfs"))
                found = pc.index_in(c["terms"].values, wanted)
                lists: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
                at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
                for i, t in zip(at.tolist(), found.take(pa.array(at)).to_pylist()):
                    d = docs[bounds[i]:bounds[i + 1]]
                    tf = tfs[bounds[i]:bounds[i + 1]].astype(np.int64)
                    share = FREQUENCY * tf // (1000 * tf + SATURATION * m[d])
                    lists[t] = int(share.max()), d, share
                for q, terms in enumerate(asked):
                    mine = [(lists[t][0] * w, lists[t][1], lists[t][2] * w) for t, w in terms if t in lists]
                    if not mine:
                        continue
                    top = best[q]
                    least = top[0][0] if len(top) == k else 1
                    found_docs = hybrid(mine, k, least, short_postings)
                    entry = next(found_docs, None)
                    while entry is not None:
                        doc, score = entry
                        i = ids[doc]
                        kept = (score, i is not None, -(i or 0))  # the least of the heap goes first
                        if score > 0:
                            if len(top) < k:
                                heapq.heappush(top, kept)
                            elif kept > top[0]:
                                heapq.heapreplace(top, kept)
                            if len(top) == k:
                                least = max(least, top[0][0])
                        try:
                            entry = found_docs.send(least)
                        except StopIteration:
                            entry = None
            flat = [(block[q][0], block[q][1], -x if known else None, score)
                    for q, top in enumerate(best) for score, known, x in top]
            if flat:
                yield pa.record_batch([pa.array(v, pa.int64()) for v in zip(*flat)],
                                      names=["row", "item_id", "doc_id", "score"])
        return scan

    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    results = []
    for block in _blocks(queries):
        shared = spark.sparkContext.broadcast(block)
        hits = index.mapInArrow(searcher(shared), schema).withColumn("rank", F.row_number().over(order))
        results.append(materialise(hits.filter(F.col("rank") <= k), "hits"))
        shared.destroy()
    if not results:
        return spark.createDataFrame([], schema + ", rank int")
    return spark.read.schema(results[0].schema).parquet(*[p for r in results for p in r.inputFiles()]) \
        if len(results) > 1 else results[0]


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    A term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``; it is multiplied by
    ``(10^9 tf) div (1000 tf + 8m)``, where ``m = 25 + (75 n N) div L``.
    """
    spark = docs.sparkSession
    index = build_index(docs)
    n_docs, n_terms = index.agg(F.sum(F.size("doc_ids")).cast("long"), F.sum("n_terms")).first()
    asked = _query_terms(items)
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    counted = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select(
        F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
    frequency = materialise(counted.join(asked.select("term").distinct(), "term", "left_semi")
                            .groupBy("term").agg(F.sum("df").alias("df")), "frequencies")
    weight = F.floor(WEIGHT * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1)))
    queries = materialise(
        asked.join(frequency, "term").withColumn("w", weight * F.col("n")).groupBy("row")
        .agg(F.first("item_id").alias("item_id"), F.collect_list(F.struct("term", "w")).alias("t"))
        .select("row", "item_id", F.col("t.term").alias("terms"), F.col("t.w").alias("weights")), "queries")
    return search(index, queries, n_docs, n_terms, k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH terms AS (
  SELECT rowid AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
len AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM len),
weight AS (SELECT term, floor(1000 * ln((2 * (SELECT big_n FROM total) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf GROUP BY term),
asked AS (SELECT r, item_id, term, count(*) AS q FROM (
    SELECT r, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS r, item_id, text FROM benchmark)) GROUP BY ALL),
scored AS (
  SELECT a.r AS item_row, a.item_id, tf.r, tf.doc_id,
    sum(a.q * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * len.n * t.big_n) // t.big_l))))::BIGINT AS score
  FROM asked a JOIN tf USING (term) JOIN weight w USING (term) JOIN len ON len.r = tf.r CROSS JOIN total t
  GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
