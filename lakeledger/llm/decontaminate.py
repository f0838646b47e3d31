"""Benchmark decontamination: BM25 over test items with block-max WAND.

An item's question and answer (the last sentence, or else the last third of the
words) are units of their own; a part of more than ``UNIT`` five-word shingles is
cut into several, each shingle in one of them.  An inverted index holds for each
term its units with BM25 impacts, in blocks with their greatest impact.  Every
training document is a passage, a query of its distinct terms, whatever its
length: a shorter passage would miss a part whose shingles stand far apart.

A unit's threshold is what containment needs.  If the share ``overlap`` of its
shingles occurs, the words of all others may be lacking at most; each word's
impact is shared out among the shingles that hold it, so the lost impacts are at
most the sum over the heaviest shingles that may be lacking.  Impacts are held as
shares of that threshold, so one threshold, 1, serves all units.  If a part is
contained to ``overlap``, so is one of its units: no item that verifies is missed.

All units that reach the threshold are retrieved.  A passage's term maxima are
first summed by group of neighbouring units, for a whole batch at once; groups
that could complete an item are traversed document at a time, with a pivot and
block maxima.  An item is retrieved if a unit of each of its parts is.  It is then
verified against the whole document: five-word shingles of its question and of its
answer must both be contained to ``overlap`` (0.8) or more; fewer than five words
must occur in sequence.  Its score is the greatest share of a unit's own score.

The index of a set of items is broadcast in shards of at most ``SHARD_CHARS``
characters of items, each with a pass of its own, so its size is bounded however
large the set.  Document frequencies, the number of units and their mean length
are those of the whole set in every shard.  Documents are never shuffled.

Words are runs of anything but white space and ASCII punctuation, in lower case.

Edge cases: null texts are empty; items without words match nothing; a null
``doc_id`` or ``item_id`` is kept; repeated documents and items give a row each;
equal scores are all kept; a long text is one passage, read whole; extra columns
are not read; an empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, strings

UNIT, BLOCK, SHARD_CHARS = 64, 4, 4 << 20
GROUPS = 128  # at most so many groups of blocks are bounded at once
PAIRS = 1 << 16  # passages with so many terms in all are bounded at once
K1, B = 1.2, 0.75
_PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum())
_TABLE = bytes(32 if c in _PUNCTUATION else c for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's question and answer."""
    parts = [w for p in re.split(r"(?<=[.!?])\s+|\n", text) if (w := words_of(p))]
    if len(parts) > 1:
        return list(chain.from_iterable(parts[:-1])), parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def shingles(words: list[bytes], n: int = 5) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def contained(part: list[bytes], joined: bytes, n: int = 5) -> float:
    """Share of the part's shingles in ``joined`` (words with a blank around each); 1 if it has none."""
    own = shingles(part, n)
    return sum(b" " + s + b" " in joined for s in own) / len(own) if own else 1.0


def units_of(text: str, n: int = 5) -> list[tuple[int, list[bytes], set[bytes]]]:
    """(part, words, shingles) of an item's units; a shingle belongs to the first unit that holds it."""
    out = []
    for number, part in enumerate(question_answer(text)):
        seen: set[bytes] = set()
        starts = range(max(1, len(part) - n + 1) if part else 0)
        for at in range(0, len(starts), UNIT):
            own, covered = set(), set()
            for s in starts[at:at + UNIT]:
                shingle = b" ".join(part[s:s + n])
                if shingle not in seen:
                    own.add(shingle)
                    covered.update(range(s, min(s + n, len(part))))
            seen |= own
            if own:
                out.append((number, [part[p] for p in sorted(covered)], own))
    return out


def needed(weights: dict[bytes, float], own: set[bytes], overlap: float) -> float:
    """The least share of a unit's score in a document that holds ``overlap`` of its shingles."""
    least = next((c for c in range(1, len(own) + 1) if c / len(own) >= overlap), len(own))
    words = [set(s.split(b" ")) for s in own]
    held = Counter(chain.from_iterable(words))
    shares = sorted((sum(weights[w] / held[w] for w in each) for each in words), reverse=True)
    return 1 - sum(shares[:len(own) - least]) / sum(weights.values())


class Index:
    """Inverted index of item units with block maxima."""

    def __init__(self, items: list[tuple[int | None, str]], overlap: float = 0.8,
                 whole: tuple[int, int, dict[bytes, int]] | None = None):
        """``whole``: units, their words in all, and units of each term, of the set that ``items`` are of."""
        self.items = [(i, question_answer(t)) for i, t in items]
        units = [(n, *unit) for n, (_, t) in enumerate(items) for unit in units_of(t)]
        units.sort(key=lambda u: len(u[3]))  # units of like length share blocks: tighter maxima
        self.item_of = np.array([u[0] for u in units], np.int64)
        self.part_of = np.array([u[1] for u in units], np.int64)
        n_units, n_words, df = whole or (len(units), sum(len(u[2]) for u in units), None)
        mean = n_words / max(n_units, 1)
        counts = [Counter(u[2]) for u in units]
        postings: dict[bytes, list[int]] = {}
        for u, tf in enumerate(counts):
            for w in sorted(tf):
                postings.setdefault(w, []).append(u)
        self.term = {w: k for k, w in enumerate(postings)}
        idf = {}
        for w, ids in postings.items():
            n = df[w] if df else len(ids)
            idf[w] = float(np.log1p((n_units - n + 0.5) / (n + 0.5)))
        self.need = np.zeros(len(units))
        scaled = []
        for u, (_, _, words, own) in enumerate(units):
            weights = {w: idf[w] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
                       for w, tf in sorted(counts[u].items())}
            self.need[u] = needed(weights, own, overlap)
            full = sum(weights.values()) * self.need[u]
            scaled.append({w: x / full for w, x in weights.items()})
        self.ids = [np.array(ids, np.int64) for ids in postings.values()]
        self.impact = [np.array([scaled[u][w] for u in ids]) for w, ids in postings.items()]
        blocks = [range(0, len(i), BLOCK) for i in self.ids]
        self.block_max = [[float(s[b:b + BLOCK].max()) for b in bs] for s, bs in zip(self.impact, blocks)]
        self.block_last = [[int(i[min(b + BLOCK, len(i)) - 1]) for b in bs] for i, bs in zip(self.ids, blocks)]
        self.lists = [(i.tolist(), s.tolist()) for i, s in zip(self.ids, self.impact)]
        # the greatest impact of each term in each group of neighbouring units
        self.wide = max(BLOCK, -(-len(units) // GROUPS))
        self.group_max = np.zeros((len(self.ids), -(-len(units) // self.wide)), np.float32)
        for t, (i, s) in enumerate(zip(self.ids, self.impact)):
            np.maximum.at(self.group_max[t], i // self.wide, s)
        # units by item and part, for joining the parts of an item
        self.order = np.lexsort((self.part_of, self.item_of))
        key = self.item_of[self.order] * 2 + self.part_of[self.order]
        self.part_start = np.flatnonzero(np.diff(key, prepend=-1))
        self.item_start = np.flatnonzero(np.diff(key[self.part_start] // 2, prepend=-1))
        self.units_of_item = np.diff(np.append(self.part_start[self.item_start], len(units)))
        size = np.bincount(key, weights=[len(units[u][3]) for u in self.order], minlength=2 * len(self.items))
        self.longer = np.where(size[1::2] > size[::2], 1, 0)
        self.main = self.part_of == self.longer[self.item_of]
        self.parts = np.bincount(key[self.part_start] // 2, minlength=len(self.items))

    def able(self, passing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups of ``passing`` (passages x groups) that can complete an item: with its longer part, with any part."""
        unit = passing[:, self.order // self.wide]
        part = np.logical_or.reduceat(unit, self.part_start, axis=1)
        item = np.logical_and.reduceat(part, self.item_start, axis=1)
        unit &= np.repeat(item, self.units_of_item, axis=1)
        first, both = np.zeros_like(passing), np.zeros_like(passing)
        row, at = np.nonzero(unit)
        both[row, self.order[at] // self.wide] = True
        main = self.main[self.order[at]]
        first[row[main], self.order[at[main]] // self.wide] = True
        return first, both

    def wand(self, terms: list[int], threshold: float, low: int = 0, high: int | None = None) -> list[tuple[int, float]]:
        """All (unit, score) of the units from ``low`` to ``high`` with a score of ``threshold`` and more."""
        end, found = len(self.item_of) if high is None else min(high, len(self.item_of)), []
        groups = slice(low // self.wide, -(-end // self.wide))
        cursors = []
        for t, most in zip(terms, self.group_max[terms, groups].max(axis=1, initial=0).tolist()):
            ids, impact = self.lists[t]
            at = bisect_left(ids, low)
            if at < len(ids) and ids[at] < end:  # rounded maxima are raised a little
                cursors.append([ids[at], at, most * (1 + 1e-6), ids, impact, self.block_last[t], self.block_max[t]])
        while cursors:
            cursors.sort(key=_unit)
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += c[2]
                if total >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            moved = cursors[:pivot + 1]
            bound, reach = 0.0, end
            for c in moved:
                b = bisect_left(c[5], doc)
                if b < len(c[5]):
                    bound += c[6][b]
                    reach = min(reach, c[5][b] + 1)
            if bound < threshold:  # no unit up to the nearest end of a block can reach it
                if pivot + 1 < len(cursors):
                    reach = min(reach, cursors[pivot + 1][0])
                target = max(reach, doc + 1)
            elif cursors[0][0] == doc:
                score = sum(c[4][c[1]] for c in moved)
                if score >= threshold:
                    found.append((doc, score))
                target = doc + 1
            else:
                target, moved = doc, [c for c in moved if c[0] < doc]
            for c in moved:
                c[1] = bisect_left(c[3], target, c[1])
                c[0] = c[3][c[1]] if c[1] < len(c[3]) else end
            cursors = [c for c in cursors if c[0] < end]
        return found


_unit = itemgetter(0)


def _traverse(index: Index, terms: np.ndarray, groups: np.ndarray, threshold: float,
              met: dict[tuple[int, int], float]) -> None:
    """Add to ``met`` the (item, part) that a passage retrieves from ``groups``, with their greatest score."""
    for g in groups.tolist():
        there = terms[index.group_max[terms, g] > 0].tolist()
        for unit, score in index.wand(there, threshold - 1e-9, g * index.wide, (g + 1) * index.wide):
            key = (int(index.item_of[unit]), int(index.part_of[unit]))
            met[key] = max(score * float(index.need[unit]), met.get(key, 0.0))


def candidates(index: Index, texts: list[list[bytes]], threshold: float = 1.0) -> list[dict[int, float]]:
    """Per text the items of which a unit of each part is retrieved, with their greatest score."""
    out: list[dict[int, float]] = [{} for _ in texts]
    terms = len(index.ids)
    if not terms:
        return out
    get = index.term.get
    codes = np.fromiter((get(w, -1) for t in texts for w in t), np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    kept = codes >= 0
    pairs = np.unique(text[kept] * terms + codes[kept])
    text, code = pairs // terms, pairs % terms
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    stop = 0
    while stop < len(texts):
        a, begin = ends[stop], stop
        stop = min(max(begin + 1, int(np.searchsorted(ends, a + PAIRS, "right")) - 1), begin + 256, len(texts))
        z = ends[stop]
        if a == z:
            continue
        own, at = np.unique(text[a:z], return_index=True)
        passing = np.add.reduceat(index.group_max[code[a:z]], at, axis=0) >= threshold - 1e-4
        some = passing.any(axis=1)
        own, (first, both) = own[some], index.able(passing[some])
        for n in np.flatnonzero(first.any(axis=1)).tolist():
            mine, met = code[ends[own[n]]:ends[own[n] + 1]], {}
            _traverse(index, mine, np.flatnonzero(first[n]), threshold, met)
            if any(index.longer[item] == part for item, part in met):  # else no item can be complete
                _traverse(index, mine, np.flatnonzero(both[n] & ~first[n]), threshold, met)
            held = Counter(item for item, _ in met)
            out[own[n]] = {item: max(met.get((item, part), 0.0) for part in (0, 1))
                           for item, k in held.items() if k == index.parts[item]}
    return out


def matches(index: Index, texts: list[str], overlap: float) -> list[list[tuple]]:
    """Per text (item number, score, question overlap, answer overlap) of each verified item."""
    words = [words_of(t) for t in texts]
    out = []
    for w, found in zip(words, candidates(index, words)):
        joined = b" " + b" ".join(w) + b" " if found else b""
        rows = []
        for item in sorted(found):
            question, answer = index.items[item][1]
            a = contained(answer, joined)
            q = contained(question, joined) if a >= overlap else 0.0
            if q >= overlap and a >= overlap:
                rows.append((item, found[item], q, a))
        out.append(rows)
    return out


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shard and term with its units; the null term has all units and their words."""
    for b in batches:
        n_units, n_words = Counter(), Counter()
        for shard, text in zip(b.column("shard").to_pylist(), strings(b, "t")):
            for _, part, _ in units_of(text):
                n_units.update((shard, w) for w in {*part, None})
                n_words[shard, None] += len(part)
        if n_units:
            yield pa.record_batch([pa.array([k[0] for k in n_units], pa.int64()),
                                   pa.array([k[1] for k in n_units], pa.binary()),
                                   pa.array(list(n_units.values()), pa.int64()),
                                   pa.array([n_words[k] for k in n_units], pa.int64())],
                                  names=["shard", "term", "units", "words"])


def _shards(items: DataFrame, max_chars: int, overlap: float) -> Iterator[Index]:
    """Indexes of about ``max_chars`` characters of items, one in the driver at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("i"), F.coalesce("text", F.lit("")).alias("t"))
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // max_chars)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("i", "t"), F.lit(n)).cast("long")) if n else rows
    if n > 1:
        per = materialise(rows.select("shard", "t").mapInArrow(
            _count_units, "shard long, term binary, units long, words long")
            .groupBy("shard", "term").agg(F.sum("units").alias("units"), F.sum("words").alias("words")), "units")
        terms = materialise(per.groupBy("term").agg(F.sum("units").alias("units"), F.sum("words").alias("words")),
                            "terms")
        every = terms.filter("term IS NULL").select("units", "words").first()
    for shard in range(n):
        whole = None
        if n > 1 and every:
            own = per.filter((F.col("shard") == shard) & F.col("term").isNotNull()).select("term")
            whole = (*every, {bytes(r.term): r.units for r in terms.join(own, "term").select("term", "units").collect()})
        yield Index([(r.i, r.t) for r in rows.filter(F.col("shard") == shard).orderBy("i", "t").collect()],
                    overlap, whole)


MATCH = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def contaminated(docs: DataFrame, items: DataFrame, overlap: float = 0.8,
                 shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row per document and test item that the document holds."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for shard in _shards(items, shard_chars, overlap):
        index = spark.sparkContext.broadcast(shard)

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text", 2 << 20):
                each = matches(index.value, strings(b, "text"), overlap)
                hits = [(d, index.value.items[m[0]][0], *m[1:])
                        for d, ms in zip(b.column("doc_id").to_pylist(), each) for m in ms]
                if hits:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(
                        zip(*hits), (pa.int64(), pa.int64(), *[pa.float64()] * 3))],
                        names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = rows.mapInArrow(scan, MATCH)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], MATCH)


def decontaminate(docs: DataFrame, items: DataFrame, overlap: float = 0.8,
                  shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``docs`` without the rows that hold a test item; narrow, so texts are never shuffled."""
    spark, at = docs.sparkSession, docs.columns.index("text")
    for shard in _shards(items, shard_chars, overlap):
        index = spark.sparkContext.broadcast(shard)

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text", 2 << 20):
                texts = [t or "" for t in b.column(at).to_pylist()]
                clean = [not m for m in matches(index.value, texts, overlap)]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
