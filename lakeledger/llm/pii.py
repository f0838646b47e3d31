"""Personal data: base forms, and contextual extraction bootstrapped from them.

Base spans (``email``, ``ip``, ``card``, ``phone``) seed the method and always
stay.  The two words to the left of a span and the two to its right are lexical
patterns, one of each side.  Slots are spans that no base span touches, by
shape: numbers (tokens of four and more digits, or short groups of digits next
to one another) and handles (``@name``, words joined by dots or underscores,
and e-mail addresses written with "at" and "dot").

Patterns and values make a bipartite graph, which Spark scores in rounds.  A base
value has score 1.  A pattern takes a shape for a kind if it has ``min_seeds``
distinct known values of the kind, these are the share ``accept`` of all its
values, base ones and those of the shape (smoothed by one), and the sum of their
scores is the share ``trust`` of all its values (not smoothed).  The latter is the
pattern's score.  All slots of the shape in it are spans of the kind.
Distinctive values among them (seven and more digits, handles) are known from
the next round on, with the best score of the patterns that found them: they
count in other patterns, and are spans wherever they stand.

So a score is a product of shares along the path from base values, and a path
ends before its product is under ``trust``: doubt does not add up over rounds.
A pattern's score stays as it was when it was taken, so nothing that it found
speaks for it, whether by itself or through other patterns.  Scores are whole
millionths, sums of them the same in any order.  Rounds go on until none takes a
pattern; what is known depends on the patterns taken alone.

Edges (pattern, value) are made distinct before they are counted, sums are
combined before their shuffle, and what a frequent pattern or value is joined
with is written first, so that AQE can split it: a context that fills a third of
the corpus is not one task's.

Edge cases: a null text is the empty text; repeated rows are one instance each
value; an empty table, or one without seeds, has base spans only; a null ``doc_id`` is
kept; of labels with equal scores the last in the alphabet counts.  A word of
letters alone is not a slot.  Words of any length are whole in a pattern: those
over ``LONG`` characters by their length and a hash, so that many slots within
one very long word cost no more than its length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, strings
from .spans import join_spans

KINDS = ("email", "ip", "card", "phone")
ONE = 1_000_000  # the score of a base value
LONG, REACH = 80, 170  # longer words are hashed; characters that are searched for words at first
FACTOR = 0x9E3779B97F4A7C15

# The forms of the base kinds.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SLOT = re.compile(r"[0-9](?:\S*[0-9])?")
PLAIN = re.compile(r"[0-9().-]+")
HANDLE = re.compile(r"(?<![\w.@/-])(?:@[A-Za-z0-9_]++(?:\.[A-Za-z0-9_]++)*+|[A-Za-z][A-Za-z0-9]*+(?:[._][A-Za-z0-9]++)++)(?![\w@/(-])")
AT = re.compile(r"\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20", re.I)
SPELT = re.compile(r"[a-z0-9-]++(?:(?:\.|\x20?[\[({<]\x20?dot\x20?[\])}>]\x20?|\x20dot\x20)[a-z0-9-]++)++", re.I)
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; each has one @, so they are found from the @ outwards in linear time."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            found.append((start, end))
        at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start; offsets in code points."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(_small, m.groups()))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return found


class Words:
    """The blank-separated words of a text, for contexts."""

    def __init__(self, text: str):
        self.text = text
        self._ends: tuple[list[int], list[int]] | None = None
        self._sums: np.ndarray | None = None

    def _word(self, start: int, end: int) -> str:
        """A word in lower case; a long one by its length and a hash, with A-Z lower-cased."""
        if end - start <= LONG:
            return self.text[start:end].lower()
        if self._sums is None:  # prefix sums of code point times FACTOR ** position, modulo 2 ** 64
            codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
            codes += np.where((codes >= 65) & (codes <= 90), 33, 1).astype(np.uint64)
            codes *= np.cumprod(np.full(len(codes), FACTOR, np.uint64), dtype=np.uint64)
            self._sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes, dtype=np.uint64)))
        total = (int(self._sums[end]) - int(self._sums[start])) * pow(FACTOR, -start, 1 << 64) % (1 << 64)
        return f"#{end - start}:{total:016x}"

    def _spans(self) -> tuple[list[int], list[int]]:
        if self._ends is None:
            found = [m.span() for m in re.finditer(r"\S+", self.text)]
            self._ends = [s for s, _ in found], [e for _, e in found]
        return self._ends

    def left(self, end: int) -> list[str]:
        """The last two words, or parts of words, before ``end``."""
        begin = max(0, end - REACH)
        near = self.text[begin:end].split()
        whole = near if not begin else near[1:]  # the first one may begin earlier
        if (len(whole) >= 2 or not begin) and all(len(w) <= LONG for w in whole[-2:]):
            return [w.lower() for w in whole[-2:]]
        starts, ends = self._spans()
        k = bisect_left(starts, end)
        return [self._word(s, min(e, end)) for s, e in zip(starts[max(0, k - 2):k], ends[max(0, k - 2):k])]

    def right(self, start: int) -> list[str]:
        """The first two words, or parts of words, from ``start`` on."""
        stop = start + REACH
        near = self.text[start:stop].split()
        whole = near if stop >= len(self.text) else near[:-1]
        if (len(whole) >= 2 or stop >= len(self.text)) and all(len(w) <= LONG for w in whole[:2]):
            return [w.lower() for w in whole[:2]]
        starts, ends = self._spans()
        k = bisect_right(ends, start)
        return [self._word(max(s, start), e) for s, e in zip(starts[k:k + 2], ends[k:k + 2])]


def contexts(words: Words, start: int, end: int) -> tuple[str, str]:
    """The two words to the left and to the right, in lower case."""
    left, right = words.left(start), words.right(end)
    return " ".join(["<", *left]) if left else "", " ".join([">", *right]) if right else ""


def n_digits(text: str) -> int:
    return sum(c in "0123456789" for c in text)


def numbers(text: str, min_digits: int = 4, most: int = 19) -> list[tuple[int, int]]:
    """Tokens with digits, without punctuation around them; short groups of digits side by side are one."""
    found, grouped = [], False
    for m in SLOT.finditer(text):
        start, end = m.span()
        while start and text[start - 1].isalnum():
            start -= 1
        while end < len(text) and text[end].isalnum():
            end += 1
        short = bool(PLAIN.fullmatch(text, start, end)) and n_digits(text[start:end]) <= 7
        if short and grouped and text[found[-1][1]:start] in (" ", ") ", " (") \
                and n_digits(text[found[-1][0]:end]) <= most:
            found[-1] = (found[-1][0], end)
        else:
            found.append((start, end))
        grouped = short
    return [(s, e) for s, e in found if n_digits(text[s:e]) >= min_digits]


def handles(text: str) -> list[tuple[int, int]]:
    """Names with an @ or joined words, and e-mail addresses in words."""
    found = []
    for m in AT.finditer(text):
        start = m.start()
        while start and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < m.start() and (d := SPELT.match(text, m.end())):
            found.append((start, d.end()))
    return found + [m.span() for m in HANDLE.finditer(text)]


def slots(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(shape, start, end) of the spans that no base span and no slot of an earlier shape touches."""
    spans = sorted((s, e) for _, s, e in taken)
    found = []
    for shape, each in (("handle", handles(text)), ("number", numbers(text))):
        free, k, last = [], 0, 0
        for s, e in sorted(each):
            while k < len(spans) and spans[k][1] <= s:
                k += 1
            if s >= last and (k == len(spans) or spans[k][0] >= e):
                free.append((s, e))
                last = e
        found += [(shape, s, e) for s, e in free]
        spans = sorted(spans + free)
    return found


def identity(kind: str, text: str) -> str:
    """What a value is compared by: digits alone for numbers, else lower case."""
    if kind in ("card", "phone", "number") and not any(c.isalpha() for c in text):
        return "".join(c for c in text if c in "0123456789")
    return text.lower()


def distinctive(shape: str, value: str) -> bool:
    return shape == "handle" or n_digits(value) >= 7


SHAPES = ("number", "handle")
SCAN_SCHEMA = ("doc_id long, _row string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
               "found array<struct<kind:string,shape:string,start:int,end:int,left:string,right:string,"
               "value:string,strong:boolean>>")
FOUND_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("shape", pa.string()), ("start", pa.int32()),
                                 ("end", pa.int32()), ("left", pa.string()), ("right", pa.string()),
                                 ("value", pa.string()), ("strong", pa.bool_())]))


def _hash(s: str) -> str:
    return hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _found(words: Words, kind: str, shape: str, start: int, end: int) -> dict:
    (left, right), value = contexts(words, start, end), identity(kind or shape, words.text[start:end])
    return {"kind": kind, "shape": shape, "start": start, "end": end, "left": left, "right": right,
            "value": _hash(value), "strong": bool(kind) or distinctive(shape, value)}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    task, n = TaskContext.get().partitionId(), 0
    for b in slices(batches, "text"):
        counts, shas, found, rows = [], [], [], []
        for text in strings(b, "text"):
            base = base_spans(text)
            kinds = Counter(s[0] for s in base)
            counts.append([kinds[k] for k in KINDS])
            shas.append(hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest())
            words = Words(text)
            found.append([_found(words, k, "", s, e) for k, s, e in base]
                         + [_found(words, "", shape, s, e) for shape, s, e in slots(text, base)])
            rows.append(f"{task}-{n}")
            n += 1
        yield pa.record_batch(
            [b.column("doc_id"), pa.array(rows),
             *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)],
             pa.array(shas), pa.array(found, FOUND_TYPE)],
            names=["doc_id", "_row", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "found"])


def _sides(each: DataFrame, *columns: str) -> DataFrame:
    """A row for each pattern of a span."""
    return each.select(F.explode(F.array("left", "right")).alias("pattern"), *columns).filter("pattern <> ''")


def bootstrap(each: DataFrame, min_seeds: int = 3, accept: float = 0.7, trust: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """(``pattern, shape, label, score`` of the patterns taken, ``value, label, score`` of the values known).

    ``each`` has ``kind`` (empty for a slot), ``shape``, ``left``, ``right``, ``value``, ``strong``.
    """
    known = materialise(each.filter("kind <> ''").select("value", F.col("kind").alias("label"),
                                                         F.lit(ONE).cast("long").alias("score")).distinct(), "known")
    sides = _sides(each, "kind", "shape", "value", "strong")
    able = materialise(sides.filter("strong").select("pattern", "value").distinct().groupBy("pattern")
                       .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_seeds).select("pattern"), "able")
    shapes = F.when(F.col("kind") == "", F.array("shape")).otherwise(F.array(*[F.lit(x) for x in SHAPES]))
    edges = materialise(
        sides.join(able, "pattern", "left_semi")
        .select("pattern", F.explode(shapes).alias("shape"), "value", "strong", (F.col("kind") == "").alias("slot"))
        .groupBy("pattern", "shape", "value").agg(F.max("strong").alias("strong"), F.max("slot").alias("slot")), "edges")
    sizes = materialise(edges.groupBy("pattern", "shape").agg(F.count(F.lit(1)).alias("n")), "sizes")
    taken = None
    while True:
        held = edges.join(known, "value").groupBy("pattern", "shape", "label") \
            .agg(F.count(F.lit(1)).alias("held"), F.sum("score").alias("weight")).filter(F.col("held") >= min_seeds)
        fit = held.join(sizes, ["pattern", "shape"]).withColumn("score", F.expr("weight div n")) \
            .filter((F.col("held") / (F.col("n") + 1) >= accept) & (F.col("score") >= round(trust * ONE)))
        if taken is not None:
            fit = fit.join(taken, ["pattern", "shape"], "left_anti")
        fresh = materialise(fit.groupBy("pattern", "shape").agg(F.max(F.struct("score", "label")).alias("b"))
                            .select("pattern", "shape", "b.label", "b.score"), "taken")
        taken = fresh if taken is None else taken.unionByName(fresh)
        if fresh.isEmpty():
            return taken, known
        new = edges.filter("slot AND strong").join(fresh, ["pattern", "shape"]).select("value", "label", "score")
        known = materialise(known.unionByName(new).groupBy("value", "label")
                            .agg(F.max("score").alias("score")), "known")


def extract(docs: DataFrame, min_seeds: int = 3, accept: float = 0.7, trust: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """(rows of documents with base counts, all their spans ``_row, kind, start, end``)."""
    rows = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                       .mapInArrow(_scan, SCAN_SCHEMA), "pii")
    each = rows.select("_row", F.explode("found").alias("f")).select("_row", "f.*")
    taken, known = bootstrap(each, min_seeds, accept, trust)
    free = each.filter("kind = ''")
    values = materialise(known.groupBy("value").agg(F.max(F.struct("score", "label")).alias("b"))
                         .select("value", "b.label", "b.score"), "values")
    marks = ["_row", "start", "end", "label", "score"]
    new = _sides(free, "shape", "_row", "start", "end").join(taken, ["pattern", "shape"]).select(*marks) \
        .unionByName(free.filter("strong").join(values, "value").select(*marks)) \
        .groupBy("_row", "start", "end").agg(F.max(F.struct("score", "label")).alias("b")) \
        .select("_row", F.col("b.label").alias("kind"), "start", "end")
    return rows.drop("found"), each.filter("kind <> ''").select("_row", "kind", "start", "end").unionByName(new)


def personal_spans(docs: DataFrame) -> DataFrame:
    """The query."""
    rows, spans = extract(docs)
    return join_spans(rows, spans, KINDS, by_kind=True).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
