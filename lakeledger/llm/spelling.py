"""Spelling variants: composition of the vocabulary with a one-edit transducer.

The words of a text collection are one acceptor A; A . E . A, with E the
transducer of exactly one inserted, deleted or replaced code point, accepts the
pairs of near words.  Both copies of A move together until E takes its edit arc,
and in step again after it.  So a pair's states are those of its common prefix, and
the composition is cut by initial states:

* A word's *frontier* is its shortest prefix under which there are at most
  ``group_words`` words.  The states behind a frontier are one group.  Its words
  are built into a minimised acceptor; the composed machine is walked from there,
  its dead state pairs are cut off, and accepted pairs are enumerated.
* Where the edit comes before the frontier, both copies must accept the same
  remainder.  These state pairs are dealt by prefix and remainder, as a grouping
  (replaced code points: a group has one word per code point, 90 at most) and a
  join of unique words (inserted ones).

Each pair is accepted once, at the end of its common prefix.  No group grows
with the collection: a prefix with many words has a longer frontier.

Edge cases: null and empty texts have no words; a null ``doc_id`` deletes no code
point; each row counts by itself, rows that repeat one included; a word of any
length is kept whole; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices

#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 400_000
END = "\0"


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words; state 0 is initial."""

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}  # states of equal right language are one
        path, last = [0], ""

        def settle(down_to: int) -> None:
            for i in range(len(path) - 1, down_to, -1):
                s = path[i]
                like = known.setdefault((self.final[s], *self.arcs[s].items()), s)
                if like != s:
                    self.arcs[path[i - 1]][last[i - 1]] = like
            del path[down_to + 1:]

        for word in words:
            n = 0
            while n < len(last) and n < len(word) and last[n] == word[n]:
                n += 1
            settle(n)
            for a in word[n:]:
                self.arcs[path[-1]][a] = len(self.arcs)
                path.append(len(self.arcs))
                self.arcs.append({})
                self.final.append(False)
            self.final[path[-1]] = True
            last = word
        settle(0)


class Composition:
    """The acceptor, one edit, and the acceptor again.

    Behind the edit a state is a pair of states of the acceptor that read the
    same letters; before it both are one state.
    """

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self.live: dict[tuple[int, int], bool] = {}
        self.after: dict[int, list[tuple[str, str]]] = {}

    def _next(self, p: int, q: int) -> Iterator[tuple[str, int, int]]:
        other = self.arcs[q]
        return ((a, r, other[a]) for a, r in self.arcs[p].items() if a in other)

    def is_live(self, p: int, q: int) -> bool:
        """Whether both states accept a word in common."""
        live = self.live
        stack = [(p, q, self._next(p, q))]
        while stack:
            p, q, rest = stack[-1]
            if live.get((p, q)) is None and (p == q or (self.final[p] and self.final[q])):
                live[p, q] = True
            if (p, q) not in live:
                for _, r, s in rest:
                    known = live.get((r, s))
                    if known is None:
                        stack.append((r, s, self._next(r, s)))
                        break
                    if known:
                        live[p, q] = True
                        break
                else:
                    live[p, q] = False
                if (p, q) not in live:
                    continue
            stack.pop()
            if stack and live[p, q]:
                live[stack[-1][:2]] = True
        return live[p, q]

    def common(self, p: int, q: int, but: str | None = None) -> Iterator[str]:
        """The words that both states accept, but for those that begin with ``but``."""
        if not self.is_live(p, q):
            return
        if self.final[p] and self.final[q]:
            yield ""
        path: list[str] = []
        stack = [(x for x in self._next(p, q) if x[0] != but)]
        while stack:
            for a, r, s in stack[-1]:
                if self.is_live(r, s):
                    path.append(a)
                    stack.append(self._next(r, s))
                    if self.final[r] and self.final[s]:
                        yield "".join(path)
                    break
            else:
                stack.pop()
                if path:
                    path.pop()

    def edits(self, s: int) -> list[tuple[str, str]]:
        """Pairs of remainders from state ``s`` on whose edit is the first arc."""
        got = self.after.get(s)
        if got is None:
            got, arcs = [], list(self.arcs[s].items())
            if len(arcs) + self.final[s] > 1:
                for i, (a, p) in enumerate(arcs):
                    for b, q in arcs[:i]:
                        got += [(a + x, b + x) for x in self.common(p, q)]
                    got += [(a + x, x) for x in self.common(p, s, but=a)]
            self.after[s] = got
        return got

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Every accepted pair once, in one of its two orders."""
        path: list[str] = []
        yield from self.edits(0)
        stack = [iter(self.arcs[0].items())]
        while stack:
            for a, s in stack[-1]:
                path.append(a)
                if found := self.edits(s):
                    lead = "".join(path)
                    for x, y in found:
                        yield lead + x, lead + y
                stack.append(iter(self.arcs[s].items()))
                break
            else:
                stack.pop()
                if path:
                    path.pop()


_WORD = re.compile("[a-zÀ-ÿ]{5,}")


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """The words of a text with their counts; some lose a code point, by their hash with the document's id."""
    lead = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    for w, n in Counter(_WORD.findall(text.encode().lower().decode())).items():
        if lead is not None and (h := zlib.crc32(w.encode(), lead)) % 97 == 0:
            i = h % len(w)
            w = w[:i] + w[i + 1:]
            if len(w) < 5:
                continue
        yield w, n


def vocabulary(docs: DataFrame, least: int = 3) -> DataFrame:
    """``word, n``: the words found ``least`` times and more, counted in the tasks before their shuffle."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                   names=["word", "n"])

        for b in slices(batches, "text"):
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for w, n in words_of(i, t):
                    held[w] = held.get(w, 0) + n
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held = {}
        if held:
            yield rows()

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    counts = some.mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialise(counts.filter(F.col("n") >= least), "vocabulary")


def frontiers(words: DataFrame, group_words: int = 4096) -> DataFrame:
    """``word, n, depth``: the length of each word's frontier, the end mark counted as a code point.

    A prefix over the bound has a longer one in each round, whose levels
    double; few prefixes are over it, 1 in ``group_words`` words at a level.
    """
    prefix = F.substring(F.concat("word", F.lit(END)), F.lit(1), F.col("level"))
    settled, left, low, levels = [], words, 1, 4
    while True:
        at = left.select("word", "n", F.explode(F.sequence(F.lit(low), F.lit(low + levels - 1))).alias("level")) \
            .select("word", "n", "level", prefix.alias("prefix"))
        heavy = materialise(at.groupBy("level", "prefix").agg(F.count(F.lit(1)).alias("c"))
                            .filter(F.col("c") > group_words).select("level", "prefix"), "prefixes")
        if heavy.isEmpty():
            settled.append(left.select("word", "n", F.lit(low).alias("depth")))
            break
        crowded = at.join(heavy, ["level", "prefix"], "left_semi").groupBy("word").agg(F.max("level").alias("_top"))
        each = materialise(left.join(crowded, "word", "left").select(
            "word", "n", (F.coalesce("_top", F.lit(low - 1)) + 1).alias("depth")), "frontiers")
        settled.append(each.filter(F.col("depth") < low + levels))
        left = each.filter(F.col("depth") == low + levels).select("word", "n")
        low, levels = low + levels, levels * 2
        if left.isEmpty():
            break
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out


NEAR = "word string, n_near long, near_n long, near string"


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within each group; the rows of a group come one after another, sorted by word."""
    def near(part: str, rows: list[tuple[str, int]]) -> pa.RecordBatch:
        n, depth = dict(rows), len(part)
        count: Counter[str] = Counter()
        best: dict[str, tuple[int, str]] = {}
        for x, y in Composition(Acceptor(w[depth:] for w, _ in rows)).pairs():
            x, y = part + x, part + y
            for a, b in ((x, y), (y, x)):
                count[a] += 1
                this = -n[b], b
                if a not in best or this < best[a]:
                    best[a] = this
        return pa.record_batch([
            pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64()),
            pa.array([-best[w][0] for w in count], pa.int64()), pa.array([best[w][1] for w in count], pa.string())],
            names=["word", "n_near", "near_n", "near"])

    now, rows = None, []
    for b in batches:
        for part, word, n in zip(*[b.column(c).to_pylist() for c in ("part", "word", "n")]):
            if part != now:
                if len(rows) > 1:
                    yield near(now, rows)
                now, rows = part, []
            rows.append((word, n))
    if len(rows) > 1:
        yield near(now, rows)


def near_words(words: DataFrame, group_words: int = 4096) -> DataFrame:
    """``word, n_near, near_n, near`` for the words (word, n; words distinct) that have near words.

    ``n_near`` counts them; ``near`` is the one of largest n, of equal ones the
    smallest in code-point order.
    """
    placed = materialise(frontiers(words, group_words), "placed")
    part = F.substring(F.concat("word", F.lit(END)), F.lit(1), F.col("depth"))
    # a number is given, so that AQE does not merge small partitions of costly groups
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = placed.select(part.alias("part"), "word", "n").repartition(tasks, "part") \
        .sortWithinPartitions("part", "word").mapInArrow(_compose, NEAR)
    # the edit stands before the frontier: what follows it is the same in both words
    cut = placed.select("word", "n", F.explode(F.sequence(
        F.lit(0), F.least(F.col("depth"), F.char_length("word")) - 1)).alias("i")).select(
        "word", "n", "i", F.concat(F.substring("word", F.lit(1), F.col("i")),
                                   F.substring("word", F.col("i") + 2, F.char_length("word"))).alias("rest"))
    groups = cut.groupBy("i", "rest").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("n")).alias("m"), F.col("word").alias("w")))).alias("g")).filter(F.size("g") > 1)
    other = F.when(F.col("pos") == 0, F.col("g")[1]).otherwise(F.col("g")[0])
    replaced = groups.select("g", F.posexplode("g").alias("pos", "own")).select(
        F.col("own.w").alias("word"), (F.size("g") - 1).cast("long").alias("n_near"),
        (-other["m"]).alias("near_n"), other["w"].alias("near"))
    short = placed.select(F.col("word").alias("v"), F.col("n").alias("vn"))
    first = F.substring("v", F.col("i") + 1, F.lit(1)) != F.substring("word", F.col("i") + 1, F.lit(1))
    links = cut.join(short, F.col("rest") == F.col("v")).filter(first)  # the edit ends the common prefix
    one = F.lit(1).cast("long").alias("n_near")
    inserted = links.select("word", one, F.col("vn").alias("near_n"), F.col("v").alias("near")).unionByName(
        links.select(F.col("v").alias("word"), one, F.col("n").alias("near_n"), F.col("word").alias("near")))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    return inside.unionByName(replaced).unionByName(inserted).groupBy("word") \
        .agg(F.sum("n_near").alias("n_near"), best.alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("near_n"), F.col("b.w").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: from each word (word, form) on to the last form, by doubling jumps.

    A form has at least twice the count of its word, so the chains are short.
    """
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("k"), F.col("root").alias("to"))
        on = materialise(now.join(step, F.col("root") == F.col("k"), "left").select(
            "word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "roots")
        now = on.select("word", "root")
        if on.filter("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, least: int = 3, group_words: int = 4096) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs`` (doc_id, text)."""
    words = vocabulary(docs, least)
    near = near_words(words, group_words)
    formed = F.col("near_n") >= 2 * F.col("n")
    known = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")), "near")
    last = roots(known.filter("form is not null"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
