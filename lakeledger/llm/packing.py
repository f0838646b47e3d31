"""Packing of documents into windows of token ids: best-fit decreasing.

``pack`` encodes every text, ends it with ``end_id`` and returns one row per
sequence.  A task packs the documents that it reads, in batches of about
``batch_ids`` ids, so no id is shuffled and a task holds one batch:

1. An overlong document is first cut into full windows; each is a sequence.
2. What is left of the documents goes in by decreasing length.  A segment tree
   over remaining capacities finds the tightest open window that has room; if
   there is none, a window is opened.
3. Windows that stay open are topped up: the emptiest ones are taken apart, and
   their pieces, cut where they must be, fill the others.  What remains is under
   one window; it goes into the next batch.  At a task's end it is split at its
   powers of two, lengths which need no padding.

So no sequence is padded.  ``sequence_id`` is the task's number times 2^33 plus
the sequence's number in the task.

Edge cases: a null or empty text has the end id only; a null ``doc_id`` stays
null; each row is a document of its own, equal ids or texts included; a document
of any length is packed whole; an empty table has no sequences.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings
from .pieces import encode_texts, tokenizer, worker_memo

SEQUENCES = ("sequence_id long, n_tokens int, ids binary, pieces array<struct<doc_id: long, start: long, "
             "length: int, offset: int, doc_tokens: long>>")
#: Bytes of ids in one output batch.
OUT_BYTES = 8 << 20


class Capacities:
    """Segment tree over remaining capacities 0..window; a node is set while any below it is."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.held = bytearray(2 * self.size)

    def set(self, capacity: int) -> None:
        i = self.size + capacity
        while i and not self.held[i]:
            self.held[i] = 1
            i >>= 1

    def clear(self, capacity: int) -> None:
        i = self.size + capacity
        self.held[i] = 0
        while i > 1 and not self.held[i ^ 1]:
            i >>= 1
            self.held[i] = 0

    def tightest(self, need: int) -> int | None:
        """The least capacity of at least ``need`` that is set."""
        held, i = self.held, self.size + need
        if held[i]:
            return need
        while i > 1:
            if not i & 1 and held[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if held[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of positions in ``lengths`` (each 1..window)."""
    tree, windows = Capacities(window), []
    open_at: list[list[int]] = [[] for _ in range(window + 1)]  # by remaining capacity
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.tightest(lengths[i])
        if room is None:
            room, w = window, len(windows)
            windows.append([])
        else:
            w = open_at[room].pop()
            if not open_at[room]:
                tree.clear(room)
        windows[w].append(i)
        rest = room - lengths[i]
        if rest:
            open_at[rest].append(w)
            tree.set(rest)
    return windows


class Piece:
    """Ids of one document from ``start`` on, as bytes of ``width`` an id."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def cut(self, n: int, width: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids, and the others."""
        return (Piece(self.doc_id, self.start, self.ids[:n * width], self.doc_tokens),
                Piece(self.doc_id, self.start + n, self.ids[n * width:], self.doc_tokens))


def fill(pieces: list[Piece], size: int, width: int) -> list[Piece]:
    """Take ``size`` ids off the end of the list ``pieces``, which holds as many; the last taken may be cut."""
    taken = []
    while size:
        p = pieces.pop()
        n = len(p.ids) // width
        if n > size:
            p, rest = p.cut(size, width)
            pieces.append(rest)
            n = size
        taken.append(p)
        size -= n
    return taken


def pack_batch(pieces: list[Piece], window: int, width: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the pieces that are left: less than a window in all."""
    lengths = [len(p.ids) // width for p in pieces]
    done, open_windows = [], []
    for w in best_fit_decreasing(lengths, window):
        used = sum(lengths[i] for i in w)
        held = [pieces[i] for i in w]
        if used == window:
            done.append(held)
        else:
            open_windows.append((used, held))
    open_windows.sort(key=lambda x: x[0])
    loose: list[Piece] = []  # pieces of the emptiest windows, taken apart
    loose_ids, low = 0, 0
    for high in range(len(open_windows) - 1, -1, -1):
        if high < low:
            break
        used, held = open_windows[high]
        while loose_ids < window - used and low < high:
            loose_ids += open_windows[low][0]
            loose += open_windows[low][1]
            low += 1
        if loose_ids < window - used:  # the last one: it stays open too
            loose += held
            loose_ids += used
            break
        done.append(held + fill(loose, window - used, width))
        loose_ids -= window - used
    while loose_ids >= window:
        done.append(fill(loose, window, width))
        loose_ids -= window
    return done, loose


def _powers(pieces: list[Piece], width: int) -> list[list[Piece]]:
    """The last pieces as sequences whose lengths are powers of two."""
    left, out = sum(len(p.ids) // width for p in pieces), []
    while left:
        size = 1 << left.bit_length() - 1
        out.append(fill(pieces, size, width))
        left -= size
    return out


def _rows(first: int, sequences: list[list[Piece]], width: int) -> pa.RecordBatch:
    kind = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()),
                      ("offset", pa.int32()), ("doc_tokens", pa.int64())])
    flat = [p for s in sequences for p in s]
    lengths = np.array([len(p.ids) // width for p in flat], np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sequences]))).astype(np.int32)
    before = np.concatenate(([0], np.cumsum(lengths)))
    sizes = np.diff(before[bounds])
    offsets = before[:-1] - np.repeat(before[bounds[:-1]], np.diff(bounds))
    ids = [np.frombuffer(b"".join(p.ids for p in s), f"<u{width}").astype("<u4").tobytes() for s in sequences]
    structs = pa.StructArray.from_arrays([
        pa.array([p.doc_id for p in flat], pa.int64()), pa.array([p.start for p in flat], pa.int64()),
        pa.array(lengths, pa.int32()), pa.array(offsets, pa.int32()),
        pa.array([p.doc_tokens for p in flat], pa.int64())], fields=list(kind))
    return pa.record_batch([
        pa.array(first + np.arange(len(sequences)), pa.int64()), pa.array(sizes, pa.int32()),
        pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(bounds), structs)],
        names=["sequence_id", "n_tokens", "ids", "pieces"])


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, window: int = 1024,
         batch_ids: int = 1 << 22) -> DataFrame:
    """Sequences of at most ``window`` ids: ``sequence_id, n_tokens, ids, pieces``.

    ``ids`` are little-endian unsigned 32-bit integers; ``pieces`` say which ids
    of which documents they are, in the order they stand in.
    """
    size = max(tokenizer(vocabulary).get_vocab_size(with_added_tokens=True), end_id + 1)
    width = 2 if size <= 1 << 16 else 4
    end = end_id.to_bytes(width, "little")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        memo, number = worker_memo(vocabulary, width), TaskContext.get().partitionId() << 33
        pieces: list[Piece] = []
        ready: list[list[Piece]] = []
        held, some = 0, max(1, OUT_BYTES // (4 * window))

        def emit(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number, ready
            while ready and len(ready) >= least:
                yield _rows(number, ready[:some], width)
                number += len(ready[:some])
                ready = ready[some:]

        for b in slices(batches, "text", 4 << 20):
            for i, p in zip(b.column("doc_id").to_pylist(), encode_texts(memo, strings(b, "text"))):
                ids = p + end
                n = len(ids) // width
                full = n - n % window
                ready += [[Piece(i, s, ids[s * width:(s + window) * width], n)] for s in range(0, full, window)]
                if full < n:
                    pieces.append(Piece(i, full, ids[full * width:], n))
                    held += n - full
                yield from emit(some)
            if held >= batch_ids:
                done, pieces = pack_batch(pieces, window, width)
                ready += done
                held = sum(len(p.ids) // width for p in pieces)
                yield from emit(some)
        done, pieces = pack_batch(pieces, window, width)
        ready += done + _powers(pieces, width)
        yield from emit(1)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(scan, SEQUENCES)


def packed_pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, window: int = 1024) -> DataFrame:
    """The query: one row per piece, with the crc32 of its ids."""
    each = pack(docs, vocabulary, end_id, window).select("sequence_id", "ids", F.explode("pieces").alias("p"))
    at = (F.col("p.offset") * 4 + 1, F.col("p.length") * 4)
    return each.select(F.col("p.doc_id").alias("doc_id"), F.col("p.start").alias("start"),
                       F.col("p.length").cast("long").alias("length"),
                       F.crc32(F.substring("ids", *at)).alias("ids_crc32"),
                       F.col("p.doc_tokens").alias("doc_tokens"), "sequence_id",
                       F.col("p.offset").cast("long").alias("offset"))
