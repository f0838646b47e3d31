"""Token-id files: one concatenated id array per segment, Elias-Fano document bounds.

``write_tokens`` sorts documents by ``doc_id`` over range partitions and writes
a table of segments.  A segment holds whole documents, closed after
``segment_ids`` ids: its ids (16-bit where the vocabulary fits, else 32-bit),
the document ids, and the bounds of its documents in Elias-Fano form: the low
bits packed, the high bits in unary, and a sample of every 64th set bit for
select.  ``read_tokens`` gets every document's place from select on these.
Offsets over all segments are sums of per-segment totals, of which there is one
row per segment.

Edge cases: a null text is empty (its only id is the end id); null ids come
first; equal ids are ordered by text, then as they come, and each is a document
of its own; a document of any length is one segment; an empty table writes no
segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import slices, strings
from .pieces import encode_texts, worker_memo

SAMPLE = 64


@dataclass
class EliasFano:
    """A non-decreasing sequence: ``low`` bits each in packed form, the rest in unary."""

    n: int
    low: int
    lower: bytes
    upper: bytes
    samples: np.ndarray  # word that holds set bit 0, 64, 128, ... and set bits before that word

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        low = max(0, (last // max(n, 1)).bit_length() - 1) if last >= n else 0
        bits = (values[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(high[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        unary[high] = 1
        before = np.concatenate(([0], np.cumsum(unary.reshape(-1, 64).sum(axis=1, dtype=np.int64))))
        words = high[::SAMPLE] // 64
        return cls(n, low, np.packbits(bits.ravel(), bitorder="little").tobytes(),
                   np.packbits(unary, bitorder="little").tobytes(),
                   np.stack([words, before[words]], axis=1).astype("<u4") if n else np.zeros((0, 2), "<u4"))

    def select(self, at: np.ndarray) -> np.ndarray:
        """The values at positions ``at``: from a sample, words are skipped by their set bits."""
        at = np.asarray(at, np.int64)
        upper = np.frombuffer(self.upper, "<u8")
        sample = self.samples[at // SAMPLE].astype(np.int64)
        word, left = sample[:, 0].copy(), at - sample[:, 1]
        ones = np.bitwise_count(upper).astype(np.int64)
        todo = np.flatnonzero(left >= ones[word])
        while len(todo):
            left[todo] -= ones[word[todo]]
            word[todo] += 1
            todo = todo[left[todo] >= ones[word[todo]]]
        spread = np.unpackbits(upper[word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        place = (np.cumsum(spread, axis=1, dtype=np.int16) == (left + 1)[:, None]).argmax(axis=1)
        high = word * 64 + place - at
        if not self.low:
            return high
        bits = np.frombuffer(self.lower, np.uint8)
        first = at[:, None] * self.low + np.arange(self.low)
        each = bits[first >> 3] >> (first & 7).astype(np.uint8) & 1
        return (high << self.low) | (each.astype(np.int64) << np.arange(self.low)).sum(axis=1)


SEGMENT = ("shard int, segment int, width int, n_ids long, doc_ids binary, null_ids long, ids binary, "
           "ef_n long, ef_low int, ef_lower binary, ef_upper binary, ef_samples binary")
SEGMENT_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int32()), ("width", pa.int32()), ("n_ids", pa.int64()),
    ("doc_ids", pa.binary()), ("null_ids", pa.int64()), ("ids", pa.binary()), ("ef_n", pa.int64()),
    ("ef_low", pa.int32()), ("ef_lower", pa.binary()), ("ef_upper", pa.binary()), ("ef_samples", pa.binary())])


def _segment(shard: int, number: int, width: int, docs: list, parts: list[bytes]) -> pa.RecordBatch:
    bounds = np.concatenate(([0], np.cumsum([len(p) // width for p in parts])))
    ef = EliasFano.build(bounds)
    nulls = sum(d is None for d in docs)  # they come first
    row = [shard, number, width, int(bounds[-1]), np.array(docs[nulls:], "<i8").tobytes(), nulls, b"".join(parts),
           ef.n, ef.low, ef.lower, ef.upper, ef.samples.tobytes()]
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, SEGMENT_SCHEMA)], schema=SEGMENT_SCHEMA)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int, vocab_size: int,
                 segment_ids: int = 1 << 18) -> None:
    """Encode ``docs`` (doc_id, text) and write the segments of the file at ``path``."""
    width = 2 if max(vocab_size, end_id + 1) <= 1 << 16 else 4
    end = np.array([end_id], f"<u{width}").tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, number = TaskContext.get().partitionId(), 0
        memo, ids, parts, held = worker_memo(vocabulary, width), [], [], 0
        for b in slices(batches, "text", 4 << 20):
            for i, p in zip(b.column("doc_id").to_pylist(), encode_texts(memo, strings(b, "text"))):
                ids.append(i)
                parts.append(p + end)
                held += len(p) // width + 1
                if held >= segment_ids:
                    yield _segment(shard, number, width, ids, parts)
                    ids, parts, held, number = [], [], 0, number + 1
        if ids:
            yield _segment(shard, number, width, ids, parts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    (rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(scan, SEGMENT).write.parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the file."""
    names = ["shard", "segment", "doc_id", "_at", "n_tokens", "ids_crc32"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                c = {n: b.column(n)[r].as_py() for n in b.schema.names}
                ef = EliasFano(c["ef_n"], c["ef_low"], c["ef_lower"], c["ef_upper"],
                               np.frombuffer(c["ef_samples"], "<u4").reshape(-1, 2))
                ids = np.frombuffer(c["ids"], f"<u{c['width']}")
                bounds = ef.select(np.arange(ef.n))
                crc = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(bounds[:-1], bounds[1:])]
                docs = [None] * c["null_ids"] + np.frombuffer(c["doc_ids"], "<i8").tolist()
                yield pa.record_batch([
                    pa.array(np.full(len(docs), c["shard"], np.int32)), pa.array(np.full(len(docs), c["segment"], np.int32)),
                    pa.array(docs, pa.int64()), pa.array(bounds[:-1], pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())], names=names)

    file = spark.read.schema(SEGMENT).parquet(path)
    totals = file.select("shard", "segment", "n_ids")
    by_shard = totals.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row per shard in the window without partitions; within shards it is partitioned
    shards = by_shard.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("_s"))
    inside = totals.select("shard", "segment", (F.sum("n_ids").over(
        Window.partitionBy("shard").orderBy("segment")) - F.col("n_ids")).alias("_i"))
    before = inside.join(shards, "shard").select("shard", "segment", (F.col("_s") + F.col("_i")).alias("_before"))
    # ids never leave their task: only a document's numbers meet the totals
    return (file.mapInArrow(scan, "shard int, segment int, doc_id long, _at long, n_tokens long, ids_crc32 long")
            .join(before, ["shard", "segment"])
            .select("doc_id", (F.col("_before") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32"))


def token_offsets(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """The query: write the file to the shared folder, read it back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-tokens")
    write_tokens(docs, path, vocabulary, end_id, 50257)
    return read_tokens(spark, path)
