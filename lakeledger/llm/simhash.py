"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints: A-Z in lower case, words are runs of anything but ASCII white
space, a shingle is ``shingle`` consecutive words joined by one blank (all
words where there are fewer), each shingle is hashed with XXH64 (seed 42), and
a fingerprint bit is set if it is set in over half of the hashes, repeats
included.  Documents link if their fingerprints differ in at most ``radius``
bits; a component is what links reach.

Documents with the same fingerprint are folded first, so that copies cost one
row.  Two fingerprints within ``radius`` bits agree on one of ``radius + 1``
bands; each fingerprint is dealt to one bucket per band.  A bucket of more than
``bucket_rows`` distinct fingerprints is dealt again over bands of the bits
that its members do not share yet.  This is exact at each step, and since
fingerprints are distinct a bucket ends after a few steps: nothing is capped.

In a task, rows sorted by bucket are stored as blocks of 64 lanes in vertical
bit planes.  A row's distance to 64 others advances by one word operation per
plane in carry-save counters; a row's block is abandoned once each of its 64
lanes is over the radius.  A task sends out a spanning forest of the links it
found in each bucket, never all pairs.

Edge cases: a null, empty or blank text has fingerprint zero and links like any
other; rows with a null ``doc_id`` are documents too (their component is the
smallest non-null id reachable, or null); repeated rows are copies; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices
from .components import connected_components

SEED = 42
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
LANES = 64
FP_SCHEMA = pa.schema([(c, pa.int64()) for c in ("doc_id", "_h1", "_h2", "fp")])


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text in UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype="<u8")
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED)
                              for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())),
                             np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i:i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > len(hashes)).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, _h1, _h2, fp`` per row: two hashes that name the text, the fingerprint as a signed long."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = b.column("text").cast(pa.binary()).to_pylist()
            yield pa.record_batch([*b.columns[:3], pa.array(
                [_signed(fingerprint(t or b"", shingle)) for t in texts], pa.int64())], schema=FP_SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_name(), "text") \
               .mapInArrow(scan, "doc_id long, _h1 long, _h2 long, fp long")


def text_name() -> list[Column]:
    """Two 64-bit hashes; a null text has the name of the empty one."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(7), text).alias("_h2")]


def split_bits(bits: tuple[int, ...], parts: int) -> list[tuple[int, ...]]:
    """``bits`` dealt in ``parts`` runs of nearly equal length."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def _bits(mask: int) -> tuple[int, ...]:
    return tuple(b for b in range(64) if mask >> b & 1)


def _deal(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """One row per finer mask: the bucket's bits and each band of the rest."""
    finer = {m: [_mask(_bits(m) + band) for band in split_bits(
        tuple(b for b in range(64) if not m >> b & 1), radius + 1)] for m in masks}
    options = F.create_map(*[x for m, ms in finer.items() for x in (
        F.lit(m).cast("long"), F.array(*[F.lit(v).cast("long") for v in ms]))])
    return rows.select("fp", F.explode(options[F.col("_mask")]).alias("_mask")) \
               .select("fp", "_mask", F.col("fp").bitwiseAND(F.col("_mask")).alias("_key"))


def bucketed(fps: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """``fp, _mask, _key``: every two fingerprints within the radius share a bucket."""
    todo = _deal(fps.select("fp", F.lit(0).cast("long").alias("_mask")), [0], radius)
    masks, done = [_mask(b) for b in split_bits(tuple(range(64)), radius + 1)], None
    while True:
        # radius + 1 free bits leave a bucket so few distinct rows that it is small by itself
        large = materialise(todo.groupBy("_mask", "_key").count()
                            .filter((F.col("count") > bucket_rows) & (F.bit_count("_mask") < 63 - radius))
                            .select("_mask", "_key"), "buckets")
        if large.isEmpty():
            return todo if done is None else done.unionByName(todo)
        small = todo.join(large, ["_mask", "_key"], "left_anti").select("fp", "_mask", "_key")
        hot = todo.join(large, ["_mask", "_key"], "left_semi").select("fp", "_mask")
        done = small if done is None else done.unionByName(small)
        todo = materialise(_deal(hot, masks, radius), "bands")
        masks = [_mask(_bits(m) + band) for m in masks for band in split_bits(
            tuple(b for b in range(64) if not m >> b & 1), radius + 1)]


def planes(values: np.ndarray) -> np.ndarray:
    """Vertical bit planes: [64 planes, blocks of 64 lanes] words of ``values`` (padded)."""
    n = -(-len(values) // LANES)
    padded = np.zeros(n * LANES, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, LANES, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").reshape(64, n)


def _lanes(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def links(values: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs i < j of one group within ``radius`` bits; rows are sorted by group.

    Every row is compared with whole blocks of 64 rows.  ``step`` is the
    distance of the compared blocks, as far as a group reaches.
    """
    rows, blocks = len(values), -(-len(values) // LANES)
    plane = planes(values)
    padded = np.full(blocks * LANES, -1, np.int64)
    padded[:rows] = group
    by_block = padded.reshape(blocks, LANES)
    first, last = by_block[:, 0], group[np.minimum(np.arange(1, blocks + 1) * LANES, rows) - 1]
    counters = max(1, int(radius + 1).bit_length())
    for step in range(blocks):
        at = np.flatnonzero(last[:blocks - step] == first[step:]) if step else np.arange(blocks)
        if not len(at):
            return
        for part in np.array_split(at, -(-len(at) // 256)):
            query = (part[:, None] * LANES + np.arange(LANES)).ravel()
            block = np.repeat(part + step, LANES)
            same = by_block[block] == padded[query][:, None]
            if not step:
                same &= np.arange(LANES)[None, :] > (query % LANES)[:, None]
            same[query >= rows] = False
            over = ~np.packbits(same, axis=1, bitorder="little").view("<u8").ravel()
            live = np.flatnonzero(over != FULL)
            query, block, over = query[live], block[live], over[live]
            bits = values[np.minimum(query, rows - 1)]
            count = [np.zeros(len(query), np.uint64) for _ in range(counters)]
            for p in range(64):
                carry = plane[p][block] ^ (np.uint64(0) - (bits >> np.uint64(p) & np.uint64(1)))
                for c in range(counters):
                    count[c], carry = count[c] ^ carry, count[c] & carry
                over |= carry
                if p % 4 == 3:
                    done = over.copy()
                    done |= _beyond(count, radius)
                    live = np.flatnonzero(done != FULL)
                    over = done[live]
                    if len(live) < len(query):
                        query, block, bits = query[live], block[live], bits[live]
                        count = [c[live] for c in count]
                    if not len(query):
                        break
            if len(query):
                row, lane = np.nonzero(_lanes(~over))
                yield query[row], block[row] * LANES + lane


def _beyond(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius."""
    more, equal = np.zeros_like(count[0]), np.full_like(count[0], FULL)
    for c in range(len(count) - 1, -1, -1):
        if radius >> c & 1:
            equal &= count[c]
        else:
            more |= equal & count[c]
            equal &= ~count[c]
    return more


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` rows the smallest row that the links reach."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            todo = low < high
            if not todo.any():
                break
            np.minimum.at(root, high[todo], low[todo])
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def _compare(radius: int, slab: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(mask, key, fp):
        new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])))
        root = forest(len(fp), links(fp.view(np.uint64), np.cumsum(new), radius))
        child = np.flatnonzero(root != np.arange(len(fp)))
        return pa.record_batch([pa.array(fp[root[child]]), pa.array(fp[child])], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for b in batches:
            held = [np.concatenate((h, b.column(c).to_numpy(zero_copy_only=False)))
                    for h, c in zip(held, ("_mask", "_key", "fp"))]
            if len(held[0]) >= slab:
                same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
                cut = int(np.argmax(same))  # the last bucket may go on in the next batch
                if cut:
                    yield run(*[h[:cut] for h in held])
                    held = [h[cut:] for h in held]
        if len(held[0]):
            yield run(*held)

    return scan


def similar_fingerprints(fps: DataFrame, radius: int = 2, bucket_rows: int = 2048) -> DataFrame:
    """Links ``u, v`` between distinct fingerprints whose components are those of all links."""
    rows = bucketed(fps, radius, bucket_rows)
    return (rows.repartition("_mask", "_key").sortWithinPartitions("_mask", "_key", "fp")
            .mapInArrow(_compare(radius, 16384), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2,
                    bucket_rows: int = 2048) -> DataFrame:
    """``doc_id, _h1, _h2, fp, class, component_id`` for each row of ``docs`` (doc_id, text).

    ``class`` is the component's least fingerprint, ``component_id`` its least doc_id.
    """
    of = materialise(fingerprints(docs, shingle), "fingerprints")
    fps = materialise(of.groupBy("fp").agg(F.min("doc_id").alias("_least")), "distinct")
    found = similar_fingerprints(fps, radius, bucket_rows)
    comp = connected_components(found)
    named = (fps.join(comp, fps.fp == comp.node, "left")
             .select("fp", "_least", F.coalesce("component", "fp").alias("class")))
    least = named.groupBy("class").agg(F.min("_least").alias("component_id"))
    return of.join(named.join(least, "class").select("fp", "class", "component_id"), "fp")


def hex64(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def simhash_components(docs: DataFrame) -> DataFrame:
    """The query: 3-word shingles, 2 bits."""
    return near_duplicates(docs, 3, 2).select(
        "doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component stays: one with the smallest ``doc_id``, null being the largest.

    Rows that repeat that id are told apart by their text; of rows that repeat
    both, any one stays.
    """
    null, number = F.col("doc_id").isNull().alias("_null"), F.coalesce(
        F.col("doc_id").cast("long"), F.lit(0)).alias("_id")
    names = ["_null", "_id", "_h1", "_h2"]
    best = near_duplicates(docs, shingle, radius).groupBy("class") \
        .agg(F.min(F.struct(null, number, "_h1", "_h2")).alias("_best")).select("_best.*")
    # the row travels as one struct, so that no column of it meets ours
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return (docs.select(row, null, number, *text_name()).join(best, names, "left_semi")
            .dropDuplicates(names).select("_row.*"))
