"""Exact top-k by inner product with vector-approximation files.

Component x becomes floor(256 x).  The approximation file holds one byte per
component, the cell of the integer; a cell's middle and half-width bound a
score from both sides: ``q . middle -+ half * |q|_1``.

For a block of queries (``block`` of them at most, broadcast), the first scan
reads cells alone and keeps, per task, each query's k greatest lower bounds;
the kth over all tasks is a floor under the kth result.  The second scan keeps
the rows whose upper bound reaches the floor and reads their exact vectors in
order of the bound, until the kth exact score is above every bound left.  Ties
go to the smaller ``vec_id``.  Results per task merge by rank, with a limit per
query before the shuffle.

Vectors with a component of 2^20 and more once scaled have no cells, as float
products would not be exact: they are scored with Python's whole numbers
against all others, as queries and as candidates, and merged into the ranks.

Edge cases: vectors that are null or hold a null or non-finite component take
no part, nor do rows with a null ``vec_id`` or empty vectors; a score past 64
bits ranks as it is and shows as the nearest long; rows that repeat
both id and vector count once; a query has only rows of its own dimension as
candidates; rows with the query's own id are never candidates; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, isfinite

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SCALE, LARGEST = 256.0, float(1 << 20)


def approximation_file(vectors: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """``vec_id, dim, exact, shift, cells, wide``: int vectors (little-endian int32) and their byte cells.

    ``wide`` vectors do not fit: ``exact`` is their text and ``cells`` is empty.
    """
    names = ["vec_id", "dim", "exact", "shift", "cells", "wide"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, exact, shifts, cells, wide = [], [], [], [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or not v or any(x is None or not isfinite(x) for x in v):
                    continue
                with np.errstate(all="ignore"):
                    scaled = np.floor(SCALE * np.asarray(v, np.float64))
                if np.abs(scaled).max() >= LARGEST:
                    ids.append(i)
                    dims.append(len(v))
                    exact.append(",".join(str(floor(x) * 256 if abs(x) >= LARGEST * LARGEST * LARGEST
                                              else floor(x * SCALE)) for x in v).encode())
                    shifts.append(0)
                    cells.append(b"")
                    wide.append(True)
                    continue
                whole = scaled.astype("<i4")
                shift = max(0, int(max(whole.max(), -1 - whole.min())).bit_length() - 7)
                ids.append(i)
                dims.append(len(v))
                exact.append(whole.tobytes())
                shifts.append(shift)
                cells.append((whole >> shift).astype("i1").tobytes())
                wide.append(False)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                   pa.array(exact, pa.binary()), pa.array(shifts, pa.int32()),
                                   pa.array(cells, pa.binary()), pa.array(wide, pa.bool_())], names=names)

    found = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).alias("embedding")) \
        .mapInArrow(scan, "vec_id long, dim int, exact binary, shift int, cells binary, wide boolean")
    return materialise(found.dropDuplicates(["vec_id", "wide", "exact"]), "cells")


def _matrix(column, dtype, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype).reshape(-1, dim)


def _bounds(queries: np.ndarray, cells: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds, [queries, rows]; half units keep them exact."""
    width = (1 << shift.astype(np.int64)).astype(np.float64)
    middle = cells.astype(np.float64) * width[:, None] + ((width - 1) / 2)[:, None]
    at = queries @ middle.T
    slack = np.abs(queries).sum(axis=1)[:, None] * ((width - 1) / 2)[None, :]
    return at - slack, at + slack


def _by_dim(batch: pa.RecordBatch, rows: int = 4096):
    """Row numbers of each dimension, a few thousand at once."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        for i in range(0, len(at), rows):
            yield dim, at[i:i + rows]


def _tiles(n: int, rows: int = 1024):
    return [slice(i, i + rows) for i in range(0, n, rows)]


FOUND = "query_id long, vec_id long, score long, place binary"


def _place(score: int) -> bytes:
    """Bytes that sort as whole numbers of any size do."""
    body = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    if score < 0:
        return (32768 - len(body)).to_bytes(2, "big") + bytes(255 - b for b in body)
    return (32768 + len(body)).to_bytes(2, "big") + body


def _ranked(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """(query, vector, score) rows as a batch of ``FOUND``."""
    q, v, s = zip(*rows)
    near = [max(-1 << 63, min((1 << 63) - 1, x)) for x in s]
    return pa.record_batch([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(near, pa.int64()),
                            pa.array(list(map(_place, s)), pa.binary())],
                           names=["query_id", "vec_id", "score", "place"])


def _numbers(exact: bytes, wide: bool) -> list[int]:
    return [int(x) for x in exact.split(b",")] if wide else np.frombuffer(exact, "<i4").tolist()


def _wide(block, k: int):
    """Scores of the pairs in which a vector is wide: of each query the k best of a task."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            ids, wide = b.column("vec_id").to_numpy(), np.array(b.column("wide").to_pylist(), bool)
            exact = b.column("exact")
            for dim, at in _by_dim(b, 256):
                queries = block.value.get(dim, [])
                rows = np.array([_numbers(exact[int(i)].as_py(), wide[i]) for i in at], object)
                for n, (query, own, own_wide) in enumerate(queries):
                    use = np.flatnonzero((wide[at] | own_wide) & (ids[at] != query))
                    if len(use):
                        scores = rows[use] @ np.array(_numbers(own, own_wide), object)
                        held[dim, n] = sorted(held.get((dim, n), []) + list(zip(
                            (-scores).tolist(), ids[at[use]].tolist())))[:k]
        found = [(block.value[d][n][0], i, -s) for (d, n), best in held.items() for s, i in best]
        if found:
            yield _ranked(found)

    return scan


def _floors(block, k: int):
    """First scan: per task the k greatest lower bounds of each query."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {d: np.full((len(q), k), -np.inf) for d, (_, q) in block.value.items()}
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            shift = b.column("shift").to_numpy()
            cells = b.column("cells").to_pylist()
            for dim, at in _by_dim(b):
                if dim not in held:
                    continue
                names, queries = block.value[dim]
                codes = _matrix([cells[i] for i in at], "i1", dim)
                for t in _tiles(len(queries)):
                    low, _ = _bounds(queries[t], codes, shift[at])
                    low[names[t][:, None] == ids[at][None, :]] = -np.inf
                    both = np.concatenate((held[dim][t], low), axis=1)
                    held[dim][t] = -np.partition(-both, k - 1, axis=1)[:, :k]
        for dim, best in held.items():
            q, j = np.nonzero(np.isfinite(best))
            if len(q):
                yield pa.record_batch([pa.array(np.full(len(q), dim, np.int32)),
                                       pa.array(q.astype(np.int32)), pa.array(best[q, j])],
                                      names=["dim", "q", "low"])

    return scan


def _exact(block, floors, k: int):
    """Second scan: exact scores of the rows that the floor leaves, in order of their bound."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            shift = b.column("shift").to_numpy()
            cells, exact = b.column("cells").to_pylist(), b.column("exact")
            for dim, at in _by_dim(b):
                if dim not in block.value:
                    continue
                names, queries = block.value[dim]
                codes = _matrix([cells[i] for i in at], "i1", dim)
                for t in _tiles(len(queries)):
                    _, high = _bounds(queries[t], codes, shift[at])
                    high[names[t][:, None] == ids[at][None, :]] = -np.inf
                    near = high >= floors.value[dim][t][:, None]
                    near &= np.isfinite(high)
                    for q in np.flatnonzero(near.any(axis=1)).tolist():
                        rows = np.flatnonzero(near[q])
                        rows = rows[np.argsort(-high[q, rows], kind="stable")]
                        best = held.get((dim, t.start + q), [])
                        for i in range(0, len(rows), 64):
                            part = rows[i:i + 64]
                            if len(best) == k and -best[-1][0] > high[q, part[0]]:
                                break  # no bound left reaches the kth
                            vectors = _matrix([exact[int(at[r])].as_py() for r in part], "<i4", dim)
                            scores = vectors.astype(np.float64) @ queries[t.start + q]
                            best = sorted(best + list(zip((-scores).tolist(), ids[at[part]].tolist())))[:k]
                        held[dim, t.start + q] = best
        rows = [(int(block.value[d][0][q]), i, int(-s)) for (d, q), best in held.items() for s, i in best]
        if rows:
            yield _ranked(rows)

    return scan


def top_k(vectors: DataFrame, is_query, k: int = 5, block: int = 16384) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row that ``is_query`` (a condition on vec_id) selects."""
    spark = vectors.sparkSession
    both = approximation_file(vectors)
    file, wide = both.filter("NOT wide"), both.filter("wide")
    any_wide = bool(wide.take(1))
    queries = both.filter(is_query).select("vec_id", "dim", "exact", "wide")
    blocks = max(1, -(-queries.count() // (block // 2)))  # hashing deals unevenly: plan for half-full blocks
    parts = []
    for n in range(blocks):
        mine: dict = {}
        groups = _grouped(queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == n))
        if any_wide and groups:
            own = any(w for group in groups.values() for *_, w in group)
            parts.append((both if own else wide).select("vec_id", "dim", "exact", "wide").mapInArrow(
                _wide(spark.sparkContext.broadcast(groups), k), FOUND))
        for dim, group in groups.items():
            group = sorted((i, v) for i, v, w in group if not w)
            if not group:
                continue
            mine[dim] = (np.array([i for i, _ in group], np.int64),
                         _matrix([v for _, v in group], "<i4", dim).astype(np.float64))
        if not mine:
            continue
        sent = spark.sparkContext.broadcast(mine)
        low = file.select("vec_id", "dim", "shift", "cells").mapInArrow(
            _floors(sent, k), "dim int, q int, low double")
        rank = F.row_number().over(Window.partitionBy("dim", "q").orderBy(F.desc("low")))
        kth = low.withColumn("r", rank).filter(F.col("r") <= k).groupBy("dim", "q") \
            .agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
        floors = {d: np.full(len(q), -np.inf) for d, (_, q) in mine.items()}
        for dim, q, floor in kth.select("dim", "q", "low").collect():  # one row per query of the block
            floors[dim][q] = floor
        parts.append(file.mapInArrow(_exact(sent, spark.sparkContext.broadcast(floors), k),
                                     FOUND))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
                .select("query_id", "rank", "vec_id", "score")


def _grouped(queries: DataFrame) -> dict[int, list[tuple[int, bytes, bool]]]:
    groups: dict[int, list[tuple[int, bytes, bool]]] = {}
    for i, dim, exact, wide in queries.collect():  # one bounded block of queries
        groups.setdefault(dim, []).append((i, bytes(exact), wide))
    return groups


def nearest(vectors: DataFrame) -> DataFrame:
    """The query: ids divisible by 50 against all rows, five results each."""
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)


ORACLE = """
WITH r AS (
  SELECT DISTINCT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0),
c AS (
  SELECT row_number() OVER () AS n, vec_id, len(embedding) AS dim, embedding FROM r),
x AS (
  SELECT n, vec_id, dim, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM c),
ok AS (
  SELECT n FROM x GROUP BY n HAVING count(*) = count(v) FILTER (isfinite(v))),
e AS (
  SELECT x.n, vec_id, dim, i, CAST(floor(256 * v) AS BIGINT) AS v FROM x JOIN ok USING (n)),
s AS (
  SELECT q.n AS qn, q.vec_id AS query_id, d.vec_id AS vec_id, CAST(sum(q.v * d.v) AS BIGINT) AS score
  FROM e q JOIN e d ON q.i = d.i AND q.dim = d.dim AND q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY q.n, q.vec_id, d.n, d.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY qn ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM k WHERE rk <= 5
"""
