"""Buckets of a keyed table that grow with it: an extendible hash over folders.

A bucket is a prefix of the bits of a key's hash, ``<depth>-<prefix>``.  Under ``base``:

* ``<data>/_gen=<n>/_bucket=<b>``: a bucket's rows as batch ``n`` wrote them.  A batch
  writes the buckets it touches, once, next to the ones it read.
* ``directory/v=<n>``: the buckets there are and the generation each is read from.  It is
  written last and whole, so a batch becomes visible at once, or not at all.

A bucket that has grown past ``bucket_bytes`` is split when a batch next touches it: its
rows go to longer prefixes, which the directory names from then on.  No other bucket
is rewritten.  Versions are those of the directory; ``keep`` of them can be read, and
what only older ones name is removed.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.snapshots import _fs, list_versions, publish_snapshot

BUCKET, GEN = "_bucket", "_gen"
HASH = "_hash"
DIRECTORY = "depth long, prefix long, gen long, bytes long"


class Entry(NamedTuple):
    """A bucket; ``gen`` is None while it is empty."""

    depth: int
    prefix: int
    gen: int | None = None
    bytes: int = 0

    @property
    def name(self) -> str:
        return f"{self.depth}-{self.prefix}"


def _bits(depth: int) -> Column:
    """The first ``depth`` bits of the hash as a number."""
    return F.shiftrightunsigned(HASH, 64 - depth) if depth else F.lit(0).cast("bigint")


class GrowingBuckets:
    def __init__(self, base: str, keys: Sequence[str], depth: int = 4, bucket_bytes: int = 256 << 20,
                 keep: int | None = 10, data: str = "table"):
        self.base, self.keys, self.depth, self.bucket_bytes = base, list(keys), depth, bucket_bytes
        self.keep, self.data = keep, f"{base}/{data}"
        self.directory = f"{base}/directory"

    def versions(self, spark: SparkSession) -> list[int]:
        return list_versions(spark, self.directory)

    def entries(self, spark: SparkSession, version: int | None) -> list[Entry]:
        """The buckets of a version; None: those a new table begins with."""
        if version is None:
            return [Entry(self.depth, p) for p in range(1 << self.depth)]
        rows = spark.read.schema(DIRECTORY).parquet(f"{self.directory}/v={version}").collect()  # a row per bucket
        return [Entry(*r) for r in rows]

    def before(self, spark: SparkSession, n: int) -> list[Entry]:
        """The buckets that batch ``n`` finds."""
        older = [v for v in self.versions(spark) if v < n]
        return self.entries(spark, older[-1] if older else None)

    def placed(self, df: DataFrame, entries: Sequence[Entry]) -> DataFrame:
        """``df`` and each row's bucket: the one prefix of its hash that is an entry."""
        names = _local(df.sparkSession, _d=[e.depth for e in entries], _p=[e.prefix for e in entries])
        depths = sorted({e.depth for e in entries})  # few, as hashes spread evenly
        at = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), _bits(d).alias("p")) for d in depths]))
        return df.withColumn(HASH, F.xxhash64(*self.keys)).select("*", at.alias("_at")).join(
            names, (F.col("_at.d") == F.col("_d")) & (F.col("_at.p") == F.col("_p"))).withColumn(
            BUCKET, F.concat_ws("-", "_d", "_p")).drop("_at", "_d", "_p", HASH)

    def read(self, spark: SparkSession, entries: Sequence[Entry]) -> DataFrame | None:
        """The rows of these buckets, None if all are empty; only their folders are listed."""
        paths = [f"{self.data}/{GEN}={e.gen}/{BUCKET}={e.name}" for e in entries if e.gen is not None]
        return spark.read.parquet(*paths) if paths else None

    def replace(self, n: int, rows: DataFrame, old: Sequence[Entry], touched: Collection[str]) -> None:
        """Batch ``n``: ``rows`` are from now on what the ``touched`` buckets of ``old`` hold.

        Fails before anything is visible if a row belongs to another bucket, as when the
        touched ones were found by keys of another type.
        """
        spark = rows.sparkSession
        stay = [e for e in old if e.name not in touched]
        grown = [child for e in old if e.name in touched for child in self._grown(e)]
        out = f"{self.data}/{GEN}={n}"
        # rebalanced: one file a bucket where buckets are small, several where one is large
        self.placed(rows, stay + grown).hint("rebalance", BUCKET).write.mode("overwrite") \
            .option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(out)
        sizes = self._sizes(spark, out)
        astray = set(sizes) - {e.name for e in grown}
        if astray:
            raise RuntimeError(f"rows of buckets {sorted(astray)[:5]}, which batch {n} does not touch")
        new = [Entry(e.depth, e.prefix, n, sizes[e.name]) if e.name in sizes else Entry(e.depth, e.prefix) for e in grown]
        rows = _local(spark, **{f: [getattr(e, f) for e in stay + new] for f in Entry._fields})
        publish_snapshot(rows.coalesce(1), self.directory, n)
        if self.keep is not None:
            self._retain(spark, max(2, self.keep))

    def table(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The rows of all buckets, now or in a kept version; None before the first batch or without any row."""
        there = self.versions(spark)
        if version is not None and version not in there:
            raise ValueError(f"version {version} is not kept under {self.base}")
        if not there:
            return None
        return self.read(spark, self.entries(spark, there[-1] if version is None else version))

    def _grown(self, e: Entry) -> list[Entry]:
        """The bucket itself, or the longer prefixes that take its rows if it is past its size."""
        more = 0
        while e.bytes > self.bucket_bytes << more and e.depth + more < 63:
            more += 1
        return [Entry(e.depth + more, (e.prefix << more) + i) for i in range(1 << more)]

    def _sizes(self, spark: SparkSession, out: str) -> dict[str, int]:
        """Bytes by bucket of a generation; files are listed, not read."""
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .option("pathGlobFilter", "*.parquet").load(out).select("path", "length")
        by = files.groupBy(F.regexp_extract("path", f"{BUCKET}=([^/]+)/", 1).alias("b")).agg(F.sum("length").alias("n"))
        return {r.b: r.n for r in by.collect() if r.b}

    def _retain(self, spark: SparkSession, keep: int) -> None:
        versions = self.versions(spark)
        if len(versions) <= keep:
            return
        named = {e[:3] for v in versions[-keep:] for e in self.entries(spark, v)}
        for v in versions[:-keep]:
            for e in self.entries(spark, v):
                if e.gen is not None and e[:3] not in named:
                    _remove(spark, f"{self.data}/{GEN}={e.gen}/{BUCKET}={e.name}")
            _remove(spark, f"{self.directory}/v={v}")


def _local(spark: SparkSession, **columns: list[int | None]) -> DataFrame:
    """A few rows that the plan holds itself, so that reading them needs no job."""
    return spark.createDataFrame(pa.table({n: pa.array(v, pa.int64()) for n, v in columns.items()}))


def _remove(spark: SparkSession, path: str) -> None:
    _, p, fs = _fs(spark, path)
    fs.delete(p, True)
