"""Silver maintenance inside ``foreachBatch``: each micro-batch publishes one
new snapshot version computed from the previous version and the batch.

The callback is idempotent: the base it reads is the greatest committed version
*below* its own, and the write is an overwrite of its own folder — a batch
replayed after a failure yields the same folder contents.  Version, change log,
staging and quarantine folders all carry the durable number of
:func:`batch_version`, so a stream that goes on with a new checkpoint adds to
what an earlier run left and never overwrites it.  Non-time windows cannot run on
streaming DataFrames, so per-key ordering happens here, on the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import END_AT, START_AT, TOMBSTONE, apply_changes
from ..operators.dedup import latest_per_key
from ..operators.merge import CREATED, DELETED, scd1_apply, upsert, without_tombstones
from ..operators.scd2 import scd2_apply, scd2_history
from ..sources.snapshots import publish_snapshot, read_snapshot
from .buckets import BUCKET, GrowingBuckets
from .scd2_store import Scd2Store
from .versions import batch_version, read_batches

Builder = Callable[[DataFrame, "DataFrame | None", int], DataFrame]


class SnapshotWriter:
    """``foreachBatch`` callback: ``build(batch, previous, batch_id)`` -> next version.

    ``materialize``: ``"persist"`` caches the micro-batch (it is read twice);
    ``"stage"`` writes it to ``<base>/_staging/batch=<id>`` on the shared
    storage and reads it back, which also cuts lineage — needed for batches of
    stateful aggregations, whose plans cannot be cached.
    """

    def __init__(self, base: str, build: Builder, offset: int | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None,
                 materialize: str = "persist", log_base: str | None = None, keep: int | None = None):
        self.base, self.build, self.offset, self.prepare = base, build, offset, prepare
        self.materialize, self.keep = materialize, keep
        self.folders = [(base, "v="), *([(log_base, "_batch=")] if log_base else [])]

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        version = batch_version(spark, self.base, batch_id, self.offset, self.folders)
        if self.materialize == "stage":
            staged = f"{self.base}/_staging/batch={version}"
            batch_df.write.mode("overwrite").parquet(staged)
            batch = spark.read.parquet(staged)
        else:
            batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():  # nothing arrived: publish nothing
                return
            prev = read_snapshot(spark, self.base, below=version)
            src = self.prepare(batch) if self.prepare else batch
            publish_snapshot(self.build(src, prev, version), self.base, version, keep=self.keep)
        finally:
            if self.materialize != "stage":
                batch.unpersist()


def upsert_writer(base: str, keys: Sequence[str], sequence: Sequence[str], **kw) -> SnapshotWriter:
    def build(batch, prev, _):
        if prev is None:
            return latest_per_key(batch, keys, sequence)
        return upsert(prev, batch.select(*prev.columns), keys, sequence=sequence)
    return SnapshotWriter(base, build, **kw)


def scd1_writer(base: str, keys: Sequence[str], tracked: Sequence[str],
                now: Callable[[int], object], sequence: Sequence[str] | None = None,
                is_delete: Column | None = None, source_kind: str = "delta",
                sk_col: str | None = None, **kw) -> SnapshotWriter:
    def build(batch, prev, version):
        return scd1_apply(prev, batch, keys, tracked, now(version), sequence=sequence,
                          source_kind=source_kind, is_delete=is_delete, sk_col=sk_col, keep_tombstones=True)
    return SnapshotWriter(base, build, **kw)


def apply_changes_writer(base: str, keys: Sequence[str], sequence_by: Sequence[str],
                         apply_as_deletes: Column | None = None,
                         except_column_list: Sequence[str] = (), **kw) -> SnapshotWriter:
    """Type 1 with tombstones kept in the stored state (hidden by :func:`published`),
    so a late, older upsert cannot resurrect a deleted key."""
    def build(batch, prev, _):
        return apply_changes(batch, keys, sequence_by, apply_as_deletes=apply_as_deletes,
                             except_column_list=except_column_list, stored_as_scd_type=1,
                             target=prev, keep_tombstones=True)
    return SnapshotWriter(base, build, **kw)


def scd2_writer(base: str, log_base: str, keys: Sequence[str], tracked: Sequence[str],
                sequence: Sequence[str], is_delete: Column | None = None,
                columns: Sequence[str] | None = None, **kw) -> SnapshotWriter:
    """Incremental SCD2: log the batch (``_batch=<version>``, overwrite), then
    rebuild only the keys of the batch from the whole log."""
    def build(batch, prev, version):
        batch.write.mode("overwrite").parquet(f"{log_base}/_batch={version}")
        log = read_batches(batch.sparkSession, log_base, batch.schema)
        if prev is None:
            return scd2_history(log, keys, tracked, sequence, is_delete=is_delete, columns=columns)
        return scd2_apply(prev, log, batch, keys, tracked, sequence, is_delete=is_delete, columns=columns)
    return SnapshotWriter(base, build, log_base=log_base, **kw)


def published(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The readable silver table: latest (or given) version without tombstones."""
    df = read_snapshot(spark, base, version=version)
    return None if df is None else visible(df)


def visible(df: DataFrame) -> DataFrame:
    """A stored state without its tombstones."""
    if TOMBSTONE in df.columns:
        return df.filter(~F.col(TOMBSTONE)).drop(TOMBSTONE)
    return without_tombstones(df) if {CREATED, DELETED} <= set(df.columns) else df


def stream_latest_per_key(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Streaming aggregate keeping the latest row per key (use output mode ``update``).

    A late row older than the stored one loses, whatever its arrival batch.
    State holds one row per key.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*sequence)).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def stream_dedup(df: DataFrame, keys: Sequence[str], watermark: tuple[str, str] | None = None) -> DataFrame:
    """First row per key in arrival order.  Without a watermark the state grows
    with the number of keys; with ``(col, delay)`` it is bounded."""
    if watermark:
        col, delay = watermark
        from pyspark.sql import types as T
        if isinstance(df.schema[col].dataType, T.TimestampNTZType):
            # watermarks need TIMESTAMP; derive it, keep the original column
            out = (df.withColumn("_event_time", F.col(col).cast("timestamp"))
                     .withWatermark("_event_time", delay)
                     .dropDuplicatesWithinWatermark(list(keys)))
            return out.drop("_event_time")
        return df.withWatermark(col, delay).dropDuplicatesWithinWatermark(list(keys))
    return df.dropDuplicates(list(keys))


class BucketedWriter:
    """``foreachBatch`` callback that rewrites only the key buckets a batch touches.

    The table lies in buckets that begin as ``buckets`` (a power of two) and split as
    they grow; see :class:`~lakeledger.streaming.buckets.GrowingBuckets`.  Per batch:
    read the touched buckets, build their new content, write it once as a new generation,
    publish the directory.  Untouched buckets are neither listed, read nor written.  A
    batch that fails leaves the table as it was; a replayed one starts from the version
    before its own and writes the same again.  ``keep`` versions can be read.  The batch's
    key columns have the types they are stored with.
    """

    def __init__(self, base: str, keys: Sequence[str], buckets: int, build: Builder,
                 offset: int | None = None, log_base: str | None = None, keep: int | None = 10,
                 bucket_bytes: int = 256 << 20):
        self.base, self.build, self.offset = base, build, offset
        self.buckets = GrowingBuckets(base, keys, max(0, int(buckets) - 1).bit_length(), bucket_bytes, keep)
        self.folders = [(f"{base}/directory", "v="), *([(log_base, "_batch=")] if log_base else [])]

    def number(self, spark: SparkSession, batch_id: int) -> int:
        """The durable number of a batch."""
        return batch_version(spark, self.base, batch_id, self.offset, self.folders)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        version = self.number(spark, batch_id)
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            old = self.buckets.before(spark, version)
            touched = {r[0] for r in self.buckets.placed(batch, old).select(BUCKET).distinct().collect()}
            prev = self.buckets.read(spark, [e for e in old if e.name in touched])
            self.buckets.replace(version, self.build(batch, prev, version), old, touched)
        finally:
            batch.unpersist()


def bucketed_scd2_writer(base: str, keys: Sequence[str], tracked: Sequence[str],
                         sequence: Sequence[str], buckets: int, is_delete: Column | None = None,
                         columns: Sequence[str] | None = None, **names) -> Scd2Store:
    """Incremental SCD2 that begins with so many buckets (a power of two) and splits them as they grow."""
    return Scd2Store(base, keys, tracked, sequence, is_delete=is_delete, columns=columns,
                     depth=max(0, int(buckets) - 1).bit_length(), **names)


def apply_changes_scd2_writer(base: str, keys: Sequence[str], sequence_by: Sequence[str], columns: Sequence[str],
                              buckets: int, apply_as_deletes: Column | None = None,
                              track_history_column_list: Sequence[str] | None = None,
                              version_col: str | None = None) -> Scd2Store:
    """Type-2 :func:`~lakeledger.operators.cdc.apply_changes` of a change stream, touched buckets only.

    ``columns`` are stored; those that are no key and no sequence are tracked
    unless a list is given.
    """
    payload = [c for c in columns if c not in keys]
    tracked = list(track_history_column_list) if track_history_column_list is not None else \
        [c for c in payload if c not in sequence_by]
    return bucketed_scd2_writer(base, keys, tracked, sequence_by, buckets, is_delete=apply_as_deletes, columns=payload,
                                start_col=START_AT, end_col=END_AT, current_col=None, version_col=version_col,
                                reject_null_keys=True)


def bucketed_scd1_writer(base: str, keys: Sequence[str], tracked: Sequence[str],
                         now: Callable[[int], object], buckets: int, sequence: Sequence[str] | None = None,
                         is_delete: Column | None = None, sk_col: str | None = None,
                         except_column_list: Sequence[str] = ()) -> BucketedWriter:
    """SCD type 1 (delta source) rewriting only the touched buckets."""
    def build(batch, prev, version):
        return scd1_apply(prev, batch, keys, tracked, now(version), sequence=sequence, is_delete=is_delete,
                          sk_col=sk_col, except_column_list=except_column_list, keep_tombstones=True)
    return BucketedWriter(base, keys, buckets, build)


def bucketed_apply_changes_writer(base: str, keys: Sequence[str], sequence_by: Sequence[str],
                                  buckets: int, apply_as_deletes: Column | None = None,
                                  except_column_list: Sequence[str] = ()) -> BucketedWriter:
    """Type-1 change application (with tombstones) rewriting only the touched buckets."""
    def build(batch, prev, _):
        return apply_changes(batch, keys, sequence_by, apply_as_deletes=apply_as_deletes,
                             except_column_list=except_column_list, stored_as_scd_type=1,
                             target=prev, keep_tombstones=True)
    return BucketedWriter(base, keys, buckets, build)


def bucketed_table(spark: SparkSession, writer_or_base, version: int | None = None) -> DataFrame | None:
    """The readable table of a bucketed writer, now or in a kept version (tombstones hidden); None without rows."""
    if isinstance(writer_or_base, Scd2Store):
        return writer_or_base.history(spark, version)
    base = writer_or_base.base if isinstance(writer_or_base, BucketedWriter) else writer_or_base
    df = GrowingBuckets(base, []).table(spark, version)
    return None if df is None else visible(df)


FastScd2Writer = Scd2Store  # the name it had
