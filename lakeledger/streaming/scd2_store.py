"""SCD type 2 as a store of two parts: open states in buckets that grow, closed versions append-only.

Under ``base``:

* ``open/_gen=<n>/_bucket=<b>``: one row per key: its last version, the last event
  seen, and since which batch its closed versions count.  A batch rewrites the
  buckets it touches, once, as a new generation.
* ``closed/_batch=<n>``: versions that ended in batch ``n``, sorted by their end.
  Never rewritten.
* ``log/_batch=<n>/_slice=<s>``: the events, in fixed slices of the keys' hash.
* ``feed/_commit_version=<n>`` (with ``feed=True``): what the batch did to the current
  rows, as pre- and post-images; see :mod:`lakeledger.operators.changes`.
* ``directory/v=<n>``: the buckets, which split as they grow, and the generation each
  is read from (:mod:`lakeledger.streaming.buckets`).

A key whose events in the batch are all newer than its last one goes on from its
last version; the log is not read.  A key with a late event is rebuilt from its
slices of the log; all its closed versions are appended again and its older ones
stop counting (``_since``).  NULL is one more key.

A version of the store is one of its directory: ``history(version=n)`` reads the
generations it names and the closed versions up to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import join_on_key
from ..operators.changes import CHANGE_TYPE, DELETE, INSERT, POST, PRE
from ..operators.scd2 import scd2_history
from ..sources.snapshots import append_changes, read_snapshot
from .buckets import BUCKET, GrowingBuckets
from .versions import batch_version

SLICE = "_slice"


class Scd2Store:
    """``foreachBatch`` callback that keeps the store at ``base``; :meth:`history` reads it."""

    def __init__(self, base: str, keys: Sequence[str], tracked: Sequence[str], sequence: Sequence[str],
                 is_delete: Column | None = None, columns: Sequence[str] | None = None,
                 offset: int | None = None, keep: int | None = 10, depth: int = 4, bucket_bytes: int = 256 << 20,
                 slices: int = 16, start_col: str = "scd_start_date", end_col: str = "scd_end_date",
                 current_col: str | None = "is_current", version_col: str | None = "scd_version",
                 reject_null_keys: bool = False, feed: bool = False):
        self.base, self.keys, self.tracked, self.sequence = base, list(keys), list(tracked), list(sequence)
        self.is_delete, self.offset = is_delete, offset
        self.buckets = GrowingBuckets(base, keys, depth, bucket_bytes, keep, data="open")
        self.payload = [c for c in (columns if columns is not None else tracked) if c not in self.keys]
        self.kept = list(dict.fromkeys([*self.payload, *[c for c in tracked if c not in self.keys]]))
        self.slices = slices
        self.names = start_col, end_col, current_col, version_col
        self.reject_null_keys, self.feed = reject_null_keys, feed

    # ---- writing ---------------------------------------------------------

    def number(self, spark: SparkSession, batch_id: int) -> int:
        """The durable number of a batch."""
        return batch_version(spark, self.base, batch_id, self.offset,
                             [(f"{self.base}/log", "_batch="), (f"{self.base}/directory", "v=")])

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        n = self.number(spark, batch_id)
        hashed = F.xxhash64(*self.keys)
        if self.reject_null_keys:
            batch_df = batch_df.dropna(subset=self.keys)
        # rebalanced: a file a slice, several where one is large, whatever the batch's partitions are
        batch_df.withColumn(SLICE, F.pmod(hashed, F.lit(self.slices)).cast("int")).hint("rebalance", SLICE) \
            .write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(SLICE).parquet(f"{self.base}/log/_batch={n}")
        schema = T.StructType([*batch_df.schema.fields, T.StructField(SLICE, T.IntegerType())])
        batch = spark.read.schema(schema).parquet(f"{self.base}/log/_batch={n}")
        if batch.isEmpty():
            return
        old = self.buckets.before(spark, n)
        touched_keys = self.buckets.placed(batch.groupBy(*self.keys).agg(
            F.min(F.struct(*self.sequence)).alias("_first"), F.max(F.struct(*self.sequence)).alias("_newest"),
            F.first(SLICE).alias(SLICE)), old)
        touched_keys = self._keep_work(touched_keys, "keys")
        touched = {r[BUCKET] for r in touched_keys.select(BUCKET).distinct().collect()}  # of the directory's names
        states = self.buckets.read(spark, [e for e in old if e.name in touched])

        work = touched_keys
        if states is not None:
            work = join_on_key(work, states, self.keys, "left")
            work = work.withColumn("_late", F.coalesce(F.col("_first") <= F.col("_last"), F.lit(False)))
            work = self._keep_work(work, "work")
        versions = self._versions(spark, batch, work, states is not None, schema, n)
        versions = self._keep_work(versions, "versions")
        versions.filter(F.col("_end").isNotNull()).sortWithinPartitions("_end") \
            .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.base}/closed/_batch={n}")

        state = self._state(work, versions, states is not None, n)
        if self.feed:
            state = self._keep_work(state, "state")
            append_changes(self._images(state), f"{self.base}/feed", n)
        state = state.drop("_old")
        if states is not None:
            state = join_on_key(states, touched_keys, self.keys, "left_anti").select(*state.columns).unionByName(state)
        self.buckets.replace(n, state, old, touched)

    def _keep_work(self, df: DataFrame, name: str) -> DataFrame:
        """Rows of this batch's keys, written once; the next batch overwrites them."""
        path = f"{self.base}/_work/{name}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _versions(self, spark: SparkSession, batch: DataFrame, work: DataFrame, known: bool, schema,
                  n: int) -> DataFrame:
        """What the batch's keys have from their last known version on, or from the start where they are rebuilt."""
        ev_cols = list(dict.fromkeys([*self.keys, *self.sequence, *self.kept]))
        deleted = F.coalesce(self.is_delete if self.is_delete is not None else F.lit(False), F.lit(False))
        seq0, rest = self.sequence[0], self.sequence[1:]
        order = [seq0, "_rank", *rest]  # a stored version stands before the batch's events of its instant

        def built(events):
            return scd2_history(events, self.keys, self.tracked, order, is_delete=F.col("_del"), columns=self.kept,
                                start_col="_start", end_col="_end", current_col=None, version_col="_version")

        def ranked(events):
            return events.select(*ev_cols, deleted.alias("_del"), F.lit(1).alias("_rank"))

        if not known:
            return built(ranked(batch))
        events = ranked(batch)
        if not work.filter("_late").isEmpty():
            late = work.filter("_late").select(*self.keys, SLICE)
            log = spark.read.schema(T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])) \
                .option("basePath", f"{self.base}/log").parquet(f"{self.base}/log").filter(F.col("_batch") <= n)
            log = log.join(late.select(SLICE).distinct(), SLICE, "left_semi")  # prunes the log's folders
            events = join_on_key(events, late, self.keys, "left_anti").unionByName(
                ranked(join_on_key(log, late, self.keys, "left_semi")))
        # the last version stands for all events before: an upsert at its start, or a delete at its end
        stored = work.filter("not _late and _last is not null")
        synth = stored.select(
            *self.keys, F.coalesce("_end", "_start", F.col(f"_last.{seq0}")).alias(seq0), F.lit(0).alias("_rank"),
            (F.col("_end").isNotNull() | F.col("_start").isNull()).alias("_del"),
            *[(F.col(c) if c in self.kept else F.lit(None).cast(batch.schema[c].dataType)).alias(c)
              for c in ev_cols if c not in self.keys and c != seq0])
        # versions are counted from the stored one, which is the first again if it is open
        before = stored.select(*self.keys, F.greatest(
            F.col("_version") - F.col("_end").isNull().cast("bigint"), F.lit(0)).alias("_off"))
        out = join_on_key(built(events.unionByName(synth.select(*events.columns))), before, self.keys, "left")
        return out.withColumn("_version", F.col("_version") + F.coalesce("_off", F.lit(0))).drop("_off")

    def _state(self, work: DataFrame, versions: DataFrame, known: bool, n: int) -> DataFrame:
        """One row per key of the batch: its last version, its last event, since when closed versions count."""
        kept = [*self.kept, "_start", "_end"]
        last = versions.groupBy(*self.keys).agg(F.max_by(F.struct(*kept, "_version"), "_version").alias("_l"))
        stored = ["_late", F.struct(*kept, "_version").alias("_o"), "_last", "_since"] if known else []
        met = join_on_key(work.select(*self.keys, "_newest", *stored), last, self.keys, "left")
        if not known:
            row, newest, since = F.col("_l"), F.col("_newest"), F.lit(-1).cast("bigint")
        else:
            # a rebuilt key has what the log gives, other keys without a new version what they had
            row = F.when(F.col("_late") | F.col("_l").isNotNull(), F.col("_l")).otherwise(F.col("_o"))
            newest = F.greatest("_newest", "_last")
            since = F.when(F.col("_late"), F.lit(n)).otherwise(F.coalesce("_since", F.lit(-1)))
        return met.select(*self.keys, *[row[c].alias(c) for c in kept],
                          F.coalesce(row["_version"], F.lit(0)).cast("bigint").alias("_version"),
                          newest.alias("_last"), since.cast("bigint").alias("_since"),
                          (F.col("_o") if known else F.lit(None).cast(last.schema["_l"].dataType)).alias("_old"))

    def _images(self, state: DataFrame) -> DataFrame:
        """Changes of the current rows of the batch's keys: insert, update (before and after), delete."""
        start, number = self.names[0], self.names[3]
        cols = [*self.payload, "_start", "_version"]
        was = F.coalesce((F.col("_old._version") > 0) & F.col("_old._end").isNull(), F.lit(False))
        now = (F.col("_version") > 0) & F.col("_end").isNull()
        new = reduce(or_, [~F.col(f"_old.{c}").eqNullSafe(F.col(c)) for c in cols])

        def image(kind, old):
            return F.struct(*[(F.col(f"_old.{c}") if old else F.col(c)).alias(c) for c in cols],
                            F.lit(kind).alias(CHANGE_TYPE))
        first = F.when(was & ~now, image(DELETE, True)).when(now & ~was, image(INSERT, False)) \
            .when(was & now & new, image(PRE, True))
        second = F.when(was & now & new, image(POST, False))
        each = state.select(*self.keys, F.explode(F.array(first, second)).alias("_c")).filter("_c is not null")
        return each.select(*self.keys, *[F.col(f"_c.{c}") for c in self.payload], F.col("_c._start").alias(start),
                           *([F.col("_c._version").alias(number)] if number else []), F.col(f"_c.{CHANGE_TYPE}"))

    # ---- reading ---------------------------------------------------------

    def history(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """All versions of all keys, now or as of a kept version of the store; None before the first batch."""
        states = self.buckets.table(spark, version)
        if states is None:
            return None
        v = max(self.buckets.versions(spark)) if version is None else version
        start, end, current, number = self.names

        def shaped(df):
            cols = [*self.keys, *self.payload, F.col("_start").alias(start), F.col("_end").alias(end)]
            if current:
                cols.append(F.col("_end").isNull().alias(current))
            if number:
                cols.append(F.col("_version").alias(number))
            return df.select(*cols)

        live = states.filter("_version > 0 and _end is null")
        schema = states.select(*self.keys, *self.payload, "_start", "_end", "_version").schema.add("_batch", "long")
        closed = spark.read.option("basePath", f"{self.base}/closed").schema(schema) \
            .parquet(f"{self.base}/closed").filter(F.col("_batch") <= v)
        rebuilt = states.filter("_since >= 0").select(*self.keys, "_since")
        closed = join_on_key(closed, rebuilt, self.keys, "left").filter("_since is null or _batch >= _since")
        return shaped(live).unionByName(shaped(closed))


def read_directory(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The buckets of a table: depth, prefix, generation, bytes."""
    return read_snapshot(spark, f"{base}/directory", version=version)
