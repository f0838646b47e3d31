"""Versioned Parquet snapshots and an append-only change log.

No table format: a silver table is a directory ``base/v=<n>`` per published
version.  Only versions whose write committed (``_SUCCESS`` present) are
visible.  A micro-batch reads the greatest version *below* its own, so a
replayed batch recomputes the same output and overwrites the same folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


COMMIT_TIMESTAMP = "_commit_timestamp"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def list_versions(spark: SparkSession, base: str, prefix: str = "v=") -> list[int]:
    """Committed versions under ``base`` (directory listing, no data read)."""
    jvm, p, fs = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[len(prefix):]))
    return sorted(out)


def numbered(spark: SparkSession, base: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix><n>`` under ``base``, committed or not."""
    _, p, fs = _fs(spark, base)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def drop_old_versions(spark: SparkSession, base: str, keep: int, prefix: str = "v=") -> None:
    """Remove all but the ``keep`` newest committed versions under ``base``."""
    jvm, _, fs = _fs(spark, base)
    for v in list_versions(spark, base, prefix)[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/{prefix}{v}"), True)


def publish_snapshot(df: DataFrame, base: str, version: int, sort_by: list[str] | None = None,
                     partition_by: list[str] | None = None, keep: int | None = None) -> str:
    """Write ``df`` as version ``version`` (overwrite = idempotent replay).

    ``keep`` retains that many versions (2 at least, as ``df`` may read the one
    before); older ones are removed once this one is committed.
    """
    out = f"{base}/v={int(version)}"
    w = df.sortWithinPartitions(*sort_by) if sort_by else df
    # static: the whole folder is this version, and its commit leaves the marker
    writer = w.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)
    if keep is not None:
        drop_old_versions(df.sparkSession, base, max(2, keep))
    return out


def read_snapshot(spark: SparkSession, base: str, version: int | None = None,
                  below: int | None = None) -> DataFrame | None:
    """A committed version: the given one, the latest, or the latest < ``below``."""
    vs = list_versions(spark, base)
    if version is not None:
        if version not in vs:
            raise ValueError(f"version {version} not published under {base}")
        v = version
    else:
        cands = [x for x in vs if below is None or x < below]
        if not cands:
            return None
        v = cands[-1]
    return spark.read.parquet(f"{base}/v={v}")


def append_changes(feed: DataFrame, log_base: str, version: int,
                   version_col: str = "_commit_version") -> str:
    """Store a change feed as partition ``_commit_version=<version>`` of the log.

    A committed version never changes: storing it again (a replayed batch) does
    nothing, so that consumers get it once.  Each row gets its commit time as
    ``_commit_timestamp``.
    """
    out = f"{log_base}/{version_col}={int(version)}"
    if not path_exists(feed.sparkSession, f"{out}/_SUCCESS"):
        if COMMIT_TIMESTAMP not in feed.columns:
            feed = feed.withColumn(COMMIT_TIMESTAMP, F.current_timestamp())
        feed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(out)
    return out


def read_log(spark: SparkSession, log_base: str) -> DataFrame:
    """The whole change log; filters on ``_commit_version`` prune partitions."""
    return spark.read.option("basePath", log_base).parquet(log_base)


def create_table_if_absent(spark: SparkSession, path: str, schema) -> bool:
    """``CREATE TABLE IF NOT EXISTS ... USING PARQUET`` for a path-named table.

    Writes an empty Parquet dataset carrying ``schema`` when nothing is at
    ``path``; returns True if it created it.  NOT NULL is not enforced by
    Parquet readers (they return nullable columns): use ``enforce_schema``
    before writing.
    """
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def consumer_start(spark: SparkSession, log_base: str, checkpoint: str, from_version: int | str = "latest",
                   version_col: str = "_commit_version") -> int:
    """The first version that the consumer with this checkpoint reads.

    Decided once, when the consumer first starts, and kept beside its
    checkpoint (``<checkpoint>-start``): whatever is asked for later, and however
    many versions were stored while the consumer was down, it goes on from there.
    """
    place = f"{checkpoint.rstrip('/')}-start"
    if not path_exists(spark, f"{place}/_SUCCESS"):
        first = from_version
        if first == "latest":
            first = max(numbered(spark, log_base, f"{version_col}="), default=-1) + 1
        spark.createDataFrame([(int(first),)], "first long").coalesce(1).write.mode("overwrite").parquet(place)
    return spark.read.schema("first long").parquet(place).first()["first"]


def read_change_stream(spark: SparkSession, log_base: str, schema, from_version: int | str = 0,
                       version_col: str = "_commit_version", max_files: int | None = None,
                       checkpoint: str | None = None):
    """The change log as a stream, from ``from_version`` on (0 = whole history).

    ``"latest"`` starts after the newest version there is when the consumer first
    starts; it needs the consumer's ``checkpoint``, beside which the start is kept
    (:func:`consumer_start`).  With a checkpoint a number is kept in the same way.

    The log is ``<log_base>/<version_col>=<n>/`` Parquet (see
    :func:`append_changes`); new versions are new folders, so the file stream
    source picks them up.  The version filter is a partition filter.
    """
    from pyspark.sql import types as T
    if checkpoint is not None:
        from_version = consumer_start(spark, log_base, checkpoint, from_version, version_col)
    elif from_version == "latest":
        raise ValueError('"latest" needs the consumer\'s checkpoint: counted anew at a restart, '
                         "it would skip what was stored in between")
    fields = [f for f in schema.fields if f.name != version_col]
    full = T.StructType(fields + [T.StructField(version_col, T.LongType(), True)])
    r = spark.readStream.schema(full)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(log_base).filter(F.col(version_col) >= F.lit(from_version))
