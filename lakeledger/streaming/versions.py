"""Durable numbers of micro-batches, and the change logs that carry them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources.snapshots import numbered, path_exists


def batch_version(spark: SparkSession, base: str, batch_id: int, offset: int | None,
                  folders: Sequence[tuple[str, str]]) -> int:
    """The durable number of a batch: where its run began, plus its id.

    Batch ids restart at 0 with a new checkpoint.  A run is named by its
    checkpoint's query id; its first number, kept under ``<base>/_runs``, is past
    every number that ``folders`` (path, name prefix) hold when it starts.  A
    call outside a stream has no run: it gets ``offset`` plus the id, and is
    refused if newer numbers exist, as it would build on an old version.
    """
    newest = max((n for path, prefix in folders for n in numbered(spark, path, prefix)), default=-1)
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if run is None:
        version = (offset or 0) + int(batch_id)
        if newest > version:
            raise RuntimeError(f"{base} already has version {newest} > {version}; "
                               f"restarted checkpoint? pass offset={newest + 1}")
        return version
    place = f"{base}/_runs/{run}"
    if path_exists(spark, f"{place}/_SUCCESS"):
        first = spark.read.schema("first long").parquet(place).first()["first"]
    else:
        first = max(newest + 1, offset or 0)
        spark.createDataFrame([(first,)], "first long").coalesce(1).write.mode("overwrite").parquet(place)
    return first + int(batch_id)


def read_batches(spark: SparkSession, log_base: str, schema) -> DataFrame:
    """The change log ``<log_base>/_batch=<n>``; its schema is given, as batches may be empty."""
    full = schema.add("_batch", "long") if "_batch" not in schema.fieldNames() else schema
    return spark.read.schema(full).option("basePath", log_base).parquet(log_base).drop("_batch")
