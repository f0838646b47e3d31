"""Helpers shared by the operators: materialised stages and Arrow text access."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives a lost executor, and fixes values
    that a recomputation could change (row ids, sampled range bounds).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as Python strings, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str | int,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``max_bytes`` in each.

    One text may be longer; it then forms a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + (size or 0) > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        yield batch.slice(start)
