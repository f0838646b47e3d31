"""Streaming sinks: checkpointed append and ``foreachBatch``, always awaited.

``availableNow`` drains everything present (respecting
``maxFilesPerTrigger``) in as many micro-batches as needed, then stops.
Passing ``trigger={"processingTime": "1 minute"}`` runs the same plan
continuously.  Progress (files read, batches committed) lives in the
checkpoint, which must sit on shared storage (see ``session.scratch_path``)
so a restarted driver or a lost executor resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def await_query(q: StreamingQuery, timeout_s: int | None = None) -> StreamingQuery:
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name or q.id} failed: {q.exception()}")
    return q


ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, off the heap; a batch uploads its changes only.

    The number of state partitions is fixed for a stream's life when it first starts
    (``partitions``; default: the shuffle partitions), as is the kind of store:
    both are written to its checkpoint and hold over restarts.  Choose it for the
    state there will be: 100 MB to 1 GB a partition.
    """
    wanted = dict(ROCKSDB)
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(int(partitions))
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def append_stream(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: list[str] | None = None, trigger: dict | None = None,
                  name: str | None = None) -> StreamingQuery:
    """Append every new row to ``out`` exactly once (file sink + checkpoint)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    q = _trigger(w, trigger).start(out)
    return await_query(q) if trigger is None or "availableNow" in trigger else q


def foreach_batch_stream(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                         output_mode: str = "append", trigger: dict | None = None,
                         name: str | None = None) -> StreamingQuery:
    """Hand each micro-batch to ``fn(batch_df, batch_id)``; ``fn`` must be idempotent per id."""
    w = (df.writeStream.foreachBatch(fn).outputMode(output_mode)
           .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    q = _trigger(w, trigger).start()
    return await_query(q) if trigger is None or "availableNow" in trigger else q
