"""File-source, streaming-sink and end-to-end scenarios over the driver tables.

Each query stages the *whole* driver table into a fresh folder below the
shared checkpoint folder (CSV / Parquet landing files written by Spark),
runs the real streaming queries with ``availableNow`` to completion, and
returns a batch read of what they published.  Oracles are batch SQL over the
same tables, since a drained stream must equal the batch answer.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import text
from ..operators import quality
from ..operators.changes import read_changes
from ..operators.dedup import latest_per_key
from ..operators.extracts import scd2_extract_series
from ..operators.gold import readmissions
from ..operators.incremental import IncrementalReader
from ..operators.merge import upsert
from ..operators.ordered import cut
from ..operators.replay import SchemaLog, replay_quarantine
from ..operators.sketches import HLL_ERROR, KLL_ERROR, SketchLog
from ..session import scratch_path
from ..sources.files import MULTILINE, RESCUE_COL, file_name, read_file_stream, read_files, with_ingest_metadata
from ..sources.schemas import describe_schema, infer_or_load_schema
from ..sources.snapshots import append_changes, path_exists, publish_snapshot, read_change_stream, read_log, read_snapshot
from ..streaming.silver import (FastScd2Writer, SnapshotWriter, apply_changes_scd2_writer, apply_changes_writer,
                                bucketed_apply_changes_writer,
                                bucketed_scd2_writer, bucketed_table, published,
                                scd1_writer, scd2_writer, stream_dedup, stream_latest_per_key, upsert_writer)
from ..streaming.scd2_store import Scd2Store, read_directory
from ..streaming.sinks import append_stream, foreach_batch_stream, state_on_disk
from .catalog import (AUTO1_SQL, AUTO2_SQL, EV_COLS, is_del, NOW1, NOW2, OLD_STATE_SQL, READMISSION_SQL, SCD1_STATE_SQL, SCD2_SQL, SEQ,
                      _latest_sql, _orders_as_text, _scd2_sql, event_change_log, events, new_state, old_state,
                      orders_schema, register, table)
from .medallion import Entity, oncology_entities, oncology_gold, production_entities, run_medallion

EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _stage_events_by_type(spark, d, root) -> tuple[str, T.StructType]:
    """Landing files that each span the whole time range (one per event type),
    so later files carry older events: arrival order != event order."""
    e = events(spark, d)
    stage = f"{root}/landing_events"
    e.repartition(F.col("event_type")).write.mode("overwrite").parquet(stage)
    return stage, e.schema


def _stage_events_by_pair(spark, d, root, files=12) -> tuple[str, T.StructType]:
    """Landing files by hash of (user, event type): a batch touches only some
    users, and a user's events arrive over several batches, out of time order."""
    e = events(spark, d)
    stage = f"{root}/landing_pairs"
    e.repartition(files, F.col("user_id"), F.col("event_type")).write.mode("overwrite").parquet(stage)
    return stage, e.schema


def _parquet_stream(spark, path, schema, max_files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


@register("q_stream_bronze_append", f"SELECT *, 'events.parquet' AS source_file_name FROM events")
def q_stream_bronze_append(spark, d):
    root = scratch_path(spark, "bronze_append")
    schema = events(spark, d).schema
    src = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    append_stream(with_ingest_metadata(src), f"{root}/bronze", f"{root}/_chk")
    out = spark.read.parquet(f"{root}/bronze")
    return out.select(*schema.fieldNames(), file_name("_source_file").alias("source_file_name"))


@register("q_ingest_metadata", f"""
SELECT event_id, 'events.parquet' AS source_file_name, true AS has_mtime,
       TIMESTAMP '{NOW1}' AS load_datetime, 'b-0001' AS batch_id FROM events""")
def q_ingest_metadata(spark, d):
    m = with_ingest_metadata(events(spark, d), load_ts=F.lit(NOW1).cast("timestamp"), batch_id="b-0001")
    return m.select("event_id", file_name().alias("source_file_name"),
                    F.col("_source_file_mtime").isNotNull().alias("has_mtime"),
                    F.col("_load_datetime").cast("timestamp_ntz").alias("load_datetime"),
                    F.col("_batch_id").alias("batch_id"))


@register("q_stream_table_source",
          "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type <> 'error'")
def q_stream_table_source(spark, d):
    root = scratch_path(spark, "table_source")
    stage, schema = _stage_events_by_type(spark, d, root)
    append_stream(_parquet_stream(spark, stage, schema), f"{root}/bronze", f"{root}/_chk1")
    bronze = spark.readStream.schema(schema).parquet(f"{root}/bronze")
    silver = bronze.filter(~is_del()).select(*EV_COLS)
    append_stream(silver, f"{root}/silver", f"{root}/_chk2")
    return spark.read.parquet(f"{root}/silver")


CSV_NOTE = "concat(c_name, ', \"', c_mktsegment, '\"', chr(10), 'second line')"


@register("q_csv_dialect", f"SELECT c_custkey, c_name, c_mktsegment, {CSV_NOTE} AS note, true AS parsed FROM customer")
def q_csv_dialect(spark, d):
    root = scratch_path(spark, "csv_dialect")
    c = table(spark, d, "customer")
    note = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"\nsecond line'))
    (c.select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment", note.alias("note"))
      .write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{root}/landing"))
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_mktsegment", T.StringType()), T.StructField("note", T.StringType())])
    got = read_files(spark, f"{root}/landing", schema, options=MULTILINE)
    return got.select("c_custkey", "c_name", "c_mktsegment", "note",
                      F.col(RESCUE_COL).isNull().alias("parsed"))


RESCUE_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType())])


@register("q_stream_rescued", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_totalprice END AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') AS is_rescued
FROM orders""")
def q_stream_rescued(spark, d):
    root = scratch_path(spark, "rescued")
    o = table(spark, d, "orders")
    price = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       "o_orderstatus", price, F.date_format("o_orderdate", "yyyy-MM-dd"))
    line = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(line, F.lit(",EXTRA"))).otherwise(line)
    o.select(line.alias("value")).write.text(f"{root}/landing")
    src = read_file_stream(spark, f"{root}/landing", RESCUE_SCHEMA, options={"header": "false"}, max_files=2)
    append_stream(src, f"{root}/bronze", f"{root}/_chk")
    got = spark.read.parquet(f"{root}/bronze")
    return got.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                      F.col(RESCUE_COL).isNotNull().alias("is_rescued"))


@register("q_stream_json_rescued", """
SELECT c_custkey, c_name, c_mktsegment,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_acctbal END AS c_acctbal,
       c_mktsegment = 'HOUSEHOLD' AS is_rescued
FROM customer""")
def q_stream_json_rescued(spark, d):
    """JSON landing files; one part carries the balance as text ('n/a'), so its
    rows keep their raw JSON in _rescued_data and a NULL balance."""
    root = scratch_path(spark, "json_rescued")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    household = F.col("c_mktsegment") == "HOUSEHOLD"
    c.filter(~household).write.json(f"{root}/landing")
    (c.filter(household).withColumn("c_acctbal", F.lit("n/a"))
      .write.mode("append").json(f"{root}/landing"))
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("c_mktsegment", T.StringType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    src = read_file_stream(spark, f"{root}/landing", schema, fmt="json", max_files=4)
    append_stream(src, f"{root}/bronze", f"{root}/_chk")
    got = spark.read.parquet(f"{root}/bronze")
    return got.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal",
                      F.col(RESCUE_COL).isNotNull().alias("is_rescued"))


@register("q_stream_dedup", EVENTS_SQL)
def q_stream_dedup(spark, d):
    root = scratch_path(spark, "dedup")
    e = events(spark, d)
    e.write.parquet(f"{root}/landing")
    e.write.mode("append").parquet(f"{root}/landing")  # the same rows delivered twice
    out = stream_dedup(_parquet_stream(spark, f"{root}/landing", e.schema), ["event_id"])
    with state_on_disk(spark):
        append_stream(out, f"{root}/bronze", f"{root}/_chk")
    return spark.read.parquet(f"{root}/bronze")


@register("q_stream_dedup_watermark", EVENTS_SQL)
def q_stream_dedup_watermark(spark, d):
    """Bounded-state dedup: ids are forgotten once the watermark passes them.
    The delay is the measured event-time range, so no first copy is late."""
    root = scratch_path(spark, "dedup_wm")
    e = events(spark, d)
    days = e.agg(F.datediff(F.max("ts"), F.min("ts"))).first()[0] or 0
    e.write.parquet(f"{root}/landing")
    e.write.mode("append").parquet(f"{root}/landing")
    out = stream_dedup(_parquet_stream(spark, f"{root}/landing", e.schema), ["event_id"],
                       watermark=("ts", f"{days + 1} days"))
    append_stream(out, f"{root}/bronze", f"{root}/_chk")
    return spark.read.parquet(f"{root}/bronze")


@register("q_stream_latest_per_key", _latest_sql(cols="event_id, ts, user_id, event_type, value, props"))
def q_stream_latest_per_key(spark, d):
    root = scratch_path(spark, "latest_stream")
    stage, schema = _stage_events_by_type(spark, d, root)
    agg = stream_latest_per_key(_parquet_stream(spark, stage, schema), ["user_id"], SEQ)
    foreach_batch_stream(agg, upsert_writer(f"{root}/silver", ["user_id"], SEQ, materialize="stage"), f"{root}/_chk",
                         output_mode="update")
    return published(spark, f"{root}/silver").select(*schema.fieldNames())


@register("q_stream_auto_cdc_scd1", AUTO1_SQL)
def q_stream_auto_cdc_scd1(spark, d):
    root = scratch_path(spark, "auto_cdc_stream")
    stage, schema = _stage_events_by_type(spark, d, root)
    w = apply_changes_writer(f"{root}/silver", ["user_id"], SEQ, apply_as_deletes=is_del(),
                             except_column_list=["props"])
    foreach_batch_stream(_parquet_stream(spark, stage, schema), w, f"{root}/_chk")
    return published(spark, f"{root}/silver").select(*EV_COLS)


@register("q_stream_scd2_incremental", SCD2_SQL)
def q_stream_scd2_incremental(spark, d):
    root = scratch_path(spark, "scd2_stream")
    stage, schema = _stage_events_by_type(spark, d, root)
    w = scd2_writer(f"{root}/silver", f"{root}/log", ["user_id"], ["event_type"], SEQ)
    foreach_batch_stream(_parquet_stream(spark, stage, schema), w, f"{root}/_chk")
    return published(spark, f"{root}/silver")


@register("q_stream_scd2_bucketed", SCD2_SQL)
def q_stream_scd2_bucketed(spark, d):
    root = scratch_path(spark, "scd2_bucketed")
    stage, schema = _stage_events_by_pair(spark, d, root, files=6)
    w = bucketed_scd2_writer(f"{root}/silver", ["user_id"], ["event_type"], SEQ, buckets=16)
    foreach_batch_stream(_parquet_stream(spark, stage, schema), w, f"{root}/_chk")
    return bucketed_table(spark, w)


@register("q_stream_scd2_fast", SCD2_SQL)
def q_stream_scd2_fast(spark, d):
    """SCD2 per micro-batch from the last versions; the log is read only for
    keys that receive events older than what was already applied."""
    root = scratch_path(spark, "scd2_fast_stream")
    stage, schema = _stage_events_by_pair(spark, d, root, files=4)
    w = FastScd2Writer(f"{root}/silver", ["user_id"], ["event_type"], SEQ)
    foreach_batch_stream(_parquet_stream(spark, stage, schema), w, f"{root}/_chk")
    return w.history(spark)


@register("q_stream_auto_cdc_bucketed", AUTO1_SQL)
def q_stream_auto_cdc_bucketed(spark, d):
    root = scratch_path(spark, "auto_cdc_bucketed")
    stage, schema = _stage_events_by_pair(spark, d, root)
    w = bucketed_apply_changes_writer(f"{root}/silver", ["user_id"], SEQ, buckets=16,
                                      apply_as_deletes=is_del(), except_column_list=["props"])
    foreach_batch_stream(_parquet_stream(spark, stage, schema), w, f"{root}/_chk")
    return bucketed_table(spark, w).select(*EV_COLS)


def _event_entity(max_files=2) -> Entity:
    s = T.StructType([T.StructField(c, T.StringType()) for c in EV_COLS])
    return Entity(
        name="events", schema=s, keys=["user_id"], sequence=SEQ,
        clean={"event_id": text("event_id").try_cast("bigint"), "ts": text("ts").try_cast("timestamp_ntz"),
               "user_id": text("user_id").try_cast("bigint"), "event_type": text("event_type"),
               "value": text("value").try_cast("double")},
        kind="cdc1", is_delete=is_del(), max_files=max_files)


def _stage_csv(df: DataFrame, path: str, parts: int | None = None):
    cols = [F.col(c).cast("string").alias(c) for c in df.columns]
    out = df.select(*cols)
    if parts:
        out = out.repartition(parts)
    out.write.option("header", True).option("escape", '"').csv(path)


@register("q_stream_bronze_to_silver", AUTO1_SQL)
def q_stream_bronze_to_silver(spark, d):
    root = scratch_path(spark, "bronze_to_silver")
    e = events(spark, d).select(*EV_COLS)
    _stage_csv(e.repartition(F.col("event_type")), f"{root}/landing/events")
    silver = run_medallion(spark, [_event_entity()], f"{root}/landing", f"{root}/lake",
                           now=lambda b: NOW1)
    return silver["events"].select(*EV_COLS)


ORDERS_INFERRED_SQL = """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""


def _stage_orders_for_inference(spark, d, root):
    o = table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    _stage_csv(o, f"{root}/landing")
    return infer_or_load_schema(spark, f"{root}/landing", f"{root}/_schema")


@register("q_schema_inferred_ingest", ORDERS_INFERRED_SQL)
def q_schema_inferred_ingest(spark, d):
    root = scratch_path(spark, "inferred")
    schema = _stage_orders_for_inference(spark, d, root)
    src = read_file_stream(spark, f"{root}/landing", schema, max_files=4)
    append_stream(src, f"{root}/bronze", f"{root}/_chk")
    return spark.read.parquet(f"{root}/bronze").drop(RESCUE_COL)


@register("q_schema_inspect", """
SELECT * FROM (VALUES ('o_orderkey', 'integer', true, 0), ('o_custkey', 'integer', true, 1),
  ('o_orderstatus', 'string', true, 2), ('o_totalprice', 'double', true, 3),
  ('o_orderdate', 'date', true, 4), ('o_orderpriority', 'string', true, 5))
  AS t(column_name, data_type, nullable, position)""")
def q_schema_inspect(spark, d):
    root = scratch_path(spark, "inspect")
    _stage_orders_for_inference(spark, d, root)
    return describe_schema(spark, f"{root}/_schema")


@register("q_schema_drift", """
SELECT 'o_orderkey' AS "column", 'bigint' AS expected_type, 'string' AS actual_type, 'type_mismatch' AS kind, CAST(0 AS BIGINT) AS n_bad_values
UNION ALL SELECT 'o_custkey', 'bigint', 'string', 'type_mismatch', 0
UNION ALL SELECT 'o_totalprice', 'double', 'string', 'type_mismatch',
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
UNION ALL SELECT 'o_orderdate', 'date', 'string', 'type_mismatch', 0
UNION ALL SELECT 'o_orderstatus', 'string', 'string', 'ok', 0
UNION ALL SELECT 'o_clerk', 'string', NULL, 'missing', NULL
UNION ALL SELECT 'o_orderpriority', NULL, 'string', 'unexpected', NULL""")
def q_schema_drift(spark, d):
    raw = _orders_as_text(spark, d, "o_orderpriority")
    expected = T.StructType(orders_schema().fields + [T.StructField("o_clerk", T.StringType())])
    return quality.schema_drift(raw, expected)


@register("q_schema_evolution_union", """
SELECT c_custkey, c_name,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer""")
def q_schema_evolution_union(spark, d):
    root = scratch_path(spark, "evolution")
    c = table(spark, d, "customer")
    first = F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")
    c.filter(first).select("c_custkey", "c_name", "c_nationkey").write.parquet(f"{root}/t")
    c.filter(~first).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.mode("append").parquet(f"{root}/t")
    merged = spark.read.option("mergeSchema", "true").parquet(f"{root}/t")
    return merged.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("q_snapshot_time_travel", OLD_STATE_SQL)
def q_snapshot_time_travel(spark, d):
    root = scratch_path(spark, "snapshots")
    publish_snapshot(old_state(spark, d), f"{root}/silver", 1)
    publish_snapshot(new_state(spark, d), f"{root}/silver", 2)
    return read_snapshot(spark, f"{root}/silver", version=1)


@register("q_change_log_stored", f"""
SELECT event_id, ts, user_id, event_type, value,
  CASE WHEN event_type = 'error' THEN 'delete'
       WHEN prev IS NULL OR prev = 'error' THEN 'insert' ELSE 'update_postimage' END AS _change_type,
  datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS _commit_version
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) BETWEEN 10 AND 20""")
def q_change_log_stored(spark, d):
    root = scratch_path(spark, "change_log")
    event_change_log(spark, d).write.partitionBy("_commit_version").parquet(f"{root}/log")
    log = read_log(spark, f"{root}/log")
    out = read_changes(log, 10, 20)
    return out.withColumn("_commit_version", F.col("_commit_version").cast("bigint"))


@register("q_stream_change_feed_from_version", f"""
SELECT event_id, ts, user_id, event_type, value,
  CASE WHEN event_type = 'error' THEN 'delete'
       WHEN prev IS NULL OR prev = 'error' THEN 'insert' ELSE 'update_postimage' END AS _change_type,
  datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS _commit_version
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) >= 20""")
def q_stream_change_feed_from_version(spark, d):
    """A change log stored per commit version, consumed as a stream from version 20."""
    root = scratch_path(spark, "cdf_stream")
    log = event_change_log(spark, d)
    log.write.partitionBy("_commit_version").parquet(f"{root}/log")
    stream = read_change_stream(spark, f"{root}/log", log.schema, from_version=20, max_files=8)
    append_stream(stream, f"{root}/out", f"{root}/_chk")
    return spark.read.parquet(f"{root}/out").select(*log.columns)


@register("q_medallion_end_to_end", READMISSION_SQL)
def q_medallion_end_to_end(spark, d):
    root = scratch_path(spark, "medallion")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    _stage_csv(o, f"{root}/landing/encounters", parts=4)
    _stage_csv(c, f"{root}/landing/patients", parts=2)
    strings = lambda cols: T.StructType([T.StructField(x, T.StringType()) for x in cols])
    encounters = Entity(
        name="encounters", schema=strings(o.columns), keys=["o_orderkey"], sequence=["o_orderdate"],
        clean={"o_orderkey": text("o_orderkey").try_cast("bigint"),
               "o_custkey": text("o_custkey").try_cast("bigint"),
               "o_orderdate": text("o_orderdate").try_cast("timestamp_ntz"),
               "o_orderstatus": text("o_orderstatus")},
        kind="upsert", max_files=2)
    patients = Entity(
        name="patients", schema=strings(c.columns), keys=["c_custkey"], sequence=["c_custkey"],
        clean={"c_custkey": text("c_custkey").try_cast("bigint"), "c_name": text("c_name"),
               "c_mktsegment": F.upper(text("c_mktsegment"))},
        tracked=["c_name", "c_mktsegment"], kind="scd1")
    silver = run_medallion(spark, [patients, encounters], f"{root}/landing", f"{root}/lake",
                           now=lambda b: NOW1)
    enc = silver["encounters"].select("o_orderkey", "o_custkey", "o_orderdate")
    return readmissions(enc, "o_custkey", "o_orderdate", tie_break=["o_orderkey"])


# --------------------------------------------------------------------------
# New checkpoints and late arrival
# --------------------------------------------------------------------------

def _two_runs(spark, d, root, writer):
    """Half the landing files through one checkpoint, the other half through a new one."""
    e = events(spark, d)
    half = F.pmod(F.xxhash64("user_id", "event_type"), F.lit(2))
    for n in range(2):
        e.filter(half == n).repartition(3, "user_id", "event_type").write.parquet(f"{root}/landing_{n}")
        foreach_batch_stream(_parquet_stream(spark, f"{root}/landing_{n}", e.schema), writer, f"{root}/_chk_{n}")


@register("q_stream_scd2_restart", SCD2_SQL)
def q_stream_scd2_restart(spark, d):
    root = scratch_path(spark, "scd2_restart")
    w = scd2_writer(f"{root}/silver", f"{root}/log", ["user_id"], ["event_type"], SEQ)
    _two_runs(spark, d, root, w)
    return published(spark, f"{root}/silver")


@register("q_stream_scd2_bucketed_restart", SCD2_SQL)
def q_stream_scd2_bucketed_restart(spark, d):
    root = scratch_path(spark, "scd2_bucketed_restart")
    w = bucketed_scd2_writer(f"{root}/silver", ["user_id"], ["event_type"], SEQ, buckets=16)
    _two_runs(spark, d, root, w)
    return bucketed_table(spark, w)


@register("q_stream_scd2_fast_restart", SCD2_SQL)
def q_stream_scd2_fast_restart(spark, d):
    root = scratch_path(spark, "scd2_fast_restart")
    w = FastScd2Writer(f"{root}/silver", ["user_id"], ["event_type"], SEQ, keep=2)
    _two_runs(spark, d, root, w)
    return w.history(spark)


@register("q_stream_scd1", SCD1_STATE_SQL)
def q_stream_scd1(spark, d):
    """SCD1 alone, by micro-batches that each span the whole time range."""
    root = scratch_path(spark, "scd1_stream")
    stage, schema = _stage_events_by_pair(spark, d, root, files=4)
    w = scd1_writer(f"{root}/silver", ["user_id"], ["event_type", "value"], lambda _: NOW1, sequence=SEQ,
                    is_delete=is_del(), keep=2)
    foreach_batch_stream(_parquet_stream(spark, stage, schema), w, f"{root}/_chk")
    return published(spark, f"{root}/silver").filter(~F.col("_is_deleted")).select(
        "user_id", "event_id", "ts", "event_type", "value")


@register("q_stream_change_feed_latest", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'error'")
def q_stream_change_feed_latest(spark, d):
    """Of three commits two are stored, one of them twice; a consumer that starts at "latest" gets the third, once."""
    root = scratch_path(spark, "cdf_latest")
    e = events(spark, d).select(*EV_COLS).withColumn("_change_type", F.lit("insert"))
    old, new = e.filter(~is_del()), e.filter(is_del())
    for version in (0, 1, 1):
        append_changes(old.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == version), f"{root}/log", version)
    schema = spark.read.parquet(f"{root}/log/_commit_version=0").schema
    stream = read_change_stream(spark, f"{root}/log", schema, from_version="latest", checkpoint=f"{root}/_chk")
    for _ in range(2):  # the commit, then its replay
        append_changes(new, f"{root}/log", 2)
        append_stream(stream, f"{root}/out", f"{root}/_chk")
    out = spark.read.parquet(f"{root}/out")
    return out.filter(F.col("_commit_timestamp").isNotNull()).select(*EV_COLS)


# --------------------------------------------------------------------------
# Production entities in their declared layouts
# --------------------------------------------------------------------------

def _patients(spark, d, second=False):
    """Customers as a full extract of patients; the second one lacks one segment and changed another."""
    c = table(spark, d, "customer")
    changed = F.col("c_mktsegment") == "BUILDING" if second else F.lit(False)
    out = c.select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("name"),
                   F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")).alias("dob"),
                   F.concat(F.lit("s-"), F.col("c_custkey").cast("string")).alias("ssn"),
                   F.when(changed, "x").otherwise(F.lit("f")).alias("gender"),
                   F.when(F.col("c_acctbal") > 0, "Yes").otherwise("No").alias("cancer_patient"), "c_mktsegment")
    return (out.filter(F.col("c_mktsegment") != "MACHINERY") if second else out).drop("c_mktsegment")


def _two_extracts(spark, d, entity):
    root = scratch_path(spark, entity.name)
    now = lambda version: (NOW1, NOW2)[min(version, 1)]
    for n in range(2):
        _stage_csv(_patients(spark, d, second=bool(n)), f"{root}/landing/{entity.name}/extract={n}", parts=3)
        entity.options = {"recursiveFileLookup": "true"}
        got = run_medallion(spark, [entity], f"{root}/landing", f"{root}/lake", now)[entity.name]
    return _declared(got, entity)


def _declared(df, entity):
    """The silver table, which must have the declared columns; a load time of the day becomes a flag."""
    if df.columns != entity.layout.fieldNames():
        raise ValueError(f"{df.columns} are not the declared columns")
    return df.withColumn("has_bronze_time", F.col("_bronze_load_datetime").isNotNull()).drop("_bronze_load_datetime")


PATIENT_SQL = """CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS name,
 CAST(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS DATE) AS dob, 's-' || c_custkey AS ssn,
 c_acctbal > 0 AS cancer_patient, true AS has_bronze_time"""


@register("q_medallion_patients_scd1", f"""
SELECT sha256(CAST(c_custkey AS VARCHAR)) AS patient_sk, {PATIENT_SQL},
 CASE WHEN c_mktsegment = 'BUILDING' THEN 'X' ELSE 'F' END AS gender, TIMESTAMP '{NOW1}' AS _created_datetime,
 CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN TIMESTAMP '{NOW2}' ELSE TIMESTAMP '{NOW1}' END AS _updated_datetime,
 CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '{NOW2}' ELSE TIMESTAMP '{NOW1}' END AS _silver_load_datetime,
 c_mktsegment = 'MACHINERY' AS _is_deleted FROM customer""")
def q_medallion_patients_scd1(spark, d):
    return _two_extracts(spark, d, production_entities()["patients_scd1"])


@register("q_medallion_patients_scd2", f"""
SELECT {PATIENT_SQL}, 'F' AS gender, TIMESTAMP '{NOW1}' AS scd_start_date,
 CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN TIMESTAMP '{NOW2}' END AS scd_end_date,
 c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS is_current, CAST(1 AS BIGINT) AS scd_version,
 TIMESTAMP '{NOW1}' AS _silver_load_datetime FROM customer
UNION ALL
SELECT {PATIENT_SQL}, 'X', TIMESTAMP '{NOW2}', NULL, true, CAST(2 AS BIGINT), TIMESTAMP '{NOW2}'
FROM customer WHERE c_mktsegment = 'BUILDING'""")
def q_medallion_patients_scd2(spark, d):
    return _two_extracts(spark, d, production_entities()["patients_scd2"])


@register("q_medallion_encounter_scd2", f"""
WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS Encounter_ID, CAST(o_custkey AS VARCHAR) AS Patient_ID,
  o_orderstatus AS Cancer_Disease_Status, CAST(o_orderdate AS DATE) AS Last_Update, o_orderpriority AS On_Treatment FROM orders),
k AS (SELECT * FROM (SELECT *, row_number() OVER w AS rn, lag(Cancer_Disease_Status) OVER w AS pc, lag(On_Treatment) OVER w AS pt
      FROM l WINDOW w AS (PARTITION BY Patient_ID ORDER BY Last_Update, Encounter_ID))
      WHERE rn = 1 OR pc IS DISTINCT FROM Cancer_Disease_Status OR pt IS DISTINCT FROM On_Treatment)
SELECT Encounter_ID, Patient_ID, Cancer_Disease_Status, Last_Update, On_Treatment, Last_Update AS scd_start_date,
 lead(Last_Update) OVER v AS scd_end_date, lead(Last_Update) OVER v IS NULL AS is_current,
 row_number() OVER v AS scd_version, TIMESTAMP '{NOW1}' AS _silver_load_datetime, true AS has_bronze_time
FROM k WINDOW v AS (PARTITION BY Patient_ID ORDER BY Last_Update, Encounter_ID)""")
def q_medallion_encounter_scd2(spark, d):
    root, e = scratch_path(spark, "encounter"), production_entities(max_files=2, buckets=8)["encounter"]
    o = table(spark, d, "orders")
    _stage_csv(o.select(F.col("o_orderkey").alias("Encounter_ID"), F.col("o_custkey").alias("Patient_ID"),
                        F.col("o_orderstatus").alias("Cancer_Disease_Status"),
                        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Last_Update"),
                        F.col("o_orderpriority").alias("On_Treatment")), f"{root}/landing/encounter", parts=4)
    got = run_medallion(spark, [e], f"{root}/landing", f"{root}/lake", lambda _: NOW1)["encounter"]
    return _declared(got, e)


@register("q_stream_auto_cdc_scd2", AUTO2_SQL)
def q_stream_auto_cdc_scd2(spark, d):
    """Type 2 over a stored change feed; its four commits each span the whole time range."""
    root = scratch_path(spark, "auto_cdc2_stream")
    e = events(spark, d).select(*EV_COLS)
    for version in range(4):
        append_changes(e.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == version), f"{root}/log", version)
    schema = spark.read.parquet(f"{root}/log/_commit_version=0").schema
    w = apply_changes_scd2_writer(f"{root}/silver", ["user_id"], SEQ, ["user_id", "ts", "event_type"], buckets=8,
                                  apply_as_deletes=is_del(), track_history_column_list=["event_type"],
                                  version_col="scd_version")
    foreach_batch_stream(read_change_stream(spark, f"{root}/log", schema, max_files=4), w, f"{root}/_chk")
    return bucketed_table(spark, w)


@register("q_stream_change_feed_restart", f"SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '{NOW1}'")
def q_stream_change_feed_restart(spark, d):
    """Two commits are there when a consumer starts at "latest".  One comes while it runs, three while it
    is down; it starts again, at "latest", twice: each of the four arrives once."""
    root = scratch_path(spark, "cdf_restart")
    e = events(spark, d).select(*EV_COLS).withColumn("_change_type", F.lit("insert"))
    new = F.col("ts") >= F.lit(NOW1).cast("timestamp_ntz")

    def commit(versions, rows):
        for v in versions:  # a quarter of the rows each
            append_changes(rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == (v + 2) % 4), f"{root}/log", v)

    def consume():
        schema = spark.read.parquet(f"{root}/log/_commit_version=0").schema
        stream = read_change_stream(spark, f"{root}/log", schema, from_version="latest", checkpoint=f"{root}/_chk")
        append_stream(stream, f"{root}/out", f"{root}/_chk")

    commit((0, 1), e.filter(~new))
    consume()
    commit((2,), e.filter(new))
    consume()
    commit((3, 4, 5), e.filter(new))
    consume()
    consume()
    return spark.read.parquet(f"{root}/out").select(*EV_COLS)


# --------------------------------------------------------------------------
# Full extracts that pile up; all entities of the job
# --------------------------------------------------------------------------

EXTRACT_DAYS = ["2024-01-05", "2024-01-10", "2024-01-15", "2024-01-20", "2024-01-25"]
EMPTY_DAY = "2024-01-15"  # this extract has no rows


def _extract_at(spark, d, day):
    """Users as they are at an instant: their last event before it, unless it deletes them."""
    e = events(spark, d).filter((F.col("ts") < F.lit(day).cast("timestamp_ntz")) & F.lit(day != EMPTY_DAY))
    return latest_per_key(e.select("user_id", "event_id", "ts", "event_type"), ["user_id"], SEQ).filter(~is_del())


_AT_SQL = "(VALUES " + ", ".join(f"({n}, TIMESTAMP '{day}')" for n, day in enumerate(EXTRACT_DAYS, 1)) + ") AS x(n, taken)"
EXTRACT_SERIES_SQL = f"""
WITH x AS (SELECT * FROM {_AT_SQL}),
p AS (SELECT x.n, x.taken, e.user_id, e.event_type,
        row_number() OVER (PARTITION BY x.n, e.user_id ORDER BY e.ts DESC, e.event_id DESC) AS rn
      FROM x JOIN events e ON e.ts < x.taken WHERE x.taken <> TIMESTAMP '{EMPTY_DAY}'),
r AS (SELECT n, taken, user_id, event_type FROM p WHERE rn = 1 AND event_type <> 'error'),
b AS (SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS begins
      FROM r WINDOW w AS (PARTITION BY user_id ORDER BY n)),
i AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY n) AS island FROM b),
g AS (SELECT user_id, island, min(event_type) AS event_type, min(taken) AS starts, max(n) AS last_n FROM i GROUP BY 1, 2)
SELECT user_id, event_type, starts AS scd_start_date, x.taken AS scd_end_date, x.taken IS NULL AS is_current,
  CAST(island AS BIGINT) AS scd_version FROM g LEFT JOIN x ON x.n = last_n + 1"""


@register("q_scd2_extract_series", EXTRACT_SERIES_SQL)
def q_scd2_extract_series(spark, d):
    """Two extracts are stored; three wait: one without rows, and the newest before the older one."""
    def rows(days):
        out = None
        for day in days:
            each = _extract_at(spark, d, day).select("user_id", "event_type").withColumn("_at", F.lit(day))
            out = each if out is None else out.unionByName(each)
        return out
    first, rest = EXTRACT_DAYS[:2], [EXTRACT_DAYS[4], EXTRACT_DAYS[2], EXTRACT_DAYS[3]]
    stored = cut(scd2_extract_series(None, rows(first), first, ["user_id"], ["event_type"]), "two_extracts")
    return scd2_extract_series(stored, rows(rest), rest, ["user_id"], ["event_type"])


@register("q_medallion_extract_series", EXTRACT_SERIES_SQL.replace("user_id, event_type, starts", "CAST(user_id AS VARCHAR) AS user_id, event_type, starts"))
def q_medallion_extract_series(spark, d):
    """Extracts in dated folders: two runs of two and three extracts; the third lacks its mark until all others are
    applied, so it comes late and the history is built again from all."""
    root = scratch_path(spark, "extract_series")
    cols = ["user_id", "event_type"]
    e = Entity("users", T.StructType([T.StructField(c, T.StringType()) for c in cols]), ["user_id"],
               ["event_type"], clean={c: text(c) for c in cols}, tracked=["event_type"], kind="scd2",
               source_kind="snapshot", extract_time="name", late="place")
    for days in (EXTRACT_DAYS[:2], EXTRACT_DAYS[3:], EXTRACT_DAYS[2:3]):
        for day in days:
            _stage_csv(_extract_at(spark, d, day).select(*cols), f"{root}/landing/users/at={day}")
        got = run_medallion(spark, [e], f"{root}/landing", f"{root}/lake", lambda _: NOW1)["users"]
    return got.select(*cols, "scd_start_date", "scd_end_date", "is_current", "scd_version")


@register("q_medallion_five_entities", """
WITH o AS (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders),
r AS (SELECT o_custkey, count(*) FILTER (WHERE datediff('day', prev, o_orderdate) <= 30) AS n_readmissions,
        max(CAST(o_orderdate AS DATE)) AS last_diagnosis FROM o GROUP BY 1),
s AS (SELECT o_custkey, arg_max(o_orderstatus, struct_pack(d := CAST(o_orderdate AS DATE), k := o_orderkey)) AS status
      FROM orders GROUP BY 1)
SELECT 'P' || c_custkey AS Patient_ID, c_name AS Name, s.status AS Cancer_Disease_Status,
  CASE WHEN c_acctbal > 0 THEN 'T1' ELSE 'T2' END AS TNM_Stage_Group, last_diagnosis,
  CAST(NULL AS BIGINT) AS n_observations, coalesce(n_readmissions, 0) AS n_readmissions
FROM customer LEFT JOIN r ON r.o_custkey = c_custkey LEFT JOIN s ON s.o_custkey = c_custkey""")
def q_medallion_five_entities(spark, d):
    """The job of five entities and its gold tables; no observation has landed yet."""
    root = scratch_path(spark, "five_entities")
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    patient = F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("Patient_ID")
    ordered = F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("Patient_ID")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    stage = lambda df, name: _stage_csv(df, f"{root}/landing/{name}")
    stage(c.select(patient, F.col("c_name").alias("Name"), F.lit("50").alias("Age"), F.lit("f").alias("Gender"),
                   F.lit("Yes").alias("Cancer_Patient")), "cancer_patient")
    # of a patient's states on a day the last order's holds: one row a day, as an entity's file would have it
    status = latest_per_key(o.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"),
                            ["o_custkey", "o_orderdate"], ["o_orderkey"])
    stage(status.select(ordered, F.col("o_orderstatus").alias("Cancer_Disease_Status"), day.alias("Last_Update"),
                        F.lit("Yes").alias("On_Treatment")), "cancer_disease_status")
    stage(o.select(ordered, F.lit("lung").alias("Primary_Cancer_Condition"), day.alias("Diagnosis_Date"),
                   F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("Hospital")), "primary_cancer_condition")
    stage(c.select(patient, F.when(F.col("c_acctbal") > 0, "t1").otherwise("t2").alias("TNM_Stage_Group"),
                   F.lit("1.5").alias("Tumor_Size_cm"), F.lit("No").alias("Node_Involvement"),
                   F.lit("No").alias("Metastasis")), "tnm_stage_group")
    entities = {e.name: e for e in oncology_entities(max_files=None, buckets=8)}
    entities["primary_cancer_condition"].keys.append("Hospital")  # a stand-in patient has several a day
    silver = run_medallion(spark, list(entities.values()), f"{root}/landing", f"{root}/lake", lambda _: NOW1)
    gold = oncology_gold(silver)
    again = gold["readmission_30d"].groupBy("Patient_ID").agg(F.sum("is_readmission_30d").alias("n_readmissions"))
    return gold["patient_360"].join(again, "Patient_ID", "left").select(
        "Patient_ID", "Name", "Cancer_Disease_Status", "TNM_Stage_Group", F.col("Diagnosis_Date").alias("last_diagnosis"),
        "n_observations", F.coalesce("n_readmissions", F.lit(0)).cast("bigint").alias("n_readmissions"))


# --------------------------------------------------------------------------
# The two-part SCD2 store
# --------------------------------------------------------------------------

def _thirds(spark, d, root, store):
    """Three commits by event id, each over the whole time range, through the store."""
    e = events(spark, d).select(*EV_COLS)
    for version in range(3):
        append_changes(e.filter(F.col("event_id") % 3 == version), f"{root}/log", version)
        schema = spark.read.parquet(f"{root}/log/_commit_version=0").schema
        foreach_batch_stream(read_change_stream(spark, f"{root}/log", schema), store, f"{root}/_chk")


@register("q_stream_scd2_two_part", _scd2_sql(deletes=True))
def q_stream_scd2_two_part(spark, d):
    """Events in time order, by weeks: keys go on from their open state, closed versions are only appended."""
    root = scratch_path(spark, "two_part")
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    e = events(spark, d)
    e.withColumn("_week", week).repartition("_week").drop("_week").sortWithinPartitions("ts") \
        .write.parquet(f"{root}/landing")
    store = Scd2Store(f"{root}/silver", ["user_id"], ["event_type"], SEQ, is_delete=is_del(), keep=2)
    foreach_batch_stream(_parquet_stream(spark, f"{root}/landing", e.schema, max_files=2), store, f"{root}/_chk")
    return store.history(spark)


@register("q_stream_scd2_growing_buckets", _scd2_sql(deletes=True))
def q_stream_scd2_growing_buckets(spark, d):
    """One bucket at first, and a size that later batches go past: it splits, and gives what fixed ones give."""
    root = scratch_path(spark, "growing")
    store = Scd2Store(f"{root}/silver", ["user_id"], ["event_type"], SEQ, is_delete=is_del(), depth=0,
                      bucket_bytes=4 << 10)
    _thirds(spark, d, root, store)
    if read_directory(spark, f"{root}/silver").count() < 2:
        raise ValueError("no bucket was split")
    return store.history(spark)


@register("q_bucketed_time_travel", " UNION ALL ".join(
    f"SELECT {n} AS version, * FROM ({_scd2_sql(where=f'event_id % 3 <= {n}', deletes=True)})" for n in range(3)))
def q_bucketed_time_travel(spark, d):
    """The history as it was after the first, the second and the last batch."""
    root = scratch_path(spark, "time_travel")
    store = Scd2Store(f"{root}/silver", ["user_id"], ["event_type"], SEQ, is_delete=is_del())
    _thirds(spark, d, root, store)
    out = [store.history(spark, version=n).select(F.lit(n).alias("version"), "*") for n in range(3)]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _current_sql(n):
    return f"SELECT user_id, event_type, scd_start_date, scd_version FROM ({_scd2_sql(where=f'event_id % 3 <= {n}', deletes=True)}) WHERE is_current"


def _feed_sql(n):
    """diff of the current rows after batch n - 1 and after batch n."""
    old = _current_sql(n - 1) if n else _current_sql(0) + " AND false"
    cols = ("event_type", "scd_start_date", "scd_version")
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in cols)
    images = [("insert", "n", "o.user_id IS NULL"), ("delete", "o", "n.user_id IS NULL"),
              ("update_preimage", "o", f"o.user_id = n.user_id AND ({changed})"),
              ("update_postimage", "n", f"o.user_id = n.user_id AND ({changed})")]
    return " UNION ALL ".join(
        f"SELECT {side}.user_id, {', '.join(f'{side}.{c}' for c in cols)}, '{kind}' AS _change_type, "
        f"CAST({n} AS BIGINT) AS _commit_version FROM ({old}) o FULL JOIN ({_current_sql(n)}) n ON o.user_id = n.user_id "
        f"WHERE {cond}" for kind, side, cond in images)


@register("q_stream_writer_feed", " UNION ALL ".join(_feed_sql(n) for n in range(3)))
def q_stream_writer_feed(spark, d):
    """The feed that the writer stores with each commit; it is the diff of each two versions."""
    root = scratch_path(spark, "writer_feed")
    store = Scd2Store(f"{root}/silver", ["user_id"], ["event_type"], SEQ, is_delete=is_del(), feed=True)
    _thirds(spark, d, root, store)
    feed = read_log(spark, f"{root}/silver/feed")
    return feed.drop("_commit_timestamp").withColumn("_commit_version", F.col("_commit_version").cast("bigint"))


# --------------------------------------------------------------------------
# Late rows at the mark
# --------------------------------------------------------------------------

@register("q_incremental_late_rows", """
SELECT event_id, user_id, ts, CASE WHEN ts < TIMESTAMP '2024-01-10' AND event_id % 10 <> 0 THEN 0
  WHEN ts < TIMESTAMP '2024-01-20' AND event_id % 10 <> 1 THEN 1 ELSE 2 END AS run
FROM (SELECT * REPLACE (date_trunc('day', ts) AS ts) FROM events)""")
def q_incremental_late_rows(spark, d):
    """Three runs over a growing table whose times are days, so that ties abound; a tenth of the rows comes a run late."""
    root = scratch_path(spark, "late_rows")
    e = events(spark, d).select("event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"))
    at = lambda day: F.col("ts") < F.lit(day).cast("timestamp_ntz")
    first = at("2024-01-10") & (F.col("event_id") % 10 != 0)
    second = at("2024-01-10") | (at("2024-01-20") & (F.col("event_id") % 10 != 1))
    reader = IncrementalReader(f"{root}/handled", "ts", ["event_id"], lookback="15 days")
    out = None
    for run, there in enumerate((first, second, F.lit(True))):
        new = cut(reader.read(e.filter(there)), f"run{run}")
        reader.commit(new, run)
        out = new.withColumn("run", F.lit(run)) if out is None else out.unionByName(new.withColumn("run", F.lit(run)))
    return out


# --------------------------------------------------------------------------
# Sources and triggers one by one
# --------------------------------------------------------------------------

@register("q_stream_new_files_only", "SELECT event_id, user_id FROM events WHERE event_type = 'error'")
def q_stream_new_files_only(spark, d):
    """Without existing files: only what lands after a stream's start time."""
    root = scratch_path(spark, "new_files")
    e = events(spark, d).select("event_id", "user_id", "event_type")
    e.filter(~is_del()).select("event_id", "user_id").write.json(f"{root}/landing")
    newest = read_files(spark, f"{root}/landing", None, fmt="json").select(
        F.max("_metadata.file_modification_time").cast("string")).first()[0]
    time.sleep(1.1)  # some file systems count whole seconds
    e.filter(is_del()).select("event_id", "user_id").write.mode("append").json(f"{root}/landing")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
    src = read_file_stream(spark, f"{root}/landing", schema, fmt="json", include_existing=False, start_time=newest)
    append_stream(src, f"{root}/bronze", f"{root}/_chk")
    return spark.read.parquet(f"{root}/bronze").select("event_id", "user_id")


@register("q_load_creates_or_merges", _latest_sql(cols="user_id, event_id, ts, event_type"))
def q_load_creates_or_merges(spark, d):
    """Each load asks whether its table is there: the first creates it, the second merges into it."""
    root = scratch_path(spark, "create_or_merge")
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type")
    for n in range(2):
        rows = latest_per_key(e.filter(F.col("event_id") % 2 == n), ["user_id"], SEQ)
        if path_exists(spark, f"{root}/table"):
            rows = upsert(read_snapshot(spark, f"{root}/table"), rows, ["user_id"], sequence=SEQ)
        publish_snapshot(rows, f"{root}/table", n)
    return read_snapshot(spark, f"{root}/table")


@register("q_stream_batch_view", "SELECT user_id, count(*) AS n_events, max(ts) AS last_ts FROM events GROUP BY user_id")
def q_stream_batch_view(spark, d):
    """SQL over a view of the micro-batch, merged with the state by SQL as well."""
    root = scratch_path(spark, "batch_view")
    stage, schema = _stage_events_by_type(spark, d, root)

    def build(batch, prev, _):
        batch.createOrReplaceTempView("incoming_updates")
        fresh = batch.sparkSession.sql("SELECT user_id, count(*) AS n_events, max(ts) AS last_ts FROM incoming_updates "
                                       "GROUP BY user_id")
        if prev is None:
            return fresh
        fresh.unionByName(prev).createOrReplaceTempView("both_states")
        return batch.sparkSession.sql("SELECT user_id, sum(n_events) AS n_events, max(last_ts) AS last_ts FROM both_states "
                                      "GROUP BY user_id")
    foreach_batch_stream(_parquet_stream(spark, stage, schema), SnapshotWriter(f"{root}/silver", build), f"{root}/_chk")
    return published(spark, f"{root}/silver")


@register("q_stream_processing_time", EVENTS_SQL)
def q_stream_processing_time(spark, d):
    """A stream that goes on by the clock until it is stopped, here when all files are through."""
    root = scratch_path(spark, "processing_time")
    stage, schema = _stage_events_by_type(spark, d, root)
    q = append_stream(_parquet_stream(spark, stage, schema), f"{root}/bronze", f"{root}/_chk",
                      trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(f"{root}/bronze")


def _sketch_sql(col: str, dups: str = "CAST(NULL AS BIGINT)", quantile: str = "CAST(NULL AS BOOLEAN)") -> str:
    return (f"SELECT '{col}' AS column_name, count(*) AS n_rows, count(*) - count({col}) AS n_null, "
            f"true AS distinct_ok, {quantile} AS median_ok, {dups} AS n_repeated FROM events")


@register("q_quality_sketches", " UNION ALL ".join([
    _sketch_sql("event_id", "(SELECT count(*) FROM (SELECT event_id FROM events WHERE event_id IS NOT NULL "
                            "GROUP BY event_id HAVING count(*) > 1))"),
    _sketch_sql("user_id"), _sketch_sql("event_type"), _sketch_sql("value", quantile="true")]))
def q_quality_sketches(spark, d):
    """Sketches of each micro-batch, merged over the stream, held against exact counts."""
    root = scratch_path(spark, "quality_sketches")
    stage, schema = _stage_events_by_type(spark, d, root)
    log = SketchLog(f"{root}/sketches", ["event_id", "user_id", "event_type", "value"], ["value"])
    foreach_batch_stream(_parquet_stream(spark, stage, schema), log.write, f"{root}/_chk")
    e, names = events(spark, d), log.columns
    report = log.report(spark, at=[0.5]).filter(F.col("column_name").isin(names))
    exact = e.agg(*[F.count_distinct(c).alias(c) for c in names]) \
        .select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact"))
                                    for c in names])).alias("x")).select("x.*")
    median = F.lit(report.filter("column_name = 'value'").first().quantiles[0])
    ranks = e.filter("value IS NOT NULL").agg(F.avg((F.col("value") < median).cast("int")).alias("below"),
                                              F.avg((F.col("value") <= median).cast("int")).alias("upto")).first()
    median_ok = ranks.below <= 0.5 + KLL_ERROR and ranks.upto >= 0.5 - KLL_ERROR
    repeated = {k: v.count() for k, v in log.duplicates(e, ["event_id", "user_id"]).items()}
    n_repeated = F.coalesce(*[F.when(F.col("column_name") == k, F.lit(n).cast("bigint")) for k, n in repeated.items()],
                            F.lit(None).cast("bigint"))
    return report.join(exact, "column_name").select(
        "column_name", "n_rows", "n_null",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= HLL_ERROR * F.col("exact") + 0.5).alias("distinct_ok"),
        F.when(F.col("quantiles").isNotNull(), F.lit(median_ok)).alias("median_ok"),
        n_repeated.alias("n_repeated"))


@register("q_quarantine_replay", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'EXTRA' END AS o_note
FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""")
def q_quarantine_replay(spark, d):
    """Lines with a column too many heal under the next schema; two replays, of which the second adds nothing."""
    root = scratch_path(spark, "quarantine_replay")
    o, late = table(spark, d, "orders"), F.col("o_orderpriority")
    price = F.when(late == "4-NOT SPECIFIED", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus",
                       price, F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(late == "5-LOW", F.lit("EXTRA")))
    o.select(line.alias("value")).write.text(f"{root}/landing")
    log = SchemaLog(f"{root}/schema")
    log.widen(spark, RESCUE_SCHEMA)
    src = read_file_stream(spark, f"{root}/landing", log.read(spark), options={"header": "false"}, max_files=2)
    append_stream(with_ingest_metadata(src), f"{root}/bronze", f"{root}/_chk")
    bronze = spark.read.parquet(f"{root}/bronze")
    log.widen(spark, T.StructType([*RESCUE_SCHEMA.fields, T.StructField("o_note", T.StringType())]))
    quarantine, names = bronze.filter(F.col(RESCUE_COL).isNotNull()), log.read(spark).fieldNames()
    silver = bronze.filter(F.col(RESCUE_COL).isNull()).select(*[c for c in names if c in bronze.columns])
    for _ in range(2):
        healed = replay_quarantine(quarantine, log.read(spark), f"{root}/healed")
        if healed is not None:
            silver = silver.unionByName(healed, allowMissingColumns=True)
    return silver.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_note")
