"""File streams, rescue, exactly-once progress and idempotent silver batches."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.session import scratch_path
from lakeledger.sources.files import RESCUE_COL, read_file_stream, with_ingest_metadata
from lakeledger.sources.schemas import LANDING, all_strings, describe_schema, infer_or_load_schema, read_layout
from lakeledger.sources.snapshots import list_versions, read_snapshot
from lakeledger.streaming.silver import SnapshotWriter, apply_changes_writer, published
from lakeledger.streaming.sinks import append_stream

PATIENT_CSV = ("Patient_ID,Name,Age,Gender,Cancer_Patient\n"
               "P001,Ann Lee,54,Female,Yes\n"
               "P002,\"Smith, Bo\",61,Male,Yes\n"
               "P003,Cy Ng,not-a-number,Male,Yes\n"
               "P004,Di,40,Female,Yes,EXTRA\n"
               "\n\n")


def _write(path, name, text):
    # Test fixture files on the local test checkpoint folder (set because none is configured).
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def _local(p):
    return p.replace("file:", "", 1)


def test_two_waves_read_each_file_once_and_rescue_bad_rows(spark):
    root = scratch_path(spark, "waves")
    landing, out, chk = f"{root}/landing", f"{root}/bronze", f"{root}/_chk"
    _write(_local(landing), "a.csv", PATIENT_CSV)
    schema = read_layout(LANDING["cancer_patient"])
    append_stream(with_ingest_metadata(read_file_stream(spark, landing, schema, max_files=1)), out, chk)
    first = spark.read.parquet(out)
    assert first.count() == 4                                    # blank trailing lines skipped
    bad = {r.Patient_ID: r[RESCUE_COL] for r in first.filter(F.col(RESCUE_COL).isNotNull()).collect()}
    assert set(bad) == {"P003", "P004"}                           # kept with their raw text
    assert "not-a-number" in bad["P003"]
    p2 = first.filter(F.col("Patient_ID") == "P002").first()
    assert p2.Name == "Smith, Bo" and p2.Cancer_Patient == "Yes"
    _write(_local(landing), "b.csv", "Patient_ID,Name,Age,Gender,Cancer_Patient\nP005,Eve,33,Female,No\n")
    append_stream(with_ingest_metadata(read_file_stream(spark, landing, schema, max_files=1)), out, chk)
    second = spark.read.parquet(out)
    assert second.count() == 5                                   # a.csv not read again
    assert second.select("_batch_id").distinct().count() == 2    # one id per micro-batch


def test_string_only_stream_and_schema_persistence(spark):
    root = scratch_path(spark, "strings")
    _write(_local(f"{root}/landing"), "a.csv", PATIENT_CSV)
    s = read_file_stream(spark, f"{root}/landing", all_strings(LANDING["cancer_patient"]), rescue=False)
    append_stream(s, f"{root}/bronze", f"{root}/_chk")
    assert {f.dataType for f in spark.read.parquet(f"{root}/bronze").schema.fields} == {T.StringType()}
    inferred = infer_or_load_schema(spark, f"{root}/landing", f"{root}/_schema")
    again = infer_or_load_schema(spark, f"{root}/bronze_unused", f"{root}/_schema")  # loaded, not inferred
    assert inferred == again
    rows = {r.column_name: r.data_type for r in describe_schema(spark, f"{root}/_schema").collect()}
    assert rows["Patient_ID"] == "string"


def test_replayed_batch_id_gives_identical_version(spark):
    root = scratch_path(spark, "replay")
    sch = "k int, seq long, v string, op string"
    w = apply_changes_writer(f"{root}/silver", ["k"], ["seq"], apply_as_deletes=F.col("op") == "D",
                             except_column_list=["op"])
    b0 = spark.createDataFrame([(1, 1, "a", "U"), (2, 1, "b", "U")], sch)
    b1 = spark.createDataFrame([(1, 2, "a2", "U"), (2, 3, None, "D"), (2, 2, "late", "U")], sch)
    w(b0, 0)
    w(b1, 1)
    first = sorted(read_snapshot(spark, f"{root}/silver", version=1).collect())
    w(b1, 1)                                                     # replay after a failure
    assert sorted(read_snapshot(spark, f"{root}/silver", version=1).collect()) == first
    assert list_versions(spark, f"{root}/silver") == [0, 1]
    assert sorted(published(spark, f"{root}/silver").collect()) == [(1, 2, "a2")]
    w(spark.createDataFrame([], sch), 2)                         # empty batch publishes nothing
    assert list_versions(spark, f"{root}/silver") == [0, 1]


def test_snapshot_writer_reads_version_below_its_own(spark):
    root = scratch_path(spark, "below")
    seen = []

    def build(batch, prev, bid):
        seen.append(None if prev is None else prev.count())
        return batch if prev is None else prev.unionByName(batch)

    w = SnapshotWriter(f"{root}/t", build)
    df = spark.createDataFrame([(1,)], "x int")
    w(df, 0)
    w(df, 1)
    w(df, 1)
    assert seen == [None, 1, 1]


def test_reordered_csv_header_fails_instead_of_binding_by_position(spark):
    import pytest
    root = scratch_path(spark, "headers")
    _write(_local(root), "a.csv", "id,name\n1,a\n")
    _write(_local(root), "b.csv", "name,id\nb,2\n")
    sch = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    from lakeledger.sources.files import read_files
    with pytest.raises(Exception):
        read_files(spark, root, sch).collect()


def test_json_landing_and_include_existing_false(spark):
    import datetime as dt
    import time
    root = scratch_path(spark, "json")
    _write(_local(f"{root}/landing"), "old.json", '{"id": 1, "name": "old"}\n')
    time.sleep(1.5)
    start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    time.sleep(1.5)
    _write(_local(f"{root}/landing"), "new.json", '{"id": 2, "name": "new"}\n{"id": "x", "name": "bad"}\n')
    sch = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    s = read_file_stream(spark, f"{root}/landing", sch, fmt="json", include_existing=False,
                         start_time=start.strftime("%Y-%m-%d %H:%M:%S"))
    append_stream(s, f"{root}/bronze", f"{root}/_chk")
    got = {r.name: r[RESCUE_COL] is not None for r in spark.read.parquet(f"{root}/bronze").collect()}
    assert got == {"new": False, "bad": True}


def test_sql_over_micro_batch_view(spark):
    root = scratch_path(spark, "view")

    def build(batch, prev, bid):
        batch.createOrReplaceTempView("incoming_updates")
        return batch.sparkSession.sql(
            "SELECT k, max(v) AS v FROM incoming_updates GROUP BY k")

    w = SnapshotWriter(f"{root}/t", build)
    w(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), 0)
    assert read_snapshot(spark, f"{root}/t").collect() == [(1, "b")]


def test_bucketed_scd1_equals_snapshot_scd1(spark):
    import random
    from lakeledger.streaming.silver import bucketed_scd1_writer, bucketed_table, scd1_writer
    rnd = random.Random(5)
    sch = "k int, seq long, v string, op string"
    batches = [[(rnd.randint(1, 20), b * 100 + i, rnd.choice("abc"), rnd.choice("UUUD")) for i in range(15)]
               for b in range(4)]
    root = scratch_path(spark, "b_scd1")
    d = F.col("op") == "D"
    now = lambda b: f"2024-01-0{b + 1} 00:00:00"
    plain = scd1_writer(f"{root}/plain", ["k"], ["v"], now, sequence=["seq"], is_delete=d)
    buck = bucketed_scd1_writer(f"{root}/buck", ["k"], ["v"], now, buckets=4, sequence=["seq"],
                                is_delete=d, except_column_list=["op"])
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, sch)
        plain(df, i)
        buck(df, i)
    want = sorted(map(repr, published(spark, f"{root}/plain").drop("op").collect()))
    got = sorted(map(repr, bucketed_table(spark, buck).select(*published(spark, f"{root}/plain").drop("op").columns).collect()))
    assert got == want


def test_create_table_if_absent_keeps_declared_layout(spark):
    from lakeledger.sources.schemas import PATIENTS_SILVER_SCD1
    from lakeledger.sources.snapshots import create_table_if_absent
    root = scratch_path(spark, "ddl")
    assert create_table_if_absent(spark, f"{root}/patients", PATIENTS_SILVER_SCD1)
    assert not create_table_if_absent(spark, f"{root}/patients", PATIENTS_SILVER_SCD1)
    got = spark.read.parquet(f"{root}/patients")
    assert [(f.name, f.dataType) for f in got.schema.fields] == \
        [(f.name, f.dataType) for f in PATIENTS_SILVER_SCD1.fields]
    assert got.count() == 0


def test_processing_time_trigger_keeps_running_until_stopped(spark):
    root = scratch_path(spark, "continuous")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.write.parquet(f"{root}/landing/a")
    q = append_stream(spark.readStream.schema(e.schema).parquet(f"{root}/landing/a"), f"{root}/bronze",
                      f"{root}/_chk", trigger={"processingTime": "1 second"})
    try:
        assert q.isActive
        q.processAllAvailable()
        assert spark.read.parquet(f"{root}/bronze").count() == e.count()
    finally:
        q.stop()
    assert not q.isActive


def test_restarted_checkpoint_must_pass_an_offset(spark):
    import pytest
    root = scratch_path(spark, "offset")
    w = SnapshotWriter(f"{root}/t", lambda b, prev, i: b if prev is None else prev.unionByName(b))
    df = spark.createDataFrame([(1,)], "x int")
    w(df, 0)
    w(df, 1)
    with pytest.raises(RuntimeError, match="offset=2"):
        w(df, 0)                      # a new checkpoint starts again at batch 0
    SnapshotWriter(f"{root}/t", w.build, offset=2)(df, 0)
    assert list_versions(spark, f"{root}/t") == [0, 1, 2]
    assert read_snapshot(spark, f"{root}/t").count() == 3
