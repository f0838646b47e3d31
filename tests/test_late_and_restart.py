"""Late data, replays, restarts, empty batches, retention: a few rows each."""

import pytest
from pyspark.sql import functions as F

from lakeledger.operators.cdc import apply_changes
from lakeledger.operators.changes import incremental_since
from lakeledger.operators.merge import scd1_apply, upsert, without_tombstones
from lakeledger.operators.scd2 import scd2_apply_snapshot
from lakeledger.session import scratch_path
from lakeledger.sources.schemas import load_schema, save_schema
from lakeledger.sources.snapshots import append_changes, list_versions, publish_snapshot, read_log, read_snapshot
from lakeledger.streaming.silver import (FastScd2Writer, bucketed_scd2_writer, bucketed_apply_changes_writer,
                                         bucketed_table, scd2_writer)

EV = "k int, v string, seq int, del boolean"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def scd1(spark, state, batch):
    return scd1_apply(state, spark.createDataFrame(batch, EV), ["k"], ["v"], "2024-01-01 00:00:00",
                      sequence=["seq"], is_delete=F.col("del"), except_column_list=["del"], keep_tombstones=True)


def test_unchanged_row_advances_the_stored_sequence(spark):
    s = scd1(spark, None, [(1, "a", 1, False)])
    s = scd1(spark, s, [(1, "a", 5, False)])
    s = scd1(spark, s, [(1, "b", 3, False)])
    assert [(r.v, r.seq) for r in s.collect()] == [("a", 5)]


def test_delete_of_an_unknown_key_beats_an_older_row(spark):
    s = scd1(spark, None, [(1, "u", 10, None), (1, None, 20, True), (None, "x", 1, False)])
    s = scd1(spark, s, [(1, "late", 15, False), (2, None, 9, True)])
    s = scd1(spark, s, [(2, "late", 4, False)])
    assert without_tombstones(s).count() == 0
    s = scd1(spark, s, [(2, "new", 30, False)])
    assert [(r.k, r.v, r._is_deleted) for r in without_tombstones(s).collect()] == [(2, "new", False)]


def test_upsert_compares_the_stored_sequence_and_rejects_null_keys(spark):
    t = spark.createDataFrame([(1, "new", 10)], "k int, v string, seq int")
    b = spark.createDataFrame([(1, "old", 5), (2, "b", 1), (None, "n", 1)], "k int, v string, seq int")
    once = upsert(t, b, ["k"], sequence=["seq"])
    assert rows(once) == rows(upsert(once, b, ["k"], sequence=["seq"])) == [(1, "new", 10), (2, "b", 1)]


def test_first_run_without_a_mark_reads_all(spark):
    df = spark.createDataFrame([(1,), (2,)], "t int")
    assert incremental_since(df, "t", df.limit(0)).count() == incremental_since(df, "t", None).count() == 2
    assert rows(incremental_since(df, "t", df.filter("t = 1"))) == [(2,)]


def test_type_2_refuses_a_target(spark):
    df = spark.createDataFrame([(1, "a", 1, False)], EV)
    with pytest.raises(ValueError, match="whole log"):
        apply_changes(df, ["k"], "seq", stored_as_scd_type=2, target=df)


def test_partitioned_snapshot_is_visible_and_old_ones_go(spark):
    base = scratch_path(spark, "snap")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    for v in range(4):
        publish_snapshot(df, base, v, partition_by=["p"], keep=2)
    assert list_versions(spark, base) == [2, 3] and rows(read_snapshot(spark, base)) == rows(df)


def test_a_replayed_commit_is_stored_once(spark):
    log = scratch_path(spark, "feed")
    for v in (1, 0):
        append_changes(spark.createDataFrame([(v,)], "x int"), log, 0)
    got = read_log(spark, log).collect()
    assert [r.x for r in got] == [1] and got[0]._commit_timestamp is not None


def test_schema_errors_are_not_taken_for_absence(spark):
    root = scratch_path(spark, "schema")
    assert load_schema(spark, f"{root}/none") is None
    df = spark.createDataFrame([(1,)], "x int")
    save_schema(spark, df.schema, f"{root}/s")
    assert load_schema(spark, f"{root}/s") == df.schema
    spark.createDataFrame([("no json",)], "t string").write.text(f"{root}/bad")
    with pytest.raises(ValueError):
        load_schema(spark, f"{root}/bad")


def test_bucketed_stream_survives_a_first_batch_of_deletes(spark):
    base = scratch_path(spark, "deletes")
    w = bucketed_scd2_writer(base, ["k"], ["v"], ["seq"], 4, is_delete=F.col("del"))
    w(spark.createDataFrame([(1, "a", 1, True)], EV), 0)
    w(spark.createDataFrame([(1, "a", 2, False), (2, "b", 1, False)], EV), 1)
    assert sorted((r.k, r.v) for r in bucketed_table(spark, w).collect()) == [(1, "a"), (2, "b")]


def test_one_key_writes_one_bucket(spark):
    base = scratch_path(spark, "one_bucket")
    w = bucketed_apply_changes_writer(base, ["k"], ["seq"], 8)
    w(spark.createDataFrame([(k, "a", 1, False) for k in range(40)], EV), 0)
    before = {r[0] for r in spark.read.parquet(f"{base}/table").select("_metadata.file_path").collect()}
    w(spark.createDataFrame([(7, "b", 2, False)], EV), 1)
    after = {r[0] for r in spark.read.parquet(f"{base}/table").select("_metadata.file_path").collect()}
    folders = {p.split("/")[-2] for p in after ^ before}
    assert len(folders) == 1 and bucketed_table(spark, w).filter("v = 'b'").count() == 1


@pytest.mark.parametrize("kind", ["snapshot", "bucketed", "fast"])
def test_a_restart_by_hand_is_refused_until_it_names_its_offset(spark, kind):
    base = scratch_path(spark, f"restart_{kind}")
    make = {"snapshot": lambda **kw: scd2_writer(f"{base}/t", f"{base}/log", ["k"], ["v"], ["seq"], **kw),
            "bucketed": lambda **kw: bucketed_scd2_writer(base, ["k"], ["v"], ["seq"], 4),
            "fast": lambda **kw: FastScd2Writer(base, ["k"], ["v"], ["seq"], **kw)}[kind]
    w = make()
    for n, v in enumerate("abc"):
        w(spark.createDataFrame([(1, v, n, False)], EV), n)
    with pytest.raises(RuntimeError, match="offset=3"):
        w(spark.createDataFrame([(1, "d", 9, False)], EV), 0)
    again = make(offset=3)
    again.offset = 3
    again(spark.createDataFrame([(1, "d", 9, False)], EV), 0)
    got = (read_snapshot(spark, f"{base}/t") if kind == "snapshot" else
           bucketed_table(spark, again) if kind == "bucketed" else again.history(spark))
    assert [r.v for r in got.orderBy("scd_version").collect()] == ["a", "b", "c", "d"]


def test_full_extracts_close_reopen_and_count_versions(spark):
    def step(state, rows_, at):
        df = spark.createDataFrame(rows_, "k int, v string")
        out = scd2_apply_snapshot(state, df, ["k"], ["v"], at)
        return spark.createDataFrame(out.collect(), out.schema)
    s = step(None, [(1, "a"), (2, "b")], "2024-01-01 00:00:00")
    s = step(s, [(1, "a"), (3, None)], "2024-01-02 00:00:00")
    s = step(s, [(1, "c"), (2, "b"), (3, None)], "2024-01-03 00:00:00")
    got = [(r.k, r.v, r.scd_start_date.day, r.scd_end_date and r.scd_end_date.day, r.is_current, r.scd_version)
           for r in s.orderBy("k", "scd_version").collect()]
    assert got == [(1, "a", 1, 3, False, 1), (1, "c", 3, None, True, 2), (2, "b", 1, 2, False, 1),
                   (2, "b", 3, None, True, 2), (3, None, 2, None, True, 1)]
