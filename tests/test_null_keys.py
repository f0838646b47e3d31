"""The rule for NULL keys (see lakeledger.operators), and a consumer's durable start."""

import pytest

from lakeledger.operators.cdc import apply_changes
from lakeledger.operators.merge import merge_changed_only, new_keys, scd1_apply
from lakeledger.operators.scd2 import (as_of_join, scd2_append_latest, scd2_apply, scd2_apply_fast,
                                       scd2_apply_snapshot, scd2_history, scd2_key_state)
from lakeledger.session import scratch_path
from lakeledger.sources.snapshots import append_changes, consumer_start, read_change_stream
from lakeledger.streaming.sinks import append_stream

EV = "k int, seq int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_incremental_forms_equal_a_rebuild_with_null_keys(spark):
    log = spark.createDataFrame([(None, 1, "a"), (1, 1, "x"), (None, 2, "b"), (None, 3, "b"), (2, 2, "y")], EV)
    old, batch = log.filter("seq < 2"), log.filter("seq >= 2")
    target = scd2_history(old, ["k"], ["v"], ["seq"])
    want = rows(scd2_history(log, ["k"], ["v"], ["seq"]))
    assert rows(scd2_apply(target, log, batch, ["k"], ["v"], ["seq"])) == want
    out, state = scd2_apply_fast(target, scd2_key_state(old, ["k"], ["seq"]), batch, None, ["k"], ["v"], ["seq"])
    assert rows(out) == want
    assert rows(state.select("k", "_last_seq.seq")) == [(1, 1), (2, 2), (None, 3)]
    late = spark.createDataFrame([(None, 0, "z")], EV)
    out, _ = scd2_apply_fast(out, state, late, log.unionByName(late), ["k"], ["v"], ["seq"])
    assert rows(out) == rows(scd2_history(log.unionByName(late), ["k"], ["v"], ["seq"]))


def test_append_latest_goes_on_from_the_null_keys_version(spark):
    cur = scd2_history(spark.createDataFrame([(None, 1, "a"), (1, 1, "x")], EV), ["k"], ["v"], ["seq"])
    new = spark.createDataFrame([(None, 5, "b"), (1, 5, "x"), (2, 5, "n")], EV)
    got = scd2_append_latest(cur, new, ["k"], ["v"], "seq")
    assert rows(got) == sorted([(None, "a", 1, 5, False, 1), (None, "b", 5, None, True, 2), (2, "n", 5, None, True, 1)], key=repr)


def test_merges_reject_null_keys(spark):
    b = spark.createDataFrame([(None, 1, "a"), (1, 1, "x")], EV)
    state = None
    for _ in range(3):
        state = apply_changes(b, ["k"], ["seq"], target=state, keep_tombstones=True)
    assert rows(state) == [(1, 1, "x", False)]
    assert rows(apply_changes(b, ["k"], ["seq"], stored_as_scd_type=2).select("k")) == [(1,)]
    once = merge_changed_only(b.limit(0), b, ["k"], ["v"]).drop("_merge_action")
    assert rows(merge_changed_only(once, b, ["k"], ["v"]).select("k", "_merge_action")) == [(1, "unchanged")]
    assert new_keys(b, once, ["k"]).count() == 0
    snap = None
    for day in (1, 2, 3):
        snap = scd2_apply_snapshot(snap, b, ["k"], ["v"], f"2024-01-0{day} 00:00:00")
    assert rows(snap.select("k", "scd_version")) == [(1, 1)]
    assert rows(scd1_apply(None, b, ["k"], ["v"], "2024-01-01 00:00:00").select("k")) == [(1,)]


def test_a_fact_with_a_null_key_finds_no_version(spark):
    h = scd2_history(spark.createDataFrame([(None, 1, "a"), (1, 1, "x")], EV), ["k"], ["v"], ["seq"])
    f = spark.createDataFrame([(None, 7, 1), (1, 7, 2), (3, 7, 3)], "k int, t int, id int")
    got = as_of_join(f, h, ["k"], "t", ["v"], fact_order=["id"])
    assert rows(got) == sorted([(None, 7, 1, None), (1, 7, 2, "x"), (3, 7, 3, None)], key=repr)


def test_a_consumer_keeps_its_start(spark):
    root = scratch_path(spark, "consumer")

    def store(v):
        append_changes(spark.createDataFrame([(v,)], "x int"), f"{root}/log", v)

    def consume(start):
        schema = spark.read.parquet(f"{root}/log/_commit_version=0").schema
        s = read_change_stream(spark, f"{root}/log", schema, start, checkpoint=f"{root}/chk")
        append_stream(s, f"{root}/out", f"{root}/chk")
        return rows(spark.read.parquet(f"{root}/out").select("x"))

    store(0)
    assert consume("latest") == []
    store(1)
    assert consume("latest") == [(1,)]
    store(2)
    store(3)
    assert consume("latest") == [(1,), (2,), (3,)]
    assert consume(0) == [(1,), (2,), (3,)]  # what was decided first holds
    assert consumer_start(spark, f"{root}/log", f"{root}/other", "latest") == 4
    with pytest.raises(ValueError, match="checkpoint"):
        read_change_stream(spark, f"{root}/log", spark.createDataFrame([(1,)], "x int").schema, "latest")
