"""Two histories joined, late rows at the mark, the writer's own change feed, state on disk."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lakeledger.operators.changes import diff
from lakeledger.operators.histories import join_histories
from lakeledger.operators.incremental import IncrementalReader
from lakeledger.session import scratch_path
from lakeledger.sources.snapshots import read_log
from lakeledger.streaming.scd2_store import Scd2Store
from lakeledger.streaming.silver import stream_dedup
from lakeledger.streaming.sinks import append_stream, state_on_disk

HISTORY = "k int, {} string, scd_start_date int, scd_end_date int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_history(rng, letters):
    """Versions that do not overlap, with gaps and empty ones."""
    out = []
    for k in [None, *range(5)]:
        cuts = sorted(rng.choices(range(20), k=rng.randint(0, 8)))
        spans = list(zip(cuts, [*cuts[1:], None]))
        out += [(k, rng.choice(letters), s, e) for s, e in spans if rng.random() < 0.7]
    return out


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_joined_histories_at_every_instant(spark, hot, how):
    rng = random.Random(len(how))
    a, b = random_history(rng, "abc"), random_history(rng, "xyz")
    got = join_histories(spark.createDataFrame(a, HISTORY.format("v")), spark.createDataFrame(b, HISTORY.format("w")),
                         ["k"], ["v"], ["w"], how).collect()
    at = lambda h, k, t: next((r[1] for r in h if r[0] == k and r[2] <= t and (r[3] is None or t < r[3])), None)
    for k in range(5):
        for t in range(22):
            want = (at(a, k, t), at(b, k, t))
            there = {"inner": None not in want, "left": want[0] is not None, "full": want != (None, None)}[how]
            now = [(r.v, r.w) for r in got if r.k == k and r.scd_start_date <= t and (r.scd_end_date is None or t < r.scd_end_date)]
            assert now == ([want] if there else [])
    assert all(r.k is not None for r in got)


def test_late_rows_are_handed_out_once(spark):
    day = lambda n: f"2024-01-{n:02d} 00:00:00"
    make = lambda rows_: spark.createDataFrame(rows_, "id int, t string").select("id", F.col("t").cast("timestamp_ntz").alias("ts"))
    first = [(1, day(5)), (2, day(10)), (2, day(10)), (None, day(9)), (9, None)]
    later = first + [(3, day(10)), (4, day(8)), (5, day(1)), (6, day(12))]  # a tie, two late ones, a new one
    for lookback, want in (("3 days", [(3,), (4,), (6,)]), (None, [(3,), (4,), (5,), (6,)])):
        r = IncrementalReader(scratch_path(spark, "handled"), "ts", ["id"], lookback)
        got = r.read(make(first))
        assert rows(got.select("id")) == sorted([(1,), (2,), (9,), (None,)], key=repr)
        r.commit(got, 0)
        assert r.read(make(first)).count() == 0
        got = r.read(make(later))
        assert rows(got.select("id")) == want
        r.commit(got, 1)
        r.commit(make([(7, day(12))]), 1)  # a run that was committed stays as it is
        assert rows(r.read(make(later + [(7, day(12))])).select("id")) == [(7,)]


def test_the_writers_feed_is_the_diff_of_each_two_versions(spark):
    base = scratch_path(spark, "feed")
    ev = "k int, seq int, v string, del boolean"
    store = Scd2Store(base, ["k"], ["v"], ["seq"], is_delete=F.col("del"), feed=True, depth=1)
    batches = [[(1, 1, "a", False), (2, 1, "a", False), (None, 1, "n", False)],
               [(1, 2, "b", False), (2, 2, None, True), (3, 2, None, True), (None, 2, "m", False)],
               [(2, 3, "c", False), (1, 0, "late", False), (4, 9, "d", False), (4, 10, None, True)]]
    for n, batch in enumerate(batches):
        for _ in range(2):  # a replay stores no second feed
            store(spark.createDataFrame(batch, ev), n)
    feed = read_log(spark, f"{base}/feed")
    for n in range(3):
        now = store.history(spark, version=n).filter("is_current")
        old = store.history(spark, version=n - 1).filter("is_current") if n else now.limit(0)
        cols = ["v", "scd_start_date", "scd_version"]
        key = F.coalesce("k", F.lit(-1)).alias("k")  # diff meets keys by equality
        want = diff(old.select(key, *cols), now.select(key, *cols), ["k"], cols)
        got = feed.filter(F.col("_commit_version") == n).select(key, *cols, "_change_type")
        assert rows(got) == rows(want)


def test_dedup_state_is_on_disk_and_stays_so(spark):
    root = scratch_path(spark, "rocksdb")
    spark.range(100).repartition(2).write.parquet(f"{root}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def run(partitions):
        s = spark.readStream.schema("id long").parquet(f"{root}/in")
        with state_on_disk(spark, partitions):
            return append_stream(stream_dedup(s, ["id"]), f"{root}/out", f"{root}/chk")

    q = run(3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    op = q.lastProgress["stateOperators"][0]
    assert op["numRowsTotal"] == 100 and op["numShufflePartitions"] == 3
    assert any(k.startswith("rocksdb") for k in op["customMetrics"])
    spark.range(50, 150).write.mode("append").parquet(f"{root}/in")
    q = run(7)  # the checkpoint's number holds
    op = q.lastProgress["stateOperators"][0]
    assert op["numRowsTotal"] == 150 and op["numShufflePartitions"] == 3
    assert spark.read.parquet(f"{root}/out").count() == 150
    conf = json.loads(spark.read.text(f"{root}/chk/offsets/0").collect()[1].value)["conf"]
    assert conf["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
