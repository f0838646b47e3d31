"""The two-part SCD2 store against a rebuild of the whole log, batch by batch."""

import random

import pytest
from pyspark.sql import functions as F

from lakeledger.operators.scd2 import scd2_history
from lakeledger.session import scratch_path
from lakeledger.streaming.scd2_store import Scd2Store, read_directory

EV = "k int, seq int, id int, v string, w string, del boolean"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def whole(spark, events):
    return rows(scd2_history(spark.createDataFrame(events, EV), ["k"], ["v"], ["seq", "id"], is_delete=F.col("del"),
                             columns=["v", "w"]))


def files(spark, path):
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return {r.path: (r.length, r.modificationTime) for r in df.load(path).select("path", "length", "modificationTime").collect()}


def make(base, **kw):
    return Scd2Store(base, ["k"], ["v"], ["seq", "id"], is_delete=F.col("del"), columns=["v", "w"], **kw)


def random_batches(seed, batches, size, keys, late):
    rng, n, out = random.Random(seed), 0, []
    for b in range(batches):
        batch = []
        for _ in range(size):
            n += 1
            seq = b * 10 + rng.randint(0, 9) - (rng.randint(1, 30) if rng.random() < late else 0)
            batch.append((rng.choice([None, *range(keys)]), seq, n, rng.choice("abc"), str(n), rng.random() < 0.25))
        out.append(batch)
    return out


@pytest.mark.parametrize("seed,late,bucket_bytes", [(1, 0.0, 1 << 30), (3, 0.25, 700)])
def test_store_equals_a_rebuild_after_each_batch(spark, seed, late, bucket_bytes):
    """With deletes, NULL keys, late events; the last case splits its buckets all the time."""
    base = scratch_path(spark, "store")
    store, seen, closed, wants = make(base, depth=1, bucket_bytes=bucket_bytes), [], {}, []
    for n, batch in enumerate(random_batches(seed, 3, 30, 12, late)):
        store(spark.createDataFrame(batch, EV), n)
        seen += batch
        wants.append(whole(spark, seen))
        assert rows(store.history(spark)) == wants[-1]
        now = files(spark, f"{base}/closed")
        assert {p: now[p] for p in closed} == closed  # no closed version is written again
        closed = now
    for n, want in enumerate(wants):
        assert rows(store.history(spark, version=n)) == want  # every version of the store can be read
    directory = read_directory(spark, base).collect()
    assert sum(2.0 ** -r.depth for r in directory) == 1.0  # prefixes cover all hashes, once
    assert (len(directory) > 2) == (bucket_bytes < 1 << 20)


def test_a_replayed_batch_changes_nothing_and_a_split_rewrites_one_bucket(spark):
    base = scratch_path(spark, "split")
    store = make(base, depth=2, bucket_bytes=1 << 30)
    first = [(k, 1, k, "a", "x" * 50, False) for k in range(400)]
    store(spark.createDataFrame(first, EV), 0)
    before, old = files(spark, f"{base}/open"), {(r.depth, r.prefix): r.gen for r in read_directory(spark, base).collect()}
    assert len(old) == 4
    store.buckets.bucket_bytes = 2000
    change = [(7, 2, 1000, "b", "y", False)]
    for _ in range(2):
        store(spark.createDataFrame(change, EV), 1)
        assert rows(store.history(spark)) == whole(spark, first + change)
    now = {(r.depth, r.prefix): r.gen for r in read_directory(spark, base).collect()}
    gone = set(old) - set(now)
    assert len(gone) == 1 and all(now[b] == 0 for b in set(old) - gone)  # the others are read where they were
    (depth, prefix), = gone
    children = set(now) - set(old)
    assert children and all(p >> (d - depth) == prefix for d, p in children)
    after = files(spark, f"{base}/open")
    assert {p: after[p] for p in before} == before


def test_old_versions_go_with_what_only_they_name(spark):
    base = scratch_path(spark, "keep")
    store, seen = make(base, depth=3, keep=2), []
    for n in range(4):
        batch = [(k, 10 * n, 100 * n + k, "abcd"[n], "", False) for k in range(n, 30, n + 1)]
        store(spark.createDataFrame(batch, EV), n)
        seen += batch
        assert rows(store.history(spark)) == whole(spark, seen)
    assert rows(store.history(spark, version=2)) == whole(spark, [e for e in seen if e[1] < 30])
    with pytest.raises(ValueError, match="not kept"):
        store.history(spark, version=0)
    named = {f"_gen={r.gen}/_bucket={r.depth}-{r.prefix}/" for v in (2, 3) for r in read_directory(spark, base, v).collect()
             if r.gen is not None}
    assert all(any(n in p for n in named) for p in files(spark, f"{base}/open"))


def test_null_keys_can_be_rejected_and_empty_batches_store_nothing(spark):
    base = scratch_path(spark, "nulls")
    store = make(base, reject_null_keys=True)
    assert store.history(spark) is None
    store(spark.createDataFrame([(None, 1, 1, "a", "", False)], EV), 0)
    assert store.history(spark) is None
    store(spark.createDataFrame([(None, 1, 1, "a", "", False), (1, 1, 1, "a", "", False)], EV), 1)
    assert [r.k for r in store.history(spark).collect()] == [1]


def test_upserts_into_buckets_that_split_keep_their_versions(spark):
    from lakeledger.streaming.silver import bucketed_apply_changes_writer, bucketed_table
    base = scratch_path(spark, "upserts")
    w = bucketed_apply_changes_writer(base, ["k"], ["seq"], 2)
    w.buckets.bucket_bytes = 1500
    want = {}
    for n in range(3):
        batch = [(k, n, f"v{n}") for k in range(0, 200, n + 1)]
        w(spark.createDataFrame(batch, "k int, seq int, v string"), n)
        want[n] = {**want.get(n - 1, {}), **{k: v for k, _, v in batch}}
    for n in range(3):
        assert {r.k: r.v for r in bucketed_table(spark, w, version=n).collect()} == want[n]
        assert bucketed_table(spark, base, version=n).count() == 200
    assert read_directory(spark, base).count() > 2


def test_rows_of_an_untouched_bucket_are_refused(spark):
    from lakeledger.streaming.silver import BucketedWriter, bucketed_table
    base = scratch_path(spark, "astray")
    w = BucketedWriter(base, ["k"], 8, lambda b, prev, n: b.withColumn("k", F.col("k") + n))
    w(spark.createDataFrame([(1,), (2,)], "k int"), 0)
    with pytest.raises(RuntimeError, match="does not touch"):
        for n in range(1, 9):  # one of them goes to another bucket
            w(spark.createDataFrame([(1,)], "k int"), n)
    assert rows(bucketed_table(spark, w))  # and nothing of it is seen
