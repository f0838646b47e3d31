"""SCD / change-feed laws on seeded random change logs, checked against a
sequential Python model of the same rules."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from lakeledger.operators.cdc import apply_changes
from lakeledger.operators.changes import diff, replay
from lakeledger.operators.merge import scd1_apply, upsert
from lakeledger.operators.scd2 import as_of_join, scd2_apply, scd2_history

SCHEMA = "k int, seq long, v string, del boolean"


def random_log(seed, keys=6, n=80):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(1, 10 * n), n)
    return [(rnd.randint(1, keys), s, rnd.choice(["a", "b", "c", None]), rnd.random() < 0.2) for s in seqs]


def model_history(log):
    out = []
    for k, evs in groupby(sorted(log, key=lambda e: (e[0], e[1])), key=lambda e: e[0]):
        cur, ver = None, 0
        for _, seq, v, d in evs:
            if d:
                if cur:
                    out.append((*cur[:3], seq, cur[4]))
                    cur = None
            elif cur is None or cur[1] != v:
                if cur:
                    out.append((*cur[:3], seq, cur[4]))
                ver += 1
                cur = (k, v, seq, None, ver)
        if cur:
            out.append(cur)
    return sorted(out, key=repr)


def spark_history(df, **kw):
    h = scd2_history(df, ["k"], ["v"], ["seq"], is_delete=F.col("del"), **kw)
    return sorted(((r.k, r.v, r.scd_start_date, r.scd_end_date, r.scd_version) for r in h.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scd2_history_matches_sequential_model(spark, seed):
    log = random_log(seed)
    assert spark_history(spark.createDataFrame(log, SCHEMA)) == model_history(log)


@pytest.mark.parametrize("seed", [4, 5])
def test_scd2_history_with_hot_keys_split(spark, hot, seed):
    log = random_log(seed, keys=2, n=60)
    assert spark_history(spark.createDataFrame(log, SCHEMA)) == model_history(log)


def test_scd2_invariants(spark):
    h = model_history(random_log(7))
    got = spark_history(spark.createDataFrame(random_log(7), SCHEMA))
    assert got == h
    for k, rows in groupby(sorted(got, key=lambda r: r[0]), key=lambda r: r[0]):
        rows = sorted(rows, key=lambda r: r[2])
        assert [r[4] for r in rows] == list(range(1, len(rows) + 1))
        assert sum(r[3] is None for r in rows) <= 1
        for a, b in zip(rows, rows[1:]):
            assert a[3] is not None and a[3] <= b[2]     # intervals never overlap


@pytest.mark.parametrize("seed", [8, 9])
def test_scd2_incremental_any_split_equals_one_batch(spark, seed):
    log = random_log(seed)
    rnd = random.Random(seed)
    rnd.shuffle(log)   # arrival order differs from sequence order
    cuts = sorted(rnd.sample(range(1, len(log)), 3))
    parts = [log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    seen, target = [], None
    for p in parts:
        seen += p
        full = spark.createDataFrame(seen, SCHEMA)
        batch = spark.createDataFrame(p, SCHEMA)
        if target is None:
            target = scd2_history(full, ["k"], ["v"], ["seq"], is_delete=F.col("del"))
        else:
            target = scd2_apply(target, full, batch, ["k"], ["v"], ["seq"], is_delete=F.col("del"))
        target = spark.createDataFrame(target.collect(), target.schema)   # cut lineage (small test data)
    got = sorted(((r.k, r.v, r.scd_start_date, r.scd_end_date, r.scd_version) for r in target.collect()), key=repr)
    assert got == model_history(log)


def test_as_of_at_start_returns_that_version(spark, hot):
    log = random_log(11)
    h = scd2_history(spark.createDataFrame(log, SCHEMA), ["k"], ["v"], ["seq"], is_delete=F.col("del"))
    facts = h.select("k", F.col("scd_start_date").alias("t"), F.col("scd_version").alias("expect"))
    got = as_of_join(facts, h, ["k"], "t", ["scd_version"], fact_order=["expect"])
    assert got.filter(~F.col("scd_version").eqNullSafe(F.col("expect"))).count() == 0


@pytest.mark.parametrize("seed", [12, 13])
def test_diff_then_replay_is_identity(spark, seed):
    rnd = random.Random(seed)
    old = [(k, rnd.choice(["x", "y", None])) for k in range(30) if rnd.random() < 0.8]
    new = [(k, rnd.choice(["x", "y", None])) for k in range(30) if rnd.random() < 0.8]
    o, n = spark.createDataFrame(old, "k int, v string"), spark.createDataFrame(new, "k int, v string")
    feed = diff(o, n, ["k"], ["v"])
    assert sorted(replay(o, feed, ["k"]).collect()) == sorted(n.collect())
    kinds = {r._change_type for r in feed.collect()}
    assert kinds <= {"insert", "delete", "update_preimage", "update_postimage"}


def test_type1_streaming_tombstones_block_late_resurrection(spark):
    sch = "k int, seq long, v string, op string"
    b1 = spark.createDataFrame([(1, 10, "a", "U"), (1, 20, None, "D")], sch)
    late = spark.createDataFrame([(1, 15, "old", "U")], sch)
    d = F.col("op") == "D"
    s1 = apply_changes(b1, ["k"], "seq", apply_as_deletes=d, except_column_list=["op"], keep_tombstones=True)
    s2 = apply_changes(late, ["k"], "seq", apply_as_deletes=d, except_column_list=["op"],
                       target=s1, keep_tombstones=True)
    assert [r["__deleted"] for r in s2.collect()] == [True]


def test_upsert_replaces_matched_and_inserts_new(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, s int")
    s = spark.createDataFrame([(2, "B", 2), (2, "BB", 3), (3, "c", 2)], "k int, v string, s int")
    assert sorted(upsert(t, s, ["k"], sequence=["s"]).collect()) == [(1, "a", 1), (2, "BB", 3), (3, "c", 2)]


def test_scd1_audit_soft_delete_reactivate_and_late_data(spark):
    sch = "k int, seq long, v string, op string"
    d = F.col("op") == "D"
    def run(t, rows, now, **kw):
        return scd1_apply(t, spark.createDataFrame(rows, sch), ["k"], ["v"], now, sequence=["seq"],
                          is_delete=d, except_column_list=["op"], **kw)
    s0 = run(None, [(1, 1, "a", "U"), (2, 1, "b", "U"), (9, 1, None, "D")], "2024-01-01 00:00:00")
    assert sorted(r.k for r in s0.collect()) == [1, 2]                 # delete of unknown key: no-op
    s1 = run(s0, [(1, 2, "a", "U"), (2, 2, None, "D")], "2024-01-02 00:00:00")
    r1 = {r.k: r for r in s1.collect()}
    assert str(r1[1]._updated_datetime) == "2024-01-01 00:00:00"        # unchanged: untouched
    assert r1[2]._is_deleted and str(r1[2]._updated_datetime) == "2024-01-02 00:00:00"
    s2 = run(s1, [(2, 3, "b", "U"), (1, 0, "late", "U")], "2024-01-03 00:00:00")
    r2 = {r.k: r for r in s2.collect()}
    assert not r2[2]._is_deleted and r2[2].v == "b"                      # reactivated, same values
    assert str(r2[2]._created_datetime) == "2024-01-01 00:00:00"
    assert r2[1].v == "a"                                                # late, older row ignored
    s3 = run(s2, [(1, 5, "a", "U")], "2024-01-04 00:00:00", source_kind="snapshot")
    r3 = {r.k: r for r in s3.collect()}
    assert r3[2]._is_deleted and not r3[1]._is_deleted                  # missing from snapshot
    s4 = run(s1, [(2, 5, None, "D"), (3, 1, "c", "U")], "2024-01-05 00:00:00")   # repeated delete
    s5 = run(s4, [(2, 4, "b-late", "U")], "2024-01-06 00:00:00")        # older than the last delete
    r5 = {r.k: r for r in s5.collect()}
    assert r5[2]._is_deleted and r5[2].seq == 5 and r5[3].v == "c"


@pytest.mark.parametrize("swap", [False, True])
def test_as_of_on_equal_starts_takes_the_lasting_version(spark, swap):
    h = [(1, "b", 5, 5), (1, "c", 5, None), (2, "x", 3, 7), (2, "y", 3, 3)]
    hist = spark.createDataFrame(h[::-1] if swap else h, "k int, v string, scd_start_date int, scd_end_date int")
    facts = spark.createDataFrame([(1, 5), (1, 7), (2, 3), (2, 7), (3, 1)], "k int, t int")
    got = {(r.k, r.t): r.v for r in as_of_join(facts, hist, ["k"], "t", ["v"]).collect()}
    assert got == {(1, 5): "c", (1, 7): "c", (2, 3): "x", (2, 7): None, (3, 1): None}


@pytest.mark.parametrize("seed", [31, 32])
def test_type2_current_rows_equal_type1(spark, seed):
    df = spark.createDataFrame(random_log(seed), SCHEMA)
    t1 = apply_changes(df, ["k"], "seq", apply_as_deletes=F.col("del"), except_column_list=["del"])
    t2 = apply_changes(df, ["k"], "seq", apply_as_deletes=F.col("del"), except_column_list=["del"],
                       stored_as_scd_type=2, track_history_column_list=["v"])
    cur = t2.filter(F.col("__END_AT").isNull()).select("k", "v")
    # type 1 keeps the latest event's values; type 2's current row keeps the
    # first event of the current version - equal on the tracked column
    assert sorted(map(repr, cur.collect())) == sorted(map(repr, t1.select("k", "v").collect()))


@pytest.mark.parametrize("seed", [33, 34])
def test_type1_any_split_and_order_equals_one_batch(spark, seed):
    log = random_log(seed)
    rnd = random.Random(seed)
    rnd.shuffle(log)
    cuts = sorted(rnd.sample(range(1, len(log)), 4))
    parts = [log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    state = None
    for p in parts:
        batch = spark.createDataFrame(p, SCHEMA)
        state = apply_changes(batch, ["k"], "seq", apply_as_deletes=F.col("del"), except_column_list=["del"],
                              target=state, keep_tombstones=True)
        state = spark.createDataFrame(state.collect(), state.schema)   # cut lineage (small test data)
    got = state.filter(~F.col("__deleted")).drop("__deleted")
    one = apply_changes(spark.createDataFrame(log, SCHEMA), ["k"], "seq", apply_as_deletes=F.col("del"),
                        except_column_list=["del"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, one.collect()))


@pytest.mark.parametrize("seed,late_share", [(41, 0.0), (43, 0.4)])
def test_scd2_fast_path_equals_model(spark, seed, late_share):
    from lakeledger.operators.scd2 import scd2_apply_fast, scd2_key_state
    log = sorted(random_log(seed, n=90), key=lambda e: e[1])
    rnd = random.Random(seed)
    # mostly in order; some events arrive one batch late
    batches = [[] for _ in range(5)]
    for i, e in enumerate(log):
        b = min(4, i * 5 // len(log) + (1 if rnd.random() < late_share else 0))
        batches[b].append(e)
    seen = []
    target = state = None
    for p in batches:
        if not p:
            continue
        seen += p
        batch = spark.createDataFrame(p, SCHEMA)
        full = spark.createDataFrame(seen, SCHEMA)
        if target is None:
            target = scd2_history(full, ["k"], ["v"], ["seq"], is_delete=F.col("del"))
            state = scd2_key_state(full, ["k"], ["seq"])
        else:
            target, state = scd2_apply_fast(target, state, batch, full, ["k"], ["v"], ["seq"],
                                            is_delete=F.col("del"))
        target = spark.createDataFrame(target.collect(), target.schema)   # cut lineage (small test data)
        state = spark.createDataFrame(state.collect(), state.schema)
    got = sorted(((r.k, r.v, r.scd_start_date, r.scd_end_date, r.scd_version) for r in target.collect()), key=repr)
    assert got == model_history(log)


def test_scd2_fast_path_when_inputs_share_lineage(spark):
    """Target history, key state and batch all derived from one bronze table
    (date-first struct sequence).  A run of this shape, with the history read back
    from storage, once lost the last versions in the assembled plan. Writing the
    control frames to the shared folder fixed it; this test covers the shape."""
    from lakeledger.functions.clean import cast_failures
    from lakeledger.operators.scd2 import scd2_apply_fast, scd2_key_state
    from lakeledger.plans import medallion
    from lakeledger.session import scratch_path
    import test_medallion as tm
    root = scratch_path(spark, "fast_lineage")
    e = [x for x in medallion.oncology_entities() if x.name == "cancer_disease_status"][0]
    tm._wave1(root)
    tm._wave2(root)
    medallion.run_bronze(spark, e, f"{root}/landing", f"{root}/lake")
    br = cast_failures(spark.read.parquet(f"{root}/lake/bronze/cancer_disease_status"), e.clean)
    seq = ["Last_Update", "_source_file_mtime", "_source_file"]
    tracked, cols = ["Cancer_Disease_Status", "On_Treatment"], ["Cancer_Disease_Status", "Last_Update", "On_Treatment"]
    old, new = br.filter("Last_Update < '2024-02-01'"), br.filter("Last_Update = '2024-02-01'")
    target = scd2_history(old, ["Patient_ID"], tracked, seq, columns=cols)
    hist, _ = scd2_apply_fast(target, scd2_key_state(old, ["Patient_ID"], seq), new, br, ["Patient_ID"],
                              tracked, seq, columns=cols)
    want = scd2_history(br, ["Patient_ID"], tracked, seq, columns=cols)
    assert sorted(map(repr, hist.collect())) == sorted(map(repr, want.select(*hist.columns).collect()))
