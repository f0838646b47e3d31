"""Physical-plan properties that matter at scale (read from explain output)."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from lakeledger.functions.clean import key_bucket
from lakeledger.operators.changes import incremental_since
from lakeledger.operators.dedup import latest_per_key
from lakeledger.plans import registry
from lakeledger.session import scratch_path

SF = "/root/testdata/sf0.01"
Q = registry.queries()


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def initial(p: str) -> str:
    return p.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in p else p


def test_scans_do_not_grow_with_the_steps(spark):
    """An ordered step reads its layout for its rows and for the summary (counts: keys alone once more)."""
    for name, scans in (("q_readmission_30d", 2), ("q_scd2_history", 3), ("q_scd2_as_of_join", 2)):
        p = plan(Q[name](spark, SF), "simple")
        assert initial(p).count("FileScan") == scans, p


def test_literal_high_water_mark_is_pushed_to_the_scan(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(incremental_since(e, "ts", "2024-01-20 00:00:00"))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThan\(ts,", p)


def test_latest_per_key_combines_map_side(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    assert "partial_max_by" in plan(latest_per_key(e, ["user_id"], ["ts", "event_id"]))
    assert "WindowGroupLimit" in plan(latest_per_key(e, ["user_id"], ["ts", "event_id"], how="window"))


def test_scd1_delta_never_full_outer_joins_untouched_rows(spark):
    p = initial(plan(Q["q_scd1_delta"](spark, SF)))
    assert "LeftAnti" in p and "LeftSemi" in p and "FullOuter" in p


def test_bucketed_log_read_is_pruned_dynamically(spark):
    root = scratch_path(spark, "dpp")
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("_bucket", key_bucket(["user_id"], 16))
    e.write.partitionBy("_bucket").parquet(f"{root}/log/_batch=0")
    touched = e.filter(F.col("event_id") < 3).select("user_id", "_bucket").distinct()
    log = (spark.read.option("basePath", f"{root}/log").parquet(f"{root}/log")
                .join(touched, ["user_id", "_bucket"], "left_semi"))
    assert "dynamicpruningexpression(_bucket" in plan(log)


def test_as_of_join_has_no_range_join(spark):
    p = initial(plan(Q["q_scd2_as_of_join"](spark, SF)))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_no_query_pairs_rows_or_leaves_the_jvm(spark):
    """Across every batch query: no cartesian / nested-loop join, no Python UDF operator."""
    from lakeledger.plans import catalog
    bad = {}
    for name, fn in sorted(catalog.QUERIES.items()):
        if fn.__module__ != catalog.__name__:      # file / streaming scenarios live in streams.py
            continue
        p = plan(fn(spark, SF), "extended")
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                              "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas") if op in p]
        if hits:
            bad[name] = hits
    assert not bad, bad
