"""keyed_scan equals plain per-key windows for any layout, order type, ties and NULL keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeledger.operators.ordered import CONF_KEY, keyed_scan, ordered_layout


def _rows(seed, n=300):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        k = 0 if rnd.random() < 0.4 else rnd.choice([None, 1, 2, 3, 4, 5, 6])     # key 0 is hot
        t = None if rnd.random() < 0.03 else base + dt.timedelta(minutes=rnd.randint(0, 50_000))
        v = None if rnd.random() < 0.3 else rnd.choice(["a", "b", "c"])
        out.append((k, i, t, t.date() if t else None, float(rnd.randint(0, 1000)) if t else None, v))
    return out


SCHEMA = "k int, id int, t timestamp_ntz, d date, x double, v string"


@pytest.mark.parametrize("seed,order_col,parts", [
    (1, "t", 60), (2, "d", 17), (3, "x", 1), (4, "v", 9), (5, "x", 40)])
def test_keyed_scan_equals_windows(spark, seed, order_col, parts):
    df = spark.createDataFrame(_rows(seed), SCHEMA)
    order = [order_col, "id"]
    spark.conf.set(CONF_KEY, str(parts))
    try:
        got = keyed_scan(df, ["k"], order, lag=["v", "id"], lead=["v"], ffill=["v"], row_number="rn")
        some = keyed_scan(df, ["k"], order, row_number="n_a", counted=F.col("v").eqNullSafe("a"))
    finally:
        spark.conf.unset(CONF_KEY)
    w = Window.partitionBy("k").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lag("id").over(w).alias("prev_id"),
                     F.lead("v").over(w).alias("next_v"),
                     F.last("v", ignorenulls=True).over(upto).alias("last_v"),
                     F.row_number().over(w).alias("rn"))
    cols = want.columns
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.collect()))
    counts = df.select("*", F.count_if(F.col("v").eqNullSafe("a")).over(upto).alias("n_a"))
    assert sorted(map(repr, some.collect())) == sorted(map(repr, counts.collect()))
    assert dict(got.dtypes)["rn"] == "bigint"


@pytest.mark.parametrize("case", ["one instant", "outlier", "null key", "string order"])
def test_no_partition_of_the_layout_is_twice_the_mean(spark, case):
    """One key with 20,000 rows over 4 partitions."""
    df = spark.range(20_000).select(
        F.lit(None if case == "null key" else 1).cast("int").alias("k"), F.col("id"),
        (F.lit(5) if case == "one instant" else F.when(F.col("id") == 3, -10**9).otherwise(F.col("id")))
        .cast("long").alias("t"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("s"))
    spark.conf.set(CONF_KEY, "4")
    try:
        laid = ordered_layout(df, ["k"], ["s" if case == "string order" else "t", "id"])
    finally:
        spark.conf.unset(CONF_KEY)
    sizes = [r["count"] for r in laid.groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 5000


def test_rows_are_not_shuffled_again_to_meet_the_summary(spark):
    """A row per partition goes to the tasks, even where Catalyst would take its estimate for too much."""
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "k int, t int, v string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = keyed_scan(df, ["k"], ["t"], lag=["v"], lead=["v"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert sorted((r.k, r.t, r.prev_v, r.next_v) for r in got.collect()) == [
            (1, 1, None, "b"), (1, 2, "a", None), (2, 1, None, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
