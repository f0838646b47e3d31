"""A key holding a third of all rows: exact results, and no task gets the third."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeledger.operators.ordered import CONF_KEY, keyed_scan

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = (F.col("l_linenumber") % 3) == 0       # about a third of all rows go to supplier 0
    return li.select(F.when(hot, F.lit(0)).otherwise(F.col("l_suppkey")).alias("k"),
                     "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")


def test_hot_key_results_equal_plain_window_and_work_is_spread(spark):
    df = _skewed(spark)
    n = df.count()
    hot_rows = df.filter(F.col("k") == 0).count()
    assert hot_rows > n / 4
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    spark.conf.set(CONF_KEY, "40")
    # let the partition count show the hash distribution (AQE would merge tiny partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = keyed_scan(df, ["k"], order, lag=["l_quantity"], lead=["l_shipdate"], row_number="rn",
                         ffill=["l_quantity"])
        hot_per_task = [c for c in got.rdd.mapPartitions(
            lambda it: [sum(1 for r in it if r.k == 0)]).collect() if c]   # hot rows per window task
        w = Window.partitionBy("k").orderBy(*order)
        plain = df.select("*", F.lag("l_quantity").over(w).alias("prev_l_quantity"),
                          F.lead("l_shipdate").over(w).alias("next_l_shipdate"),
                          F.row_number().over(w).alias("rn"),
                          F.last("l_quantity", ignorenulls=True).over(
                              w.rowsBetween(Window.unboundedPreceding, 0)).alias("last_l_quantity"))
        cols = plain.columns
        assert got.select(*cols).exceptAll(plain).count() == 0
        assert plain.exceptAll(got.select(*cols)).count() == 0
    finally:
        spark.conf.unset(CONF_KEY)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(hot_per_task) > 1 and max(hot_per_task) < hot_rows   # the hot key was split over tasks
