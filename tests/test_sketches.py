"""Quality sketches: spans of batches, replays, batches without rows, keys that need an exact count."""

from pyspark.sql import functions as F

from lakeledger.operators.sketches import HLL_ERROR, KLL_ERROR, SketchLog


def batch(spark, first, n):
    return spark.range(first, first + n).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), (F.col("id") % 50).cast("int").alias("g"),
        F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"))


def test_any_span_is_answered_from_its_batches(spark, tmp_path):
    log = SketchLog(str(tmp_path / "s"), ["k", "g"], ["x"])
    for b in range(5):
        log.write(batch(spark, b * 4000, 4000), b)
    log.write(batch(spark, 0, 0), 5)
    for first, last in ((None, None), (1, 3), (2, 2), (5, 5)):
        got = {r.column_name: r for r in log.report(spark, first, last).collect()}
        a, z = (0 if first is None else first) * 4000, (4 if last is None else min(last, 4)) * 4000 + 4000
        df = batch(spark, a, max(0, z - a)) if first != 5 else batch(spark, 0, 0)
        want = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("k"), F.count_if(F.col("k").isNull()).alias("null_k")).first()
        assert (got["k"].n_rows, got["k"].n_null) == (want.n, want.null_k)
        assert abs(got["k"].n_distinct - want.k) <= HLL_ERROR * want.k
        assert got["g"].n_distinct == (50 if want.n else 0)
        if want.n:
            for q, v in zip((0.25, 0.5, 0.75), got["x"].quantiles):
                own = df.filter("NOT isnan(x)")
                assert abs(own.filter(F.col("x") <= v).count() / own.count() - q) <= KLL_ERROR
            assert (got["k"].uniqueness, got["g"].uniqueness, got["x"].uniqueness) == ("check", "no", None)
        else:
            assert got["x"].quantiles is None


def test_a_replayed_batch_counts_once(spark, tmp_path):
    log = SketchLog(str(tmp_path / "s"), ["k"])
    for b in (0, 1, 1, 0):
        log.write(batch(spark, b * 100, 100), b)
    got = log.report(spark).first()
    assert (got.n_rows, got.n_null) == (200, 20)


def test_only_open_keys_are_counted_exactly(spark, tmp_path):
    log = SketchLog(str(tmp_path / "s"), ["k", "g"])
    df = batch(spark, 0, 3000).unionByName(batch(spark, 5, 1))
    log.write(df, 0)
    got = log.duplicates(df, ["k", "g"])
    assert list(got) == ["k"] and [(r.k, r.n_rows) for r in got["k"].collect()] == [(5, 2)]
