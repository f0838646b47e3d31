"""Series of full extracts: one shuffle gives what applying them one by one gives."""

import random

import pytest

from lakeledger.operators.extracts import scd2_extract_series
from lakeledger.operators.scd2 import scd2_apply_snapshot
from lakeledger.session import scratch_path
from lakeledger.sources.extracts import Manifest

SCHEMA = "k int, v string, w string, _at string"
DAY = "2024-01-{:02d} 00:00:00".format


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def one_by_one(spark, state, series):
    for at, extract in sorted(series):
        df = spark.createDataFrame([(k, v, w) for k, v, w in extract], "k int, v string, w string")
        out = scd2_apply_snapshot(state, df, ["k"], ["v"], at, columns=["v", "w"])
        state = spark.createDataFrame(out.collect(), out.schema)
    return state


def at_once(spark, state, series):
    df = spark.createDataFrame([(*r, at) for at, extract in series for r in extract], SCHEMA)
    out = scd2_extract_series(state, df, [at for at, _ in series], ["k"], ["v"], columns=["v", "w"])
    return spark.createDataFrame(out.collect(), out.schema)


@pytest.mark.parametrize("seed", range(3))
def test_series_equals_one_by_one(spark, hot, seed):
    rng = random.Random(seed)
    series = [(DAY(d), [(k, rng.choice("aab"), f"{d}") for k in [None, *range(12)] if rng.random() < 0.7])
              for d in range(1, 10)]
    series[4] = (DAY(5), [])  # an extract without rows ends all
    want = one_by_one(spark, None, series)
    shuffled = rng.sample(series, len(series))
    assert rows(at_once(spark, None, shuffled)) == rows(want)
    head, tail = series[:4], series[4:]
    state = at_once(spark, None, head)
    assert rows(state) == rows(one_by_one(spark, None, head))
    assert rows(at_once(spark, state, rng.sample(tail, len(tail)))) == rows(want)


def test_an_older_extract_is_refused(spark):
    state = at_once(spark, None, [(DAY(5), [(1, "a", "")])])
    for apply in (lambda: at_once(spark, state, [(DAY(3), [(1, "b", "")])]),
                  lambda: at_once(spark, state, [(DAY(3), [])]),
                  lambda: one_by_one(spark, state, [(DAY(3), [(1, "b", "")])]),
                  lambda: one_by_one(spark, state, [(DAY(3), [])])):
        with pytest.raises(Exception, match="older than the table's newest version"):
            apply()


def test_only_empty_extracts(spark):
    assert rows(at_once(spark, None, [(DAY(1), []), (DAY(2), [])])) == []
    with pytest.raises(ValueError):
        at_once(spark, None, [])


def test_manifest_waits_for_the_mark_and_refuses_late_extracts(spark):
    root = scratch_path(spark, "manifest")
    df = spark.createDataFrame([(1,)], "x int")
    m = Manifest(spark, f"{root}/m")
    assert m.discover(f"{root}/none") == []
    for day in (4, 2):
        df.write.parquet(f"{root}/in/at=2024-01-0{day}")
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/in/at=2024-01-05")
    assert [(e.number, e.at) for e in m.discover(f"{root}/in")] == [(0, DAY(2)), (1, DAY(4))]
    df.write.parquet(f"{root}/in/at=2024-01-03T10:30:00")
    df.write.parquet(f"{root}/in/at=2024-01-06")
    got = m.discover(f"{root}/in")
    assert [(e.number, e.at, e.state) for e in got] == [
        (0, DAY(2), "waiting"), (1, DAY(4), "waiting"), (2, "2024-01-03 10:30:00", "refused"), (3, DAY(6), "waiting")]
    assert Manifest(spark, f"{root}/m").discover(f"{root}/in") == got
    df.write.parquet(f"{root}/in/at=2024-01-01")
    assert m.discover(f"{root}/in", late="place")[-1].state == "waiting"
