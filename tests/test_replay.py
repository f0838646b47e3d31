"""Schema log and quarantine replay."""

from pyspark.sql import types as T

from lakeledger.operators.replay import SchemaLog, common_type, replay_quarantine, widened

ROW = "_rescued_data string, _source_file string"


def test_common_types(spark):
    t = T
    assert common_type(t.IntegerType(), t.LongType()) == t.LongType()
    assert common_type(t.IntegerType(), t.DoubleType()) == common_type(t.FloatType(), t.DoubleType()) == t.DoubleType()
    assert common_type(t.LongType(), t.DoubleType()) == t.StringType()
    assert common_type(t.DateType(), t.TimestampType()) == t.TimestampType()
    assert common_type(t.BooleanType(), t.DateType()) == t.StringType()
    old = t.StructType.fromDDL("a int, b string")
    assert widened(old, t.StructType.fromDDL("c date, a bigint")) == t.StructType.fromDDL("a bigint, b string, c date")


def test_schema_versions_are_kept(spark, tmp_path):
    log = SchemaLog(str(tmp_path / "schema"))
    assert log.read(spark) is None
    a, b = T.StructType.fromDDL("a int"), T.StructType.fromDDL("a bigint, b string")
    assert [log.widen(spark, s) for s in (a, a, b, a, b)] == [0, 0, 1, 1, 1]
    assert log.read(spark, 0) == a and log.read(spark) == b


def test_rows_heal_once_as_the_schema_widens(spark, tmp_path):
    lines = [("3000000000,x", "f1"), ("4,y,new", "f1"), ("4,y,new", "f1"), ("4,y,new", "f2"), ("q,z", "f1"), (None, "f1"), ("", "f1")]
    rows, base = spark.createDataFrame(lines, ROW), str(tmp_path / "healed")
    first = T.StructType.fromDDL("a int, b string")
    assert replay_quarantine(rows, first, base) is None
    second = widened(first, T.StructType.fromDDL("a bigint"))
    assert [tuple(r) for r in replay_quarantine(rows, second, base).collect()] == [(3000000000, "x")]
    assert replay_quarantine(rows, second, base) is None
    third = widened(second, T.StructType.fromDDL("c string"))
    assert [tuple(r) for r in replay_quarantine(rows, third, base).collect()] == [(4, "y", "new")] * 2  # a row of each file
    assert replay_quarantine(rows, third, base) is None
    assert replay_quarantine(rows.limit(0), third, str(tmp_path / "none")) is None
