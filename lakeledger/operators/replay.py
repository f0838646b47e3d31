"""Quarantine replay: rescued rows are read again under the next version of a widened schema.

A schema grows by versions: new columns, and for known ones the least type that holds
both (:func:`common_type`).  What an older version rescued is parsed again under the
newest; rows that fit are handed on once, the others stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import CSV_OPTIONS, RESCUE_COL, with_rescue
from ..sources.schemas import load_schema, save_schema
from ..sources.snapshots import list_versions

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT = (T.FloatType, T.DoubleType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text if no narrower one does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    whole = [t for t in (a, b) if isinstance(t, _WHOLE)]
    if len(whole) == 2:
        return max(whole, key=lambda t: _WHOLE.index(type(t)))
    if all(isinstance(t, _FLOAT) for t in (a, b)):
        return T.DoubleType()
    if {type(a), type(b)} <= {T.ByteType, T.ShortType, T.IntegerType, *_FLOAT}:
        return T.DoubleType()  # exact up to 32 bits; a long is not
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with the common types of both, and the columns only ``new`` has, all nullable, at its end."""
    types = {f.name: f.dataType for f in new.fields}
    kept = [T.StructField(f.name, common_type(f.dataType, types.get(f.name, f.dataType)),
                          f.nullable or f.name not in types) for f in old.fields]
    return T.StructType(kept + [T.StructField(f.name, f.dataType, True) for f in new.fields
                                if f.name not in old.fieldNames()])


class SchemaLog:
    """Versions of a schema, ``base/v=<n>``; a version is never changed."""

    def __init__(self, base: str):
        self.base = base

    def version(self, spark: SparkSession) -> int | None:
        return max(list_versions(spark, self.base), default=None)

    def read(self, spark: SparkSession, version: int | None = None) -> T.StructType | None:
        version = self.version(spark) if version is None else version
        return None if version is None else load_schema(spark, f"{self.base}/v={version}")

    def widen(self, spark: SparkSession, schema: T.StructType) -> int:
        """Note that rows of ``schema`` come; its version, the newest one if that holds them already."""
        last = self.version(spark)
        old = self.read(spark, last)
        new = schema if old is None else widened(old, schema)
        if old is not None and new == old:
            return last
        version = 0 if last is None else last + 1
        save_schema(spark, new, f"{self.base}/v={version}")
        return version


def parse_rescued(schema: T.StructType, options: dict | None = None, col: str = RESCUE_COL) -> Column:
    """A struct of ``schema`` from a rescued CSV line; its ``_rescued_data`` is null if the line fits."""
    opts = {k: v for k, v in {**CSV_OPTIONS, **(options or {})}.items() if k not in ("header", "enforceSchema")}
    return F.from_csv(F.col(col), with_rescue(schema).toDDL(),
                      {**opts, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUE_COL})


def replay_quarantine(quarantine: DataFrame, schema: T.StructType, base: str, source: str = "_source_file",
                      options: dict | None = None) -> DataFrame | None:
    """Rows of ``quarantine`` that fit ``schema`` and that no earlier replay under ``base`` healed.

    They are written as the next run under ``base`` and returned from there; None if
    there are none, so a second replay changes nothing.  A row is known by its file
    and its text: equal lines of one file heal as one.  Rows without text, or with a blank one, stay.
    """
    spark = quarantine.sparkSession
    runs = list_versions(spark, base, "run=")
    rows = quarantine.filter(F.trim(RESCUE_COL) != "").select(
        F.sha2(F.concat_ws("\n", F.coalesce(F.col(source).cast("string"), F.lit("")), RESCUE_COL), 256).alias("_line"),
        parse_rescued(schema, options).alias("r")).filter(F.col(f"r.{RESCUE_COL}").isNull()) \
        .select("_line", *[F.col(f"r.`{c}`").alias(c) for c in schema.fieldNames()]).dropDuplicates(["_line"])
    if runs:
        healed = spark.read.parquet(*[f"{base}/run={n}" for n in runs]).select("_line")
        rows = rows.join(healed, "_line", "left_anti")
    if rows.isEmpty():
        return None
    out = f"{base}/run={runs[-1] + 1 if runs else 0}"
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(out)
    return spark.read.schema(rows.schema).parquet(out).drop("_line")
