"""Ordered scans within a key that no key can overload: lag, lead, counts, forward fill.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.  Here
rows are first laid out by range of (keys, full order): each partition holds
about as many rows as any other, whether they belong to many keys, to one, to
one instant of one, or to a NULL key.  The partition's number is stored with the
rows and the layout is written once to the shared folder, as range bounds come
from a sample and could differ if they were computed again.  All steps of an
operator use that layout (:func:`ordered_layout`; rows may be filtered between
steps).

A step runs its windows per (partition, key).  Only a partition's first key can
go on from an earlier partition and only its last key into a later one, so a
summary of one row per partition repairs both.  There is no threshold and one
plan for all sizes.

All orders are ascending, NULLs first, and must be total (add tie-breakers); any
orderable type will do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

PART = "_part"
CONF_KEY = "lakeledger.layout.partitions"  # number of range partitions; else spark.sql.shuffle.partitions


def ordered_layout(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_part``: its rows by range of (keys, order), written once."""
    if PART in df.columns:
        return df
    spark = df.sparkSession
    n = spark.conf.get(CONF_KEY, None)
    by = [F.col(c) for c in dict.fromkeys([*keys, *order])]
    dealt = df.repartitionByRange(int(n), *by) if n else df.repartitionByRange(*by)
    return cut(dealt.withColumn(PART, F.spark_partition_id()), "layout")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _summary(df: DataFrame, keys: list[str], order: list[str], lag: list[str], lead: list[str],
             ffill: list[str], counted: Column | None) -> DataFrame:
    """One row per partition: what its first key takes over and its last key goes on to."""
    key = F.struct(*keys)
    place = F.struct(*dict.fromkeys([*keys, *order]))
    aggs = [F.min(key).alias("_first"), F.max(key).alias("_last")]
    if lag:
        aggs.append(F.max_by(F.struct(*lag), place).alias("_end"))
    if lead:
        aggs.append(F.min_by(F.struct(*lead), place).alias("_start"))
    for i, c in enumerate(ffill):
        aggs.append(F.max_by(F.struct(key.alias("k"), F.col(c).alias("v")),
                             F.when(F.col(c).isNotNull(), place)).alias(f"_f{i}"))
    per = df.groupBy(PART).agg(*aggs)
    if counted is not None:
        sizes = (df.groupBy(PART, *keys).agg(F.count_if(counted).alias("_n"))
                   .groupBy(PART).agg(F.max_by("_n", key).alias("_n")))
        per = per.join(sizes, PART)
    # windows over one row per partition of the layout
    w = Window.orderBy(PART)
    goes_on = F.lag("_last").over(w).eqNullSafe(F.col("_first")) & F.lag(PART).over(w).isNotNull()
    cols = {}
    if lag:
        cols["_before"] = F.when(goes_on, F.lag("_end").over(w))
    if lead:
        more = F.lead("_first").over(w).eqNullSafe(F.col("_last")) & F.lead(PART).over(w).isNotNull()
        cols["_after"] = F.when(more, F.lead("_start").over(w))
    for i, _ in enumerate(ffill):
        held = F.last(f"_f{i}", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        cols[f"_fill{i}"] = F.when(held["k"].eqNullSafe(F.col("_first")), held["v"])
    if counted is not None:
        per = per.withColumn("_sum", F.sum("_n").over(Window.partitionBy("_last").orderBy(PART)))
        cols["_offset"] = F.when(goes_on, F.lag("_sum").over(w))
    return per.withColumns(cols).select(PART, "_first", "_last", *cols)


def keyed_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
               lag: Sequence[str] = (), lead: Sequence[str] = (),
               ffill: Sequence[str] = (), row_number: str | None = None, counted: Column | None = None,
               lag_prefix: str = "prev_", lead_prefix: str = "next_",
               ffill_prefix: str = "last_", keep_layout: bool = False) -> DataFrame:
    """Add ordered per-key columns; rows of one key may lie in any number of tasks.

    ``lag``   -> ``prev_<c>``: value of the previous row of the key.
    ``lead``  -> ``next_<c>``: value of the next row of the key.
    ``ffill`` -> ``last_<c>``: last non-null value up to and including the row.
    ``row_number`` -> 1-based position of the row within its key (long), or the
    number of rows so far that meet ``counted``.

    ``df`` may be a layout of :func:`ordered_layout` on the same keys and order
    (or rows filtered from one); else one is written first.  ``keep_layout``
    keeps ``_part`` for a next step.
    """
    keys, order = list(keys), list(order)
    lag, lead, ffill = list(lag), list(lead), list(ffill)
    laid = ordered_layout(df, keys, order)
    if row_number and counted is None:
        counted = F.lit(True)

    w = Window.partitionBy(PART, *keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols: dict[str, Column] = {"_rn": F.row_number().over(w)}
    if lead:
        cols["_is_last"] = F.lead(F.lit(1)).over(w).isNull()
    for c in lag:
        cols[lag_prefix + c] = F.lag(c).over(w)
    for c in lead:
        cols[lead_prefix + c] = F.lead(c).over(w)
    for c in ffill:
        cols[ffill_prefix + c] = F.last(c, ignorenulls=True).over(upto)
    if row_number:
        cols[row_number] = F.count_if(counted).over(upto)
    # a row per partition goes to all tasks, so that the rows stay where their windows were
    met = laid.withColumns(cols).join(F.broadcast(
        _summary(laid, keys, order, lag, lead, ffill, counted if row_number else None)), PART, "left")

    key = F.struct(*keys)
    in_first, in_last = key.eqNullSafe(F.col("_first")), key.eqNullSafe(F.col("_last"))
    fixes: dict[str, Column] = {}
    for c in lag:
        fixes[lag_prefix + c] = F.when(in_first & (F.col("_rn") == 1), F.col("_before")[c]) \
            .otherwise(F.col(lag_prefix + c))
    for c in lead:
        fixes[lead_prefix + c] = F.when(in_last & F.col("_is_last"), F.col("_after")[c]) \
            .otherwise(F.col(lead_prefix + c))
    for i, c in enumerate(ffill):
        fixes[ffill_prefix + c] = F.coalesce(F.col(ffill_prefix + c), F.when(in_first, F.col(f"_fill{i}")))
    if row_number:
        fixes[row_number] = F.col(row_number) + F.when(
            in_first, F.coalesce("_offset", F.lit(0))).otherwise(F.lit(0))
    kept = [c for c in laid.columns if keep_layout or c != PART or PART in df.columns]
    return met.withColumns(fixes).select(*kept, *[c for c in fixes if c not in kept])
