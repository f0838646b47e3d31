"""Gold reports: readmission, status transitions, cohorts, outcomes, 360 view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import keyed_scan


def readmissions(df: DataFrame, key: str | Sequence[str], date: str,
                 tie_break: Sequence[str] = (), days: int = 30,
                 previous: str = "previous_date", gap: str = "days_since_last",
                 flag: str = "is_readmission_30d") -> DataFrame:
    """Previous event date per key, whole days since it, and a 0/1 flag.

    The input must be event level (several rows per key).  No previous event
    gives NULL gap and flag 0; a same-day event gives gap 0 and flag 1.
    """
    keys = [key] if isinstance(key, str) else list(key)
    s = keyed_scan(df, keys, [date, *tie_break], lag=[date], lag_prefix="_prev_")
    prev = F.col("_prev_" + date)
    d = F.datediff(F.col(date).cast("date"), prev.cast("date"))
    return (s.withColumn(previous, prev)
             .withColumn(gap, d.cast("int"))
             .withColumn(flag, F.when(F.col(gap) <= F.lit(days), F.lit(1)).otherwise(F.lit(0)))
             .drop("_prev_" + date))


def status_transitions(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                       status: str, from_col: str = "from_status",
                       to_col: str = "to_status", count_col: str = "n_transitions") -> DataFrame:
    """Count (previous status -> status) changes per key over time."""
    keys = [key] if isinstance(key, str) else list(key)
    s = keyed_scan(df.select(*keys, *order, status) if status not in order else df.select(*keys, *order),
                   keys, order, lag=[status], lag_prefix="_from_")
    moved = s.filter(F.col("_from_" + status).isNotNull()
                     & ~F.col("_from_" + status).eqNullSafe(F.col(status)))
    return (moved.groupBy(F.col("_from_" + status).alias(from_col), F.col(status).alias(to_col))
                 .agg(F.count(F.lit(1)).alias(count_col)))


def cohort_rollup(df: DataFrame, dims: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Counts by every prefix of ``dims`` (ROLLUP); NULL marks a subtotal."""
    aggs = [e.alias(n) for n, e in measures.items()]
    return df.rollup(*dims).agg(*aggs, F.grouping_id().alias("grouping_level"))


def outcome_rates(df: DataFrame, group: Sequence[str], outcome: Column,
                  total_col: str = "n_total", hit_col: str = "n_outcome",
                  rate_col: str = "outcome_rate") -> DataFrame:
    """Share of rows per group meeting ``outcome`` (conditional aggregation)."""
    return (df.groupBy(*group)
              .agg(F.count(F.lit(1)).alias(total_col), F.count_if(outcome).alias(hit_col))
              .withColumn(rate_col, F.round(F.col(hit_col) / F.col(total_col), 6)))


def entity_360(base: DataFrame, key: str, others: dict[str, DataFrame]) -> DataFrame:
    """Left-join per-entity frames (each already unique on ``key``) to ``base``."""
    out = base
    for _, other in others.items():
        out = out.join(other, on=key, how="left")
    return out
