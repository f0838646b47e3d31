"""One row per key: latest (by a total order) or first.

Both forms pre-aggregate before the shuffle, so a hot key costs one partial
result per input partition, never one task holding the whole key:

* ``how="agg"``: ``max_by(struct(row), struct(sequence))`` — hash/sort
  aggregate with a map-side partial step.
* ``how="window"``: ``row_number() = 1``; Catalyst turns this into a
  ``WindowGroupLimit`` that also runs before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], sequence: Sequence[str],
                   how: str = "agg") -> DataFrame:
    """Keep the row with the greatest ``sequence`` per key (columns preserved).

    ``sequence`` must make the order total within a key (add a tie-breaker
    such as an event id or file mtime); otherwise the winner is arbitrary.
    """
    keys, sequence = list(keys), list(sequence)
    if how == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in sequence])
        return (df.withColumn("_rn", F.row_number().over(w))
                  .filter(F.col("_rn") == 1).drop("_rn"))
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
                .agg(F.max_by(F.struct(*rest), F.struct(*sequence)).alias("_row")))
    return picked.select(*[F.col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]) \
                 .select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], sequence: Sequence[str],
                  how: str = "agg") -> DataFrame:
    """Keep the row with the smallest ``sequence`` per key.

    This is the batch twin of streaming ``dropDuplicates(keys)`` with an
    explicit, deterministic choice of the survivor.
    """
    keys, sequence = list(keys), list(sequence)
    if how == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in sequence])
        return (df.withColumn("_rn", F.row_number().over(w))
                  .filter(F.col("_rn") == 1).drop("_rn"))
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
                .agg(F.min_by(F.struct(*rest), F.struct(*sequence)).alias("_row")))
    return picked.select(*[F.col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]) \
                 .select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once (uniqueness check of a silver table)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))
