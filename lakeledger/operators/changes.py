"""Change feeds without a table format: diff, post-images, replay, ranges.

A change feed row is the table row plus ``_change_type`` in
{insert, update_preimage, update_postimage, delete} and, once stored, a
``_commit_version``.  :func:`diff` produces it from two snapshots with one
full outer equi join on the (unique) key — no key can fan out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import changed_expr
from .dedup import latest_per_key

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str],
         change_col: str = CHANGE_TYPE) -> DataFrame:
    """Rows that changed between two snapshots unique on ``keys``.

    Updates (null-safe on ``cols``) emit a pre- and a post-image row.
    """
    keys, cols = list(keys), list(cols)
    o = old.select(*keys, *cols).withColumn("_in", F.lit(True)).alias("o")
    n = new.select(*keys, *cols).withColumn("_in", F.lit(True)).alias("n")
    j = o.join(n, on=keys, how="full_outer")
    in_o, in_n = F.col("o._in").isNotNull(), F.col("n._in").isNotNull()
    chg = changed_expr(cols, "o", "n")

    def image(side: str, kind: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols], F.lit(kind).alias(change_col))

    first = (F.when(~in_o, image("n", INSERT))
              .when(~in_n, image("o", DELETE))
              .when(chg, image("o", PRE)))
    second = F.when(in_o & in_n & chg, image("n", POST))
    return (j.select(*[F.col(k) for k in keys], F.explode(F.array(first, second)).alias("_c"))
             .filter(F.col("_c").isNotNull())
             .select(*keys, *[F.col("_c")[c].alias(c) for c in cols], F.col("_c")[change_col].alias(change_col)))


def postimages(feed: DataFrame, change_col: str = CHANGE_TYPE) -> DataFrame:
    """Rows as they are after the change (inserts and update post-images)."""
    return feed.filter(F.col(change_col).isin(INSERT, POST))


def replay(base: DataFrame, feed: DataFrame, keys: Sequence[str],
           sequence: Sequence[str] | None = None, change_col: str = CHANGE_TYPE) -> DataFrame:
    """Apply a change feed to ``base``; ``replay(old, diff(old, new)) == new``.

    With several versions of a key in the feed, ``sequence`` (e.g.
    ``_commit_version``) picks the last one; it may be a delete.
    """
    keys = list(keys)
    ev = feed.filter(F.col(change_col) != F.lit(PRE))
    if sequence:
        ev = latest_per_key(ev, keys, list(sequence) + [change_col])
    kept = base.join(ev.select(*keys), on=keys, how="left_anti")
    after = ev.filter(F.col(change_col) != F.lit(DELETE)).select(*base.columns)
    return kept.unionByName(after)


def read_changes(log: DataFrame, from_version: int = 0, to_version: int | None = None,
                 version_col: str = COMMIT_VERSION) -> DataFrame:
    """Changes committed in ``[from_version, to_version]`` (partition pruned)."""
    cond = F.col(version_col) >= F.lit(from_version)
    if to_version is not None:
        cond = cond & (F.col(version_col) <= F.lit(to_version))
    return log.filter(cond)


def incremental_since(df: DataFrame, ts_col: str, high_water_mark) -> DataFrame:
    """Rows newer than the last processed point.

    ``high_water_mark`` is a literal (pushed to the Parquet scan) or a
    DataFrame whose single column holds processed timestamps; its maximum is
    evaluated once as a scalar subquery (no join).  Without a mark yet (an
    empty DataFrame, or None) every row is new.
    """
    if high_water_mark is None:
        return df
    if isinstance(high_water_mark, DataFrame):
        c = high_water_mark.columns[0]
        bound = high_water_mark.agg(F.max(c)).scalar()
        return df.filter(bound.isNull() | (F.col(ts_col) > bound))
    return df.filter(F.col(ts_col) > F.lit(high_water_mark).cast(df.schema[ts_col].dataType))
