"""Joining two histories: a sweep over the boundaries of both, no range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import keyed_scan


def _boundaries(history: DataFrame, keys: list[str], columns: list[str], side: int, kinds: list[T.StructType],
                start_col: str, end_col: str) -> DataFrame:
    """Where a version begins (with its values) and where it ends (without)."""
    lasting = history.dropna(subset=keys).filter(F.col(end_col).isNull() | (F.col(start_col) < F.col(end_col)))
    starts = F.struct(F.col(start_col).alias("t"), F.lit(1).alias("kind"), F.lit(True).alias("valid"))
    ends = F.struct(F.col(end_col).alias("t"), F.lit(0).alias("kind"), F.lit(False).alias("valid"))
    both = lasting.select(*keys, F.struct(*columns).alias("_row"), F.explode(F.array(starts, ends)).alias("_b")) \
        .filter("_b.t is not null")
    own = F.struct(F.col("_b.valid").alias("valid"), F.when(F.col("_b.valid"), F.col("_row")).alias("row"))
    values: list[Column] = [own.cast(kinds[i]) if i == side else F.lit(None).cast(kinds[i]) for i in (0, 1)]
    return both.select(*keys, F.col("_b.t").alias("_t"), F.col("_b.kind").alias("_kind"), F.lit(side).alias("_side"),
                       values[0].alias("_a"), values[1].alias("_b"))


def join_histories(left: DataFrame, right: DataFrame, keys: Sequence[str], left_columns: Sequence[str],
                   right_columns: Sequence[str], how: str = "inner", start_col: str = "scd_start_date",
                   end_col: str = "scd_end_date") -> DataFrame:
    """The values of both histories over time: one row for each span in which neither changes.

    ``how``: ``inner`` (spans in which both have a version), ``left`` or ``full``; the
    other side's columns are NULL where it has none.  Both histories have versions that
    do not overlap within a key; empty ones (start = end) hold at no instant and are
    left out, as are those of a NULL key.  Starts and ends of both are put in order once
    and filled forward, so a key with many versions on both sides costs their sum, not
    their product, and is spread like any other rows.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError("how must be inner, left or full")
    keys, lc, rc = list(keys), list(left_columns), list(right_columns)
    kinds = [T.StructType([T.StructField("valid", T.BooleanType()), T.StructField("row", h.select(*c).schema)])
             for h, c in ((left, lc), (right, rc))]
    kinds = [T.StructType([k.fields[0], T.StructField("row", T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in k.fields[1].dataType.fields]))]) for k in kinds]
    events = _boundaries(left, keys, lc, 0, kinds, start_col, end_col).unionByName(
        _boundaries(right, keys, rc, 1, kinds, start_col, end_col))
    # of one instant ends come before starts; its last row has all that begins there
    s = keyed_scan(events, keys, ["_t", "_kind", "_side"], ffill=["_a", "_b"], lead=["_t"])
    a, b = F.coalesce(F.col("last__a.valid"), F.lit(False)), F.coalesce(F.col("last__b.valid"), F.lit(False))
    wanted = {"inner": a & b, "left": a, "full": a | b}[how]
    spans = s.filter((F.col("next__t").isNull() | (F.col("next__t") != F.col("_t"))) & wanted)
    return spans.select(*keys, *[F.when(a, F.col("last__a.row")[c]).alias(c) for c in lc],
                        *[F.when(b, F.col("last__b.row")[c]).alias(c) for c in rc],
                        F.col("_t").alias(start_col), F.col("next__t").alias(end_col))
