"""Span tables shared by the two operators that mark spans of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_spans(base: DataFrame, spans: DataFrame, kinds: Sequence[str], by_kind: bool) -> DataFrame:
    """``base`` (with ``_row``) plus ``spans``: kind:start:end of each span, comma-joined.

    ``spans`` has ``_row, kind, start, end``; equal spans count once.  Ordered
    by kind (as listed in ``kinds``) and start if ``by_kind``, else by start
    and kind.  A document without spans gets the empty string.
    """
    place = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")).alias("k")
    order = [place, F.col("start").alias("s")] if by_kind else [F.col("start").alias("s"), place]
    item = F.struct(*order, F.col("end").alias("e"), F.col("kind").alias("n"))
    per_row = spans.groupBy("_row").agg(F.array_sort(F.collect_set(item)).alias("_items")) \
        .select("_row", F.array_join(F.transform("_items", lambda x: F.concat_ws(
            ":", x["n"], x["s"].cast("string"), x["e"].cast("string"))), ",").alias("spans"))
    return base.join(per_row, "_row", "left").withColumn("spans", F.coalesce("spans", F.lit("")))
