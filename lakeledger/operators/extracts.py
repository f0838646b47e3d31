"""SCD type 2 from a series of full extracts: gaps and islands over presence.

Each extract lists every key there is at its instant; a key that an extract lacks is
gone from then on.  A version is an island: consecutive extracts that hold the key
with the same tracked values.  All extracts of a series, however many, are laid out
once by (key, number of the extract); two ordered scans find where islands begin and
end.  Nothing is folded extract by extract.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import changed_expr
from .ordered import PART, cut, keyed_scan, ordered_layout
from .scd2 import not_before

N = "_n"


def scd2_extract_series(target: DataFrame | None, extracts: DataFrame, instants: Sequence, keys: Sequence[str],
                        tracked: Sequence[str], at_col: str = "_at", columns: Sequence[str] | None = None,
                        start_col: str = "scd_start_date", end_col: str = "scd_end_date",
                        current_col: str = "is_current", version_col: str = "scd_version") -> DataFrame:
    """The state of ``target`` (None at first) after all ``extracts``, as if applied one by one in time.

    ``extracts`` has the rows of all of them, each with its extract's instant in
    ``at_col`` and one row per key and instant.  ``instants`` names every extract, also
    those without rows: they end all versions.  Extracts are placed by their instants,
    in whatever order they are given; the query fails if one is older than what
    ``target`` holds.  Rows with a NULL key are rejected.  A version keeps the other
    ``columns`` of its first row.
    """
    keys, tracked = list(keys), list(tracked)
    payload = [c for c in (columns if columns is not None else tracked) if c not in keys]
    times = sorted({str(i) for i in instants})
    out = [*keys, *payload, start_col, end_col, current_col, version_col]
    if not times:
        raise ValueError("no extract is named")
    at = F.array(*[F.lit(t).cast("timestamp_ntz") for t in times])  # grows with the extracts that wait, not with rows
    held = list(dict.fromkeys([*keys, *payload, *tracked]))
    rows = extracts.dropna(subset=keys).select(
        *held, F.array_position(at, F.col(at_col).cast("timestamp_ntz")).cast("int").alias(N),
        F.lit(None).cast("timestamp_ntz").alias("_start"), F.lit(None).cast("bigint").alias("_v"))
    rows = rows.filter(F.col(N) > 0)
    if target is not None:  # what is current counts as extract 0
        rows = target.filter(F.col(current_col)).select(
            *held, F.lit(0).alias(N), F.col(start_col).cast("timestamp_ntz").alias("_start"),
            F.col(version_col).cast("bigint").alias("_v")).unionByName(rows)
    s = keyed_scan(ordered_layout(rows, keys, [N]), keys, [N], lag=[N, *tracked], lead=[N, *tracked],
                   lag_prefix="_p_", lead_prefix="_x_")
    begins = F.col("_p_" + N).isNull() | (F.col("_p_" + N) != F.col(N) - 1) | changed_expr(tracked, None, None, "_p_")
    ends = F.col("_x_" + N).isNull() | (F.col("_x_" + N) != F.col(N) + 1) | changed_expr(tracked, None, None, "_x_")
    edges = cut(s.withColumns({"_begins": begins, "_ends": ends, "_until": F.when(ends, F.get(at, F.col(N)))})
                .filter("_begins or _ends")
                .select(*held, N, "_start", "_v", "_begins", "_ends", "_until", PART), "extract_edges")
    e = keyed_scan(edges, keys, [N], lead=["_until"], lead_prefix="_next", row_number="_i",
                   counted=F.col("_begins") & (F.col(N) > 0)).filter("_begins")
    stored = F.lit(0).cast("bigint")
    if target is not None:
        e = e.join(target.groupBy(*keys).agg(F.max(version_col).alias("_stored")), on=keys, how="left")
        stored = F.coalesce("_stored", F.lit(0).cast("bigint"))
    first = F.get(at, F.col(N) - 1)
    if target is not None:
        first = F.when(F.col(N) == 1, not_before(target, at[0], start_col, end_col)).otherwise(first)
    until = F.when(F.col("_ends"), F.col("_until")).otherwise(F.col("_next_until"))
    if target is not None:  # a current version that only ends is checked as well
        until = F.when(until == at[0], not_before(target, at[0], start_col, end_col)).otherwise(until)
    got = e.select(*keys, *payload, F.when(F.col(N) == 0, F.col("_start")).otherwise(first).alias(start_col),
                   until.alias(end_col),
                   F.when(F.col(N) == 0, F.col("_v")).otherwise(stored + F.col("_i")).cast("bigint").alias(version_col))
    got = got.withColumn(current_col, F.col(end_col).isNull()).select(*out)
    return got if target is None else target.filter(~F.col(current_col)).select(*out).unionByName(got)
