"""Declarative change application (KEYS / SEQUENCE BY / APPLY AS DELETE /
COLUMNS * EXCEPT / STORED AS SCD TYPE 1|2) as one DataFrame function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest_per_key
from .scd2 import scd2_history

START_AT, END_AT = "__START_AT", "__END_AT"
TOMBSTONE = "__deleted"


def apply_changes(changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str] | str,
                  apply_as_deletes: Column | None = None,
                  except_column_list: Sequence[str] = (),
                  stored_as_scd_type: int = 1,
                  track_history_column_list: Sequence[str] | None = None,
                  target: DataFrame | None = None,
                  version_col: str | None = None,
                  keep_tombstones: bool = False) -> DataFrame:
    """Apply an ordered change log to a target.

    Type 1: the latest event per key wins regardless of arrival order; a
    delete removes the key (physical delete).  ``target`` (type 1 only) is
    the previous result and must carry the sequence columns; its rows take
    part in the same "latest wins" choice.  ``keep_tombstones`` keeps deleted
    keys as rows flagged ``__deleted`` (with their sequence), so a later,
    older upsert of that key still loses; readers filter the flag.

    Type 2: one row per version with ``__START_AT`` / ``__END_AT`` (NULL =
    current); an update closes the interval; a delete closes it without a new
    row; a no-op update (same tracked values) adds nothing.

    Changes with a NULL key are rejected.
    """
    keys = list(keys)
    changes = changes.dropna(subset=keys)
    seq = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    excluded = set(except_column_list)
    cols = [c for c in changes.columns if c not in excluded]
    is_del = apply_as_deletes if apply_as_deletes is not None else F.lit(False)

    if stored_as_scd_type == 1:
        stored = cols + [c for c in seq if c not in cols]
        ev = changes.withColumn("_del", F.coalesce(is_del, F.lit(False))).select(*stored, "_del")
        untouched = None
        if target is not None:
            # Only target rows whose key changed compete with the changes; the
            # rest pass through a left_anti join (no aggregation over the target).
            t_del = F.col(TOMBSTONE) if TOMBSTONE in target.columns else F.lit(False)
            t = target.select(*stored, t_del.alias("_del"))
            batch_keys = ev.select(*keys).distinct()
            untouched = t.join(batch_keys, on=keys, how="left_anti")
            ev = ev.unionByName(t.join(batch_keys, on=keys, how="left_semi"))
        last = latest_per_key(ev, keys, seq)
        if untouched is not None:
            last = untouched.select(*last.columns).unionByName(last)
        if keep_tombstones:
            return last.select(*stored, F.col("_del").alias(TOMBSTONE))
        return last.filter(~F.col("_del")).select(*cols)

    if stored_as_scd_type != 2:
        raise ValueError("stored_as_scd_type must be 1 or 2")
    if target is not None:
        raise ValueError("type 2 is built from the whole log; continue a stored history with scd2_apply")
    tracked = list(track_history_column_list) if track_history_column_list is not None else \
        [c for c in cols if c not in keys and c not in seq]
    payload = [c for c in cols if c not in keys]
    return scd2_history(changes, keys, tracked, seq, is_delete=is_del, columns=payload,
                        start_col=START_AT, end_col=END_AT, current_col=None,
                        version_col=version_col)
