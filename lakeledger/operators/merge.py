"""MERGE re-expressed as joins: upsert, conditional update, SCD type 1.

Parquet has no MERGE, so every operator returns the *next* version of the
target as a DataFrame; :mod:`lakeledger.sources.snapshots` publishes it.

Shape of the plans (``source_kind="delta"``): the target is split with a
``left_anti`` / ``left_semi`` join against the batch keys.  When the batch is
small, Catalyst broadcasts its keys (its size is measured, not assumed) and
the big target is never shuffled; only the touched rows meet the batch in
the full outer join.  ``source_kind="snapshot"`` (a full extract: missing
keys are deletes) needs the full outer join over everything.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import surrogate_key_expr
from ..functions.expressions import changed_expr
from .dedup import latest_per_key

CREATED, UPDATED, DELETED = "_created_datetime", "_updated_datetime", "_is_deleted"
AUDIT = [CREATED, UPDATED, DELETED]


def as_timestamp(now, type_name: str = "timestamp_ntz") -> Column:
    """A fixed load time as a Column of the pipeline's timestamp kind."""
    if isinstance(now, Column):
        return now.cast(type_name)
    if isinstance(now, dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(now)).cast(type_name)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           sequence: Sequence[str] | None = None) -> DataFrame:
    """WHEN MATCHED UPDATE SET * / WHEN NOT MATCHED INSERT *.

    The source is first reduced to its latest row per key (``sequence``
    must then be given); an undeduplicated source would insert duplicates.  If
    the target stores the sequence, its row competes with the source's, so a
    late, older row changes nothing.  Source rows with a NULL key are rejected
    (they match nothing, and would pile up): quarantine them before.
    """
    keys = list(keys)
    source = source.dropna(subset=keys)
    if sequence:
        if set(sequence) <= set(target.columns):
            stored = target.join(source.select(*keys), on=keys, how="left_semi")
            source = source.select(*target.columns).unionByName(stored)
        source = latest_per_key(source, keys, sequence)
    kept = target.join(source.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(source.select(*target.columns), allowMissingColumns=False)


def merge_changed_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                       tracked: Sequence[str], action_col: str = "_merge_action") -> DataFrame:
    """Update matched rows only if a tracked column changed (null-safe).

    Adds ``_merge_action`` in {insert, update, unchanged, untouched}.  The
    source must be unique per key; its rows with a NULL key are rejected.
    Target rows whose key is not in the source are split off with a ``left_anti`` join, so only touched rows meet
    the source in the (left outer) join.
    """
    keys, tracked = list(keys), list(tracked)
    cols = [c for c in target.columns if c not in keys]
    source = source.dropna(subset=keys)
    batch_keys = source.select(*keys)
    untouched = (target.join(batch_keys, on=keys, how="left_anti")
                       .withColumn(action_col, F.lit("untouched")))
    t = target.join(batch_keys, on=keys, how="left_semi").withColumn("_in_t", F.lit(True)).alias("t")
    s = source.select(*keys, *cols).alias("s")
    j = s.join(t, on=keys, how="left")
    in_t = F.col("t._in_t").isNotNull()
    action = (F.when(~in_t, F.lit("insert"))
               .when(changed_expr(tracked, "t", "s"), F.lit("update"))
               .otherwise(F.lit("unchanged")))
    take_s = action.isin("insert", "update")
    merged = j.select(*[F.col(k) for k in keys],
                      *[F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols],
                      action.alias(action_col))
    return untouched.select(*merged.columns).unionByName(merged)


def scd1_apply(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], now, sequence: Sequence[str] | None = None,
               source_kind: str = "delta", is_delete: Column | None = None,
               sk_col: str | None = None, ts_type: str = "timestamp_ntz",
               except_column_list: Sequence[str] = (), keep_tombstones: bool = False) -> DataFrame:
    """SCD type 1 with audit times, soft delete and reactivation.

    * new key -> insert, ``_created = _updated = now``;
    * tracked column changed (null-safe) or key was soft-deleted -> overwrite,
      ``_updated = now``, ``_is_deleted = false`` (reactivation also when the
      returning values are identical);
    * explicit delete (``is_delete``) of a live key -> ``_is_deleted = true``;
      delete of an unknown key is a no-op, or with ``keep_tombstones`` (and
      ``sequence``) a deleted row that was never created, so that a late, older
      upsert of that key still loses (:func:`without_tombstones` hides it);
    * ``source_kind="snapshot"``: a live key missing from the source is
      soft-deleted; ``"delta"`` (default): missing keys are untouched;
    * with ``sequence``: a source row older than the stored one is ignored,
      so late data cannot overwrite newer values; a soft-deleted row carries
      the delete's sequence, so an older upsert cannot resurrect it, and an
      unchanged row advances the stored sequence;
    * source rows with a NULL key are rejected: quarantine them before;
    * ``except_column_list``: source columns (e.g. an operation code) that are
      read by ``is_delete`` but not stored.
    """
    keys, tracked = list(keys), list(tracked)
    now_c = as_timestamp(now, ts_type)
    deleted = is_delete if is_delete is not None else F.lit(False)
    src = source.dropna(subset=keys).withColumn("_op_del", F.coalesce(deleted, F.lit(False)))
    tombstones = keep_tombstones and bool(sequence)
    if sequence:
        src = latest_per_key(src, keys, sequence)
    payload = [c for c in source.columns if c not in keys and c not in set(except_column_list)]
    out_cols = ([sk_col] if sk_col else []) + keys + payload + AUDIT

    if target is None:
        ins = src if tombstones else src.filter(~F.col("_op_del"))
        res = ins.select(*keys, *payload,
                         F.when(~F.col("_op_del"), now_c).alias(CREATED), now_c.alias(UPDATED),
                         F.col("_op_del").alias(DELETED))
        if sk_col:
            res = res.withColumn(sk_col, surrogate_key_expr(keys))
        return res.select(*out_cols)

    if source_kind == "snapshot":
        untouched = None
        tgt = target
    else:
        batch_keys = src.select(*keys)
        untouched = target.join(batch_keys, on=keys, how="left_anti")
        tgt = target.join(batch_keys, on=keys, how="left_semi")

    t = tgt.withColumn("_in_t", F.lit(True)).alias("t")
    s = src.select(*keys, *payload, "_op_del").withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, on=keys, how="full_outer")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    t_del = F.coalesce(F.col(f"t.{DELETED}"), F.lit(False))
    s_del = F.col("s._op_del")
    late = F.lit(False)
    if sequence:
        late = F.struct(*[F.col(f"s.{c}") for c in sequence]) < F.struct(*[F.col(f"t.{c}") for c in sequence])
        late = F.coalesce(in_t & in_s & late, F.lit(False))
    chg = changed_expr(tracked, "t", "s")

    act = (F.when(~in_t & in_s & s_del, F.lit("tombstone" if tombstones else "drop"))
            .when(~in_t, F.lit("insert"))
            .when(~in_s, F.when(F.lit(source_kind == "snapshot") & ~t_del, F.lit("delete"))
                          .otherwise(F.lit("keep")))
            .when(late, F.lit("keep"))
            .when(s_del, F.when(t_del, F.lit("keep")).otherwise(F.lit("delete")))
            .when(chg | t_del, F.lit("update"))
            .otherwise(F.lit("keep")))
    j = j.withColumn("_act", act).filter(F.col("_act") != "drop")
    take_s = F.col("_act").isin("insert", "update")
    touched = F.col("_act") != "keep"
    # Whatever is not late leaves its sequence on the row: a delete, so that an older
    # upsert cannot bring the key back, and an unchanged row, so that an older one cannot win.
    seq_from_s = take_s | (in_s & ~late)
    seqs = set(sequence or ())
    merged = j.select(
        *[F.col(k) for k in keys],
        *[F.when(seq_from_s if c in seqs else take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
          for c in payload],
        F.when((F.col("_act") == "insert") | ((F.col("_act") == "update") & F.col(f"t.{CREATED}").isNull()), now_c)
         .otherwise(F.col(f"t.{CREATED}")).alias(CREATED),
        F.when(touched, now_c).otherwise(F.col(f"t.{UPDATED}")).alias(UPDATED),
        F.when(F.col("_act").isin("delete", "tombstone"), F.lit(True))
         .when(take_s, F.lit(False)).otherwise(t_del).alias(DELETED))
    if sk_col:
        merged = merged.withColumn(sk_col, surrogate_key_expr(keys))
    merged = merged.select(*out_cols)
    if untouched is None:
        return merged
    return untouched.select(*out_cols).unionByName(merged)


def without_tombstones(target: DataFrame) -> DataFrame:
    """An SCD1 table without the rows of keys that were deleted before they were ever seen."""
    return target.filter(~(F.col(DELETED) & F.col(CREATED).isNull()))


def soft_delete_missing(target: DataFrame, snapshot_keys: DataFrame, keys: Sequence[str],
                        now, ts_type: str = "timestamp_ntz") -> DataFrame:
    """WHEN NOT MATCHED BY SOURCE: flag live target rows absent from a full extract."""
    keys = list(keys)
    now_c = as_timestamp(now, ts_type)
    present = snapshot_keys.select(*keys).distinct().withColumn("_present", F.lit(True))
    j = target.join(present, on=keys, how="left")
    gone = F.col("_present").isNull() & ~F.coalesce(F.col(DELETED), F.lit(False))
    return j.withColumns({
        UPDATED: F.when(gone, now_c).otherwise(F.col(UPDATED)),
        DELETED: F.when(gone, F.lit(True)).otherwise(F.col(DELETED)),
    }).select(*target.columns)


def new_keys(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``target`` (left anti join); those with a NULL key are rejected."""
    return incoming.dropna(subset=list(keys)).join(target.select(*keys), on=list(keys), how="left_anti")
