"""SCD type 2: history from a change log, incremental apply, as-of lookups.

History from a log (one shuffle by key, no iteration).  Per key, in the
total order ``sequence``:

1. keep an event if it is a delete that follows a live version, or an
   upsert that is the first event, follows a delete, or differs null-safely
   from the previous event's tracked values;
2. on the kept events, ``end = start of the next kept event``;
3. drop the deletes; ``version = position``; ``is_current = end IS NULL``.

All ordered steps go through :func:`keyed_scan` on one layout by range of
(keys, sequence), so no single task owns a huge key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import changed_expr, join_on_key
from .ordered import PART, cut, keyed_scan, ordered_layout


def scd2_history(log: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 sequence: Sequence[str], is_delete: Column | None = None,
                 columns: Sequence[str] | None = None,
                 start_col: str = "scd_start_date", end_col: str = "scd_end_date",
                 current_col: str | None = "is_current", version_col: str | None = "scd_version") -> DataFrame:
    """Validity intervals per key from an ordered change log.

    ``columns``: payload kept on each version (default: ``tracked``).  The
    start of a version is the first ``sequence`` column of its event.
    """
    keys, tracked, sequence = list(keys), list(tracked), list(sequence)
    payload = list(columns) if columns is not None else tracked
    extra = [c for c in payload if c not in tracked and c not in keys]
    base_cols = list(dict.fromkeys([*keys, *sequence, *tracked, *extra]))
    ev = log.select(*base_cols, (is_delete if is_delete is not None else F.lit(False)).alias("_del"))
    ev = ev.withColumn("_del", F.coalesce(F.col("_del"), F.lit(False)))
    s1 = keyed_scan(ordered_layout(ev, keys, sequence), keys, sequence, lag=["_del", *tracked], lag_prefix="_p_")
    pd = F.col("_p__del")
    differs = changed_expr(tracked, None, None, right_prefix="_p_")
    keep = ((F.col("_del") & (pd == F.lit(False)))
            | (~F.col("_del") & (pd.isNull() | pd | differs)))
    # the kept events are read twice by the next step: written once, the first step runs once
    kept = cut(s1.filter(keep).select(*ev.columns, PART), "scd2_kept")

    out = keyed_scan(kept, keys, sequence, lead=[sequence[0]], lead_prefix="_n_",
                     row_number="_v" if version_col else None, counted=~F.col("_del"))
    out = out.filter(~F.col("_del")).withColumn(end_col, F.col("_n_" + sequence[0]))
    if version_col:
        out = out.withColumn(version_col, F.col("_v").cast("bigint"))
    sel = [*keys, *[c for c in payload if c not in keys],
           F.col(sequence[0]).alias(start_col), F.col(end_col)]
    if current_col:
        sel.append(F.col(end_col).isNull().alias(current_col))
    if version_col:
        sel.append(F.col(version_col))
    return out.select(*sel)


def current_rows(history: DataFrame, current_col: str = "is_current") -> DataFrame:
    return history.filter(F.col(current_col))


def as_of_date(history: DataFrame, t, start_col: str = "scd_start_date",
               end_col: str = "scd_end_date") -> DataFrame:
    """Versions valid at instant ``t``: ``start <= t < end`` (open end = NULL)."""
    tc = t if isinstance(t, Column) else F.lit(t).cast(history.schema[start_col].dataType)
    return history.filter((F.col(start_col) <= tc)
                          & (F.col(end_col).isNull() | (tc < F.col(end_col))))


def as_of_join(facts: DataFrame, history: DataFrame, keys: Sequence[str], t_col: str,
               columns: Sequence[str], fact_order: Sequence[str] = (),
               start_col: str = "scd_start_date", end_col: str = "scd_end_date",
               prefix: str = "") -> DataFrame:
    """Left as-of join: each fact gets the version of its key valid at ``t``.

    Written as union + ordered forward fill, not as an equi join with a range
    residual: the latter compares every fact of a key with every version of
    the key, which explodes on a hot key.  Of versions that start at one
    instant the one that lasts longest counts; empty ones never do.
    """
    keys = list(keys)
    fact_cols = facts.columns
    hv = F.struct(*[F.col(c) for c in columns], F.col(end_col).alias("__end"))
    # A version that ends where it starts is valid at no instant.
    h = history.dropna(subset=keys).filter(F.col(end_col).isNull() | (F.col(start_col) < F.col(end_col)))
    h = h.select(*[F.col(k) for k in keys], F.col(start_col).alias("_t"), F.lit(0).alias("_kind"),
                 F.col(end_col).isNull().alias("_open"), F.col(end_col).alias("_until"), hv.alias("_h"),
                 *[F.lit(None).cast(facts.schema[c].dataType).alias(c)
                   for c in fact_cols if c not in keys])
    f = facts.select(*[F.col(k) for k in keys], F.col(t_col).cast(history.schema[start_col].dataType).alias("_t"),
                     F.lit(1).alias("_kind"), F.lit(None).cast("boolean").alias("_open"),
                     F.lit(None).cast(history.schema[end_col].dataType).alias("_until"),
                     F.lit(None).cast(hv_type(history, columns, end_col)).alias("_h"),
                     *[F.col(c) for c in fact_cols if c not in keys])
    u = h.unionByName(f)
    order = ["_t", "_kind", "_open", "_until", *fact_order]
    s = keyed_scan(u, keys, order, ffill=["_h"], ffill_prefix="_last")
    s = s.filter(F.col("_kind") == 1)
    hit = F.col("_last_h").isNotNull() & (F.col("_last_h.__end").isNull()
                                          | (F.col("_t") < F.col("_last_h.__end")))
    return s.select(*[F.col(c) for c in fact_cols],
                    *[F.when(hit, F.col("_last_h")[c]).alias(prefix + c) for c in columns])


def hv_type(history: DataFrame, columns: Sequence[str], end_col: str):
    from pyspark.sql import types as T
    fields = [T.StructField(c, history.schema[c].dataType, True) for c in columns]
    fields.append(T.StructField("__end", history.schema[end_col].dataType, True))
    return T.StructType(fields)


def scd2_apply(target: DataFrame, log: DataFrame, batch: DataFrame, keys: Sequence[str],
               tracked: Sequence[str], sequence: Sequence[str], is_delete: Column | None = None,
               columns: Sequence[str] | None = None, **names) -> DataFrame:
    """Incremental SCD2: rebuild only the keys present in ``batch`` from the log.

    ``log`` is the full change log *including* the batch (bronze).  Rebuilding
    from the log rather than from stored intervals keeps late, out-of-order
    events exact.  Untouched keys are copied through a ``left_anti`` join
    (broadcastable batch keys); touched keys' log rows are found with a
    ``left_semi`` join — neither join can multiply rows.
    """
    keys = list(keys)
    touched = batch.select(*keys).distinct()
    log_t = join_on_key(log, touched, keys, "left_semi")
    rebuilt = scd2_history(log_t, keys, tracked, sequence, is_delete=is_delete,
                           columns=columns, **names)
    kept = join_on_key(target, touched, keys, "left_anti")
    return kept.unionByName(rebuilt.select(*target.columns))


def scd2_append_latest(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                       tracked: Sequence[str], start: str, start_col: str = "scd_start_date",
                       end_col: str = "scd_end_date", current_col: str = "is_current",
                       version_col: str = "scd_version") -> DataFrame:
    """Fast path: every incoming row (one per key) is newer than the key's history.

    Returns the changed rows only: expired old versions (``is_current=false``,
    end = new start) and new current versions (``version = old + 1`` or 1).
    Unchanged keys produce nothing.
    """
    keys, tracked = list(keys), list(tracked)
    cur = current.filter(F.col(current_col)).alias("t")
    inc = incoming.alias("s")
    same = reduce(and_, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    j = inc.join(cur, same, "left").select("s.*", F.struct("t.*").alias("_t"))
    j = j.select(F.struct(*incoming.columns).alias("s"), F.col("_t").alias("t"), *keys)
    has_t = F.col(f"t.{version_col}").isNotNull()
    chg = ~has_t | changed_expr(tracked, "t", "s")
    j = j.filter(chg)
    payload = [c for c in current.columns if c not in keys + [start_col, end_col, current_col, version_col]]
    new_rows = j.select(*keys, *[F.col(f"s.{c}").alias(c) for c in payload],
                        F.col(f"s.{start}").alias(start_col),
                        F.lit(None).cast(current.schema[end_col].dataType).alias(end_col),
                        F.lit(True).alias(current_col),
                        F.coalesce(F.col(f"t.{version_col}") + 1, F.lit(1).cast("bigint")).alias(version_col))
    expired = j.filter(has_t).select(*keys, *[F.col(f"t.{c}").alias(c) for c in payload],
                                     F.col(f"t.{start_col}").alias(start_col),
                                     F.col(f"s.{start}").cast(current.schema[end_col].dataType).alias(end_col),
                                     F.lit(False).alias(current_col),
                                     F.col(f"t.{version_col}").alias(version_col))
    return expired.unionByName(new_rows).select(*current.columns)


LAST_SEQ = "_last_seq"


def scd2_key_state(log: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Per key, the greatest event sequence seen (no-op updates and deletes included)."""
    keys, sequence = list(keys), list(sequence)
    return log.groupBy(*keys).agg(F.max(F.struct(*sequence)).alias(LAST_SEQ))


def scd2_apply_fast(target: DataFrame, state: DataFrame, batch: DataFrame, log: DataFrame | None,
                    keys: Sequence[str], tracked: Sequence[str], sequence: Sequence[str],
                    is_delete: Column | None = None, columns: Sequence[str] | None = None,
                    start_col: str = "scd_start_date", end_col: str = "scd_end_date",
                    current_col: str = "is_current", version_col: str = "scd_version"
                    ) -> tuple[DataFrame, DataFrame]:
    """Incremental SCD2 that reads the log only for keys with late events.

    ``state`` is :func:`scd2_key_state` of everything applied so far.  A key
    whose batch events are all newer than its ``_last_seq`` (or that is new) is
    continued from its last version: that version becomes a synthetic first
    event (an upsert with its values, or a delete at its end if it was
    closed), the batch events follow, and the usual rules run on this short
    sequence with version numbers continuing.  Other keys are rebuilt from
    ``log`` (which must then include the batch).  Returns (history, state).
    """
    keys, tracked, sequence = list(keys), list(tracked), list(sequence)
    payload = list(columns) if columns is not None else tracked
    pcols = [c for c in payload if c not in keys]
    seq0 = sequence[0]
    ev = batch.select(*dict.fromkeys([*keys, *sequence, *tracked, *pcols]),
                      F.coalesce(is_delete if is_delete is not None else F.lit(False), F.lit(False)).alias("_del"))
    first_in = ev.groupBy(*keys).agg(F.min(F.struct(*sequence)).alias("_first"))
    verdict = (join_on_key(first_in, state, keys, "left")
                       .select(*keys, (F.col(LAST_SEQ).isNull() | (F.col("_first") > F.col(LAST_SEQ)))
                               .alias("_in_order")))
    # The key verdict and the last versions are small; writing them to the shared
    # folder cuts their lineage, so the final plan does not re-derive them through
    # several self-joins of the same inputs.
    from ..session import scratch_path
    spark = target.sparkSession
    tmp = scratch_path(spark, "scd2_fast")
    verdict.write.parquet(f"{tmp}/verdict")
    verdict = spark.read.parquet(f"{tmp}/verdict")
    in_order = verdict.filter("_in_order").select(*keys)
    late = verdict.filter(~F.col("_in_order")).select(*keys)
    # one small eager count (at most two rows) lets us skip an empty branch
    n = {bool(r["_in_order"]): r["n"] for r in
         verdict.groupBy("_in_order").agg(F.count(F.lit(1)).alias("n")).collect()}

    kept = join_on_key(target, late, keys, "left_anti")
    cont = None
    if n.get(True):
        # Last version of each in-order key (current, or closed by a delete): a
        # partial max_by aggregate, so a key with many versions is no hot task.
        rest = [c for c in target.columns if c not in keys]
        last = (join_on_key(target, in_order, keys, "left_semi").groupBy(*keys)
                      .agg(F.max_by(F.struct(*rest), F.col(version_col)).alias("_r"))
                      .select(*keys, *[F.col("_r")[c].alias(c) for c in rest]))
        last.write.parquet(f"{tmp}/last")
        last = spark.read.parquet(f"{tmp}/last")
        # The synthetic event sorts first among equal first-sequence values (rank 0).
        order = [seq0, "_rank", *sequence[1:]]
        synth = last.select(
            *keys,
            F.when(F.col(current_col), F.col(start_col)).otherwise(F.col(end_col))
             .cast(ev.schema[seq0].dataType).alias(seq0),
            F.lit(0).alias("_rank"),
            *[(F.col(c) if c in last.columns else F.lit(None)).cast(ev.schema[c].dataType).alias(c)
              for c in dict.fromkeys([*sequence[1:], *tracked, *pcols]) if c != seq0],
            (~F.col(current_col)).alias("_del"),
            F.col(version_col).alias("_base_v"), F.col(current_col).alias("_was_current"))
        batch_in = join_on_key(ev, in_order, keys, "left_semi").withColumn("_rank", F.lit(1))
        short = synth.unionByName(batch_in, allowMissingColumns=True)
        offsets = synth.select(*keys, (F.col("_base_v") - F.when(F.col("_was_current"), 1).otherwise(0))
                               .alias("_off"))
        cont = scd2_history(short.drop("_base_v", "_was_current"), keys, tracked, order,
                            is_delete=F.col("_del"), columns=payload, start_col=start_col, end_col=end_col,
                            current_col=current_col, version_col=version_col)
        cont = (join_on_key(cont, offsets, keys, "left")
                    .withColumn(version_col, (F.col(version_col) + F.coalesce("_off", F.lit(0))).cast("bigint"))
                    .drop("_off"))
        # old rows kept: untouched keys, and in-order keys' rows except a current last version
        replaced = last.filter(F.col(current_col)).select(*keys, version_col)
        kept = join_on_key(kept, replaced, [*keys, version_col], "left_anti")
    parts = [kept] + ([cont.select(*target.columns)] if cont is not None else [])
    if n.get(False):
        if log is None:
            raise ValueError("late events for some keys: pass the log to rebuild them")
        rebuilt = scd2_history(join_on_key(log, late, keys, "left_semi"), keys, tracked, sequence,
                               is_delete=is_delete, columns=columns, start_col=start_col, end_col=end_col,
                               current_col=current_col, version_col=version_col)
        parts.append(rebuilt.select(*target.columns))
    history = parts[0]
    for p in parts[1:]:
        history = history.unionByName(p)
    new_state = (state.unionByName(ev.groupBy(*keys).agg(F.max(F.struct(*sequence)).alias(LAST_SEQ)))
                      .groupBy(*keys).agg(F.max(LAST_SEQ).alias(LAST_SEQ)))
    return history, new_state


def not_before(target: DataFrame, at: Column, start_col: str, end_col: str) -> Column:
    """``at``; the query fails if ``target`` holds a version that began or ended later."""
    newest = target.agg(F.max(F.greatest(start_col, end_col))).scalar()
    late = F.concat(F.lit("an extract of "), at.cast("string"), F.lit(" is older than the table's newest version, "),
                    newest.cast("string"), F.lit("; build the history again from all extracts"))
    return F.when(newest > at, F.raise_error(late).cast("timestamp_ntz")).otherwise(at)


def scd2_apply_snapshot(target: DataFrame | None, extract: DataFrame, keys: Sequence[str],
                        tracked: Sequence[str], at, columns: Sequence[str] | None = None,
                        start_col: str = "scd_start_date", end_col: str = "scd_end_date",
                        current_col: str = "is_current", version_col: str = "scd_version") -> DataFrame:
    """SCD2 from full extracts: the next state of ``target`` after the extract taken ``at``.

    ``extract`` has one row per key and all keys there are.  A new key gets a
    version, a changed one ends its version and gets the next, an unchanged one
    stays, and the current version of a key gone from the extract ends; a key that
    comes back goes on counting.  ``target`` is None at first.  All joins are
    between rows unique per key.  The query fails if ``at`` is before what ``target``
    holds.  For several extracts see :func:`~lakeledger.operators.extracts.scd2_extract_series`.
    """
    keys, tracked = list(keys), list(tracked)
    payload = [c for c in (columns if columns is not None else tracked) if c not in keys]
    when = at if isinstance(at, Column) else F.lit(at).cast("timestamp_ntz")
    new = extract.dropna(subset=keys).select(*keys, *payload, when.alias(start_col), F.lit(None).cast("timestamp_ntz").alias(end_col),
                         F.lit(True).alias(current_col))
    out = [*keys, *payload, start_col, end_col, current_col, version_col]
    if target is None:
        return new.withColumn(version_col, F.lit(1).cast("bigint")).select(*out)
    when = not_before(target, when, start_col, end_col)
    new = new.withColumn(start_col, when)
    current = target.filter(F.col(current_col))
    met = current.alias("t").join(new.alias("s"), on=keys, how="left")
    gone = F.col(f"s.{current_col}").isNull()
    ends = gone | changed_expr(tracked, "t", "s")
    kept = met.select(*keys, *[F.col(f"t.{c}").alias(c) for c in [*payload, start_col]],
                      F.when(ends, when.cast(target.schema[end_col].dataType)).otherwise(F.col(f"t.{end_col}"))
                      .alias(end_col),
                      (~ends).alias(current_col), F.col(f"t.{version_col}").alias(version_col))
    counts = target.groupBy(*keys).agg(F.max(version_col).alias("_v"))
    same = met.filter(~ends).select(*keys)
    begun = (new.join(same, on=keys, how="left_anti").join(counts, on=keys, how="left")
             .withColumn(version_col, F.coalesce(F.col("_v"), F.lit(0).cast("bigint")) + 1))
    return (target.filter(~F.col(current_col)).select(*out).unionByName(kept.select(*out))
            .unionByName(begun.select(*out)))


__all__ = ["scd2_history", "scd2_apply", "scd2_append_latest", "current_rows",
           "as_of_date", "as_of_join", "scd2_key_state", "scd2_apply_fast", "scd2_apply_snapshot"]
