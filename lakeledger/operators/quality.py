"""Data quality: quarantine split, schema enforcement, expectations, drift.

Rejected rows are kept (with the reasons), never dropped silently.  All
checks are column expressions evaluated in the same scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASONS = "_reject_reasons"


def reject_reasons(rules: dict[str, Column]) -> Column:
    """Array of the names of rules that are not TRUE (NULL counts as failed)."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))


def with_reject_reasons(df: DataFrame, rules: dict[str, Column], col: str = REASONS) -> DataFrame:
    return df.withColumn(col, reject_reasons(rules))


def split_valid(df: DataFrame, rules: dict[str, Column],
                col: str = REASONS) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``_reject_reasons``).

    Both outputs share one lineage; persist the input (e.g. inside
    ``foreachBatch``) when both are written.
    """
    tagged = with_reject_reasons(df, rules, col)
    valid = tagged.filter(F.size(F.col(col)) == 0).drop(col)
    rejects = tagged.filter(F.size(F.col(col)) > 0)
    return valid, rejects


def enforce_schema(df: DataFrame, schema: T.StructType,
                   col: str = REASONS) -> tuple[DataFrame, DataFrame]:
    """Project onto ``schema``: try-cast every field, check NOT NULL.

    A row is rejected if a non-nullable field is NULL, a field is missing
    and non-nullable, or a present value cannot be cast to its type.
    Valid rows get exactly ``schema``'s columns and types.
    """
    present = {c.lower(): c for c in df.columns}
    typed, rules = {}, {}
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            typed[f.name] = F.lit(None).cast(f.dataType)
            if not f.nullable:
                rules[f"{f.name}_missing"] = F.lit(False)
            continue
        raw = F.col(src)
        if isinstance(df.schema[src].dataType, T.StringType) and not isinstance(f.dataType, T.StringType):
            raw = F.trim(raw)
        cast = raw if df.schema[src].dataType == f.dataType else raw.try_cast(f.dataType)
        typed[f.name] = cast
        rules[f"{f.name}_type"] = F.col(src).isNull() | cast.isNotNull()
        if not f.nullable:
            rules[f"{f.name}_not_null"] = F.col(src).isNotNull()
    tagged = df.withColumn(col, reject_reasons(rules))
    valid = tagged.filter(F.size(F.col(col)) == 0).select(
        *[typed[f.name].alias(f.name) for f in schema.fields])
    rejects = tagged.filter(F.size(F.col(col)) > 0)
    return valid, rejects


def expectation_counts(df: DataFrame, rules: dict[str, Column],
                       total_col: str = "n_rows") -> DataFrame:
    """One row: total rows and, per rule, the number of rows failing it."""
    return df.agg(F.count(F.lit(1)).alias(total_col),
                  *[F.count_if(~F.coalesce(r, F.lit(False))).alias(f"failed_{n}") for n, r in rules.items()])


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Per expected column: how the data deviates from the declared schema.

    Columns: column, expected_type, actual_type, kind (ok / missing /
    type_mismatch / unexpected), n_bad_values (present values that do not
    cast to the expected type; counted over the whole table in one pass).
    """
    present = {c.lower(): c for c in df.columns}
    exp_names = {f.name.lower() for f in expected.fields}
    aggs, meta = [], []
    for f in expected.fields:
        src = present.get(f.name.lower())
        if src is None:
            meta.append((f.name, f.dataType.simpleString(), None, "missing", None))
            continue
        at = df.schema[src].dataType
        raw = F.trim(F.col(src)) if isinstance(at, T.StringType) else F.col(src)
        bad = F.col(src).isNotNull() & raw.try_cast(f.dataType).isNull() if at != f.dataType else F.lit(False)
        aggs.append(F.count_if(bad).cast("bigint").alias(f"b{len(meta)}"))
        kind = "ok" if at == f.dataType else "type_mismatch"
        meta.append((f.name, f.dataType.simpleString(), at.simpleString(), kind, f"b{len(meta)}"))
    for c in df.columns:
        if c.lower() not in exp_names:
            meta.append((c, None, df.schema[c].dataType.simpleString(), "unexpected", None))
    counts = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("_n"))
    rows = [F.struct(F.lit(n).alias("column"), F.lit(e).cast("string").alias("expected_type"),
                     F.lit(a).cast("string").alias("actual_type"), F.lit(k).alias("kind"),
                     (F.col(b) if b else F.lit(None).cast("bigint")).alias("n_bad_values"))
            for n, e, a, k, b in meta]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
