"""Raw text -> typed silver columns, and deterministic surrogate keys.

Every cast is a *try* cast: with ANSI mode on, a plain cast of 'maybe' to
boolean or of '2024-13-40' to date fails the whole job.  A value that was
present in the input but became NULL is a cast failure; :func:`cast_failures`
names those columns so the row can be quarantined instead of silently
losing data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def text(c: str) -> Column:
    """Trim both sides; empty text becomes NULL."""
    t = F.trim(F.col(c))
    return F.when(t == F.lit(""), F.lit(None)).otherwise(t)


def upper_text(c: str) -> Column:
    return F.upper(text(c))


def to_date_safe(c: str, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(text(c), fmt)


def to_bool_safe(c: str) -> Column:
    """'Yes'/'No'/'true'/'1'… -> boolean; anything else -> NULL (no exception)."""
    return text(c).try_cast("boolean")


def to_type_safe(c: str, type_name: str) -> Column:
    return text(c).try_cast(type_name) if type_name != "string" else text(c)


def cast_failures(raw: DataFrame, spec: dict[str, Column], name: str = "_cast_failures") -> DataFrame:
    """Add the typed columns plus an array naming columns whose cast failed."""
    staged = raw.withColumns({f"__typed_{c}": e for c, e in spec.items()})
    fails = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != F.lit(""))
               & F.col(f"__typed_{c}").isNull(), F.lit(c))
        for c in spec]))
    out = staged.withColumn(name, fails)
    out = out.withColumns({c: F.col(f"__typed_{c}") for c in spec})
    return out.drop(*[f"__typed_{c}" for c in spec])


def surrogate_key_expr(keys: Sequence[str]) -> Column:
    keys = list(keys)
    if len(keys) == 1:
        return F.sha2(F.col(keys[0]).cast("string"), 256)
    return F.sha2(F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys]), 256)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Stable bucket of a key, for partitioned history / log directories."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
