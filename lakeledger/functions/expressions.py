"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ref(side: str | None, c: str) -> Column:
    return F.col(f"{side}.{c}") if side else F.col(c)


def changed_expr(tracked: Sequence[str], left: str | None = "t", right: str | None = "s",
                 right_prefix: str = "") -> Column:
    """TRUE when any tracked column differs, treating NULL as a value.

    ``a <> b OR (a IS NULL) <> (b IS NULL)`` per column, written as ``NOT a <=> b``.
    """
    if not tracked:
        return F.lit(False)
    return reduce(or_, [~_ref(left, c).eqNullSafe(_ref(right, right_prefix + c)) for c in tracked])


def join_on_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys meet: ``left``'s columns, then the others of ``right``."""
    met = left.alias("_l").join(right.alias("_r"), reduce(
        and_, [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]), how)
    if how in ("left_semi", "left_anti"):
        return met
    return met.select("_l.*", *[F.col(f"_r.{c}") for c in right.columns if c not in set(keys)])
