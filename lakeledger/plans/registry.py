"""All registered queries: batch catalog plus file / streaming scenarios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _load():
    from . import catalog, streams  # noqa: F401  (streams registers into catalog)
    return catalog


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().ORACLE)
