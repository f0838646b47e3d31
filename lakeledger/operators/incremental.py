"""New rows since the last run, late ones included.

A high-water mark alone loses each row that arrives with a time at or before it.
:class:`IncrementalReader` reads again what lies within ``lookback`` of the mark and
leaves out, by an exact anti join, the ids it has handed out before.  The ids are kept
with their times, so only those within the look-back are read and joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import join_on_key
from ..sources.snapshots import list_versions, path_exists


class IncrementalReader:
    """Hands out each row of a growing table once; its progress lies under ``base``.

    ``lookback``: an interval (``"3 days"``); a row that arrives later than that is not
    seen.  None: whatever its time, a row is handed out, at the price of joining all
    ids.  ``ids`` identify a row; rows with equal ids are one delivery.  A row whose
    time is NULL is handed out once, when it is first seen.
    """

    def __init__(self, base: str, ts_col: str, ids: Sequence[str], lookback: str | None = None):
        self.base, self.ts_col, self.ids, self.lookback = base, ts_col, list(ids), lookback

    def _handled(self, spark, schema) -> DataFrame:
        from pyspark.sql import types as T
        fields = T.StructType([schema[c] for c in dict.fromkeys([*self.ids, self.ts_col])])
        return spark.read.schema(fields).option("basePath", self.base).parquet(f"{self.base}/run=*")

    def read(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` that no committed run has handed out."""
        spark = df.sparkSession
        if not list_versions(spark, self.base, "run="):
            return df.dropDuplicates(self.ids)
        handled = self._handled(spark, df.schema)
        if self.lookback is not None:
            since = handled.agg((F.max(self.ts_col).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.lookback}"))
                                .cast("string")).first()[0]
            if since is not None:  # a literal, so that it reaches both scans
                bound = F.lit(since).cast(df.schema[self.ts_col].dataType)
                recent = F.col(self.ts_col).isNull() | (F.col(self.ts_col) >= bound)
                df, handled = df.filter(recent), handled.filter(recent)
        return join_on_key(df.dropDuplicates(self.ids), handled.select(*self.ids).distinct(), self.ids, "left_anti")

    def commit(self, rows: DataFrame, run: int) -> None:
        """Note that ``rows`` of run ``run`` are handled; a run that was committed stays as it is."""
        out = f"{self.base}/run={int(run)}"
        if not path_exists(rows.sparkSession, f"{out}/_SUCCESS"):
            rows.select(*dict.fromkeys([*self.ids, self.ts_col])).sortWithinPartitions(self.ts_col) \
                .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(out)
