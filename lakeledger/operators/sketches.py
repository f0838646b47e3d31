"""Quality over time: a row of mergeable sketches per batch, merged for any span of batches.

Per batch one aggregation gives, for chosen columns, the rows, the NULLs, an HLL
sketch of the distinct values and a KLL sketch of the distribution (Spark's own
aggregates).  A span is answered from those rows; the data of old batches is not
read.  A key is counted exactly only where its sketch can't settle the question.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import duplicate_keys

#: Size of the HLL sketches (2^14 registers) and three times their relative standard error.
HLL_LG_K, HLL_ERROR = 14, 0.025
#: Size of the KLL sketches; ranks are within 0.03 of the true ones.
KLL_K, KLL_ERROR = 200, 0.03


def _countable(df: DataFrame, col: str):
    whole = isinstance(df.schema[col].dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
    return F.col(col) if whole else F.col(col).cast("string")


class SketchLog:
    """Sketches by batch under ``base``: one log for one stream, or for one series of batches.

    ``distinct``: columns whose distinct values are counted (NULL is none).
    ``quantiles``: numeric columns whose distribution is kept (NULL and NaN are none).
    """

    def __init__(self, base: str, distinct: Sequence[str], quantiles: Sequence[str] = ()):
        self.base, self.distinct, self.quantiles = base, list(distinct), list(quantiles)
        self.columns = list(dict.fromkeys([*self.distinct, *self.quantiles]))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Note a batch (a ``foreachBatch`` function); a replayed batch replaces itself."""
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.columns]
        hll = [F.hll_sketch_agg(_countable(batch, c), HLL_LG_K).alias(f"hll_{c}") for c in self.distinct]
        kll = [F.kll_sketch_agg_double(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), KLL_K)
               .alias(f"kll_{c}") for c in self.quantiles]
        batch.agg(F.count(F.lit(1)).alias("n_rows"), *nulls, *hll, *kll).write.mode("overwrite") \
            .option("partitionOverwriteMode", "static").parquet(f"{self.base}/batch={int(batch_id)}")

    def merged(self, spark: SparkSession, first: int | None = None, last: int | None = None) -> DataFrame:
        """One row: the sketches of batches ``first`` to ``last`` as one."""
        rows = spark.read.option("basePath", self.base).parquet(f"{self.base}/batch=*")
        if first is not None:
            rows = rows.filter(F.col("batch") >= first)
        if last is not None:
            rows = rows.filter(F.col("batch") <= last)
        return rows.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
                        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in self.columns],
                        *[F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}") for c in self.distinct],
                        *[F.kll_merge_agg_double(f"kll_{c}").alias(f"kll_{c}") for c in self.quantiles])

    def report(self, spark: SparkSession, first: int | None = None, last: int | None = None,
               at: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        """Per column ``column_name, n_rows, n_null, n_distinct, quantiles, uniqueness``.

        ``n_distinct`` is within ``HLL_ERROR``, the ranks of ``quantiles`` (those ``at``)
        within ``KLL_ERROR``.  ``uniqueness``: ``no`` if values must repeat, ``check`` if
        the sketch can't tell; see :meth:`duplicates`.
        """
        def quantiles(c):
            ranks = F.array(*[F.lit(float(q)) for q in at])
            some = F.kll_sketch_get_n_double(f"kll_{c}") > 0
            return F.when(some, F.kll_sketch_get_quantile_double(f"kll_{c}", ranks))

        rows = []
        for c in self.columns:
            n = F.hll_sketch_estimate(f"hll_{c}") if c in self.distinct else F.lit(None).cast("bigint")
            sure = n * (1 + HLL_ERROR) < F.col("n_rows") - F.col(f"null_{c}")
            rows.append(F.struct(
                F.lit(c).alias("column_name"), F.col("n_rows"), F.col(f"null_{c}").alias("n_null"),
                n.alias("n_distinct"),
                (quantiles(c) if c in self.quantiles else F.lit(None)).cast("array<double>").alias("quantiles"),
                F.when(n.isNotNull(), F.when(sure, F.lit("no")).otherwise(F.lit("check"))).alias("uniqueness")))
        return self.merged(spark, first, last).select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    def duplicates(self, df: DataFrame, keys: Sequence[str], first: int | None = None,
                   last: int | None = None) -> dict[str, DataFrame]:
        """Exact repeated values, only of those ``keys`` that the sketches leave open."""
        report = self.report(df.sparkSession, first, last)
        left = {r.column_name for r in report.filter("uniqueness = 'check'").select("column_name").collect()}
        return {k: duplicate_keys(df.filter(F.col(k).isNotNull()), [k]) for k in keys if k in left}
