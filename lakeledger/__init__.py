"""lakeledger: bronze -> silver -> gold change-data pipelines on plain PySpark.

Modules: ``functions`` (column expressions), ``operators`` (DataFrame ->
DataFrame: dedup, merge / SCD1, SCD2, apply_changes, change feeds, quality,
gold reports, skew-safe ordered scans), ``sources`` (file streams, schemas,
versioned Parquet snapshots), ``streaming`` (checkpointed sinks and
idempotent ``foreachBatch`` silver writers), ``plans`` (medallion runner and
the registered queries).
"""

__version__ = "0.1.0"
