"""Registered queries over the driver tables and their DuckDB oracles.

Stand-ins (see SURVEY §7.4): ``events`` is the change log (key ``user_id``,
order ``ts, event_id``, tracked ``event_type``, ``event_type = 'error'``
marks a delete); ``orders`` are encounters (key ``o_custkey``, date
``o_orderdate``, tie-break ``o_orderkey``); ``customer`` are patients.
"Old" / "batch" split the whole log at a fixed instant; both halves are
always used, so every query reads the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import cast_failures, surrogate_key_expr, text, to_bool_safe, to_date_safe
from ..functions.expressions import changed_expr
from ..operators import quality
from ..operators.cdc import apply_changes
from ..operators.changes import diff, incremental_since, postimages, read_changes, replay
from ..operators.dedup import duplicate_keys, first_per_key, latest_per_key
from ..operators.gold import cohort_rollup, entity_360, outcome_rates, readmissions, status_transitions
from ..operators.histories import join_histories
from ..operators.merge import merge_changed_only, scd1_apply, soft_delete_missing, upsert, new_keys
from ..operators.ordered import keyed_scan
from ..operators.scd2 import (as_of_date, as_of_join, current_rows, scd2_append_latest, scd2_apply,
                              scd2_apply_fast, scd2_apply_snapshot, scd2_history, scd2_key_state)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixed values of the stand-in scenario.
SPLIT = "2024-01-15 00:00:00"       # old log | batch
SPLIT_EARLY = "2024-01-01 06:00:00"  # for "new keys"
SECOND_BATCH = "2024-01-22 00:00:00"  # start of a second delta batch
AS_OF = "2024-01-20 12:00:00"
NOW1 = "2024-01-15 00:00:00"
NOW2 = "2024-02-01 00:00:00"
NOW3 = "2024-02-02 00:00:00"
VERSION_EPOCH = "2024-01-01"
FROM_VERSION = 20


def ts(v: str):
    return F.lit(v).cast("timestamp_ntz")


def sql_ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


EV_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
SEQ = ["ts", "event_id"]


def is_del():
    return F.col("event_type") == F.lit("error")


def events(spark, d) -> DataFrame:
    return table(spark, d, "events")


def _latest_sql(where: str = "TRUE", keys: str = "user_id", cols: str = "event_id, ts, user_id, event_type, value") -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE {where}) WHERE rn = 1")


# --------------------------------------------------------------------------
# Gold: flagship
# --------------------------------------------------------------------------

READMISSION_SQL = """
SELECT o_orderkey, o_custkey, o_orderdate, prev AS previous_date,
       CAST(datediff('day', prev, o_orderdate) AS INTEGER) AS days_since_last,
       CASE WHEN datediff('day', prev, o_orderdate) <= 30 THEN 1 ELSE 0 END AS is_readmission_30d
FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
      FROM orders)
"""


@register("q_readmission_30d", READMISSION_SQL)
def q_readmission_30d(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return readmissions(o, "o_custkey", "o_orderdate", tie_break=["o_orderkey"], days=30)


@register("q_prev_event", """
SELECT event_id, user_id, ts, event_type,
       lag(event_type) OVER w AS prev_event_type, lag(ts) OVER w AS prev_ts
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def q_prev_event(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts", "event_type")
    return keyed_scan(e, ["user_id"], SEQ, lag=["event_type", "ts"])


@register("q_status_transitions", """
SELECT prev AS from_status, o_orderstatus AS to_status, count(*) AS n_transitions
FROM (SELECT o_orderstatus, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
      FROM orders)
WHERE prev IS NOT NULL AND prev <> o_orderstatus
GROUP BY 1, 2
""")
def q_status_transitions(spark, d):
    o = table(spark, d, "orders")
    return status_transitions(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus")


@register("q_cohort_rollup", """
WITH per_cust AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
c AS (SELECT r.r_name, cu.c_mktsegment, cu.c_custkey, coalesce(p.n, 0) AS n
      FROM customer cu JOIN nation n ON cu.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey
      LEFT JOIN per_cust p ON p.o_custkey = cu.c_custkey)
SELECT r_name, c_mktsegment, count(*) AS n_customers, CAST(sum(n) AS BIGINT) AS n_orders,
       CAST(GROUPING_ID(r_name, c_mktsegment) AS INTEGER) AS grouping_level
FROM c GROUP BY ROLLUP (r_name, c_mktsegment)
""")
def q_cohort_rollup(spark, d):
    per_cust = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = (table(spark, d, "customer")
         .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
         .join(per_cust, F.col("o_custkey") == F.col("c_custkey"), "left")
         .select("r_name", "c_mktsegment", "c_custkey", F.coalesce("n", F.lit(0)).alias("n")))
    out = cohort_rollup(c, ["r_name", "c_mktsegment"],
                        {"n_customers": F.count(F.lit(1)), "n_orders": F.sum("n").cast("bigint")})
    return out.withColumn("grouping_level", F.col("grouping_level").cast("int"))


@register("q_outcome_rates", """
SELECT o_orderpriority, count(*) AS n_total, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_outcome,
       round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 6) AS outcome_rate
FROM orders GROUP BY o_orderpriority
""")
def q_outcome_rates(spark, d):
    return outcome_rates(table(spark, d, "orders"), ["o_orderpriority"], F.col("o_orderstatus") == "F")


@register("q_entity_360", """
WITH o AS (SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order_date,
                  arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_order_status
           FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name,
       coalesce(o.n_orders, 0) AS n_orders, o.last_order_date, o.last_order_status,
       sha256(CAST(c.c_custkey AS VARCHAR)) AS customer_sk
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN o ON o.o_custkey = c.c_custkey
""")
def q_entity_360(spark, d):
    o = (table(spark, d, "orders").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order_date"),
              F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_order_status")))
    c = table(spark, d, "customer")
    geo = (table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    base = c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
    return (entity_360(base, "c_custkey", {"orders": o.withColumnRenamed("o_custkey", "c_custkey")})
             .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name",
                     F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"),
                     "last_order_date", "last_order_status",
                     surrogate_key_expr(["c_custkey"]).alias("customer_sk")))


# --------------------------------------------------------------------------
# Filters, quality, cleaning
# --------------------------------------------------------------------------

RAW_EVENTS_SQL = ("SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_key, "
                  "ts, event_type, value FROM events")


def raw_events(spark, d):
    e = events(spark, d)
    return e.select("event_id", F.when(is_del(), F.lit(None)).otherwise(F.col("user_id")).alias("user_key"),
                    "ts", "event_type", "value")


def event_rules():
    return {
        "key_not_null": F.col("user_key").isNotNull(),
        "value_below_100": F.col("value") < 100,
        "type_known": F.col("event_type").isin("click", "view", "purchase", "signup"),
    }


RULES_SQL = [("key_not_null", "user_key IS NOT NULL"), ("value_below_100", "value < 100"),
             ("type_known", "event_type IN ('click', 'view', 'purchase', 'signup')")]


@register("q_filter_null_key", f"SELECT event_id, user_key, ts, event_type FROM ({RAW_EVENTS_SQL}) WHERE user_key IS NOT NULL")
def q_filter_null_key(spark, d):
    return raw_events(spark, d).filter(F.col("user_key").isNotNull()).select("event_id", "user_key", "ts", "event_type")


_reasons_sql = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT coalesce({e}, false) THEN '{n}' END" for n, e in RULES_SQL) + ")"


@register("q_quarantine_split", f"""
SELECT event_id, user_key, event_type, value, {_reasons_sql} = '' AS is_valid, {_reasons_sql} AS reject_reasons
FROM ({RAW_EVENTS_SQL})
""")
def q_quarantine_split(spark, d):
    valid, rejects = quality.split_valid(raw_events(spark, d), event_rules())
    cols = ["event_id", "user_key", "event_type", "value"]
    return (valid.select(*cols, F.lit(True).alias("is_valid"), F.lit("").alias("reject_reasons"))
            .unionByName(rejects.select(*cols, F.lit(False).alias("is_valid"),
                                        F.array_join(quality.REASONS, ",").alias("reject_reasons"))))


@register("q_expectation_counts", "SELECT count(*) AS n_rows, " + ", ".join(
    f"count(*) FILTER (WHERE NOT coalesce({e}, false)) AS failed_{n}" for n, e in RULES_SQL)
    + f" FROM ({RAW_EVENTS_SQL})")
def q_expectation_counts(spark, d):
    return quality.expectation_counts(raw_events(spark, d), event_rules())


@register("q_duplicate_keys", """
SELECT o_custkey, o_orderdate, count(*) AS n_rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1
""")
def q_duplicate_keys(spark, d):
    return duplicate_keys(table(spark, d, "orders"), ["o_custkey", "o_orderdate"])


def _raw_orders_text(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" n/a "))
         .otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "))).alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Yes"))
         .when(F.col("o_orderstatus") == "O", F.lit(" no ")).otherwise(F.lit("maybe")).alias("is_final"),
        F.lower(F.concat(F.lit("  "), F.col("o_orderpriority"))).alias("priority"),
        F.col("o_totalprice").cast("string").alias("total_price"))


@register("q_clean_and_cast", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false ELSE NULL END AS is_final,
       upper(o_orderpriority) AS priority, o_totalprice AS total_price,
       concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'order_date' END,
                      CASE WHEN o_orderstatus = 'P' THEN 'is_final' END) AS cast_failures
FROM orders
""")
def q_clean_and_cast(spark, d):
    raw = _raw_orders_text(spark, d)
    spec = {"order_date": to_date_safe("order_date"), "is_final": to_bool_safe("is_final"),
            "priority": F.upper(text("priority")), "total_price": text("total_price").try_cast("double")}
    out = cast_failures(raw, spec)
    return out.withColumn("cast_failures", F.array_join("_cast_failures", ",")).drop("_cast_failures")


@register("q_surrogate_key", """
SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS customer_sk,
       sha256(concat_ws(chr(1), CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR))) AS customer_nation_sk
FROM customer
""")
def q_surrogate_key(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", surrogate_key_expr(["c_custkey"]).alias("customer_sk"),
                    surrogate_key_expr(["c_custkey", "c_nationkey"]).alias("customer_nation_sk"))


def orders_schema():
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.LongType(), False),
        T.StructField("o_totalprice", T.DoubleType(), True),
        T.StructField("o_orderdate", T.DateType(), True),
        T.StructField("o_orderstatus", T.StringType(), True),
    ])


def _orders_as_text(spark, d, *more):
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "2-HIGH"), F.lit("unknown"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderstatus", *more)


@register("q_enforce_schema", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus
FROM orders WHERE o_orderpriority <> '1-URGENT' AND NOT (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
""")
def q_enforce_schema(spark, d):
    valid, _ = quality.enforce_schema(_orders_as_text(spark, d), orders_schema())
    return valid


@register("q_enforce_schema_rejects", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       concat_ws(',', CASE WHEN o_orderpriority = '1-URGENT' THEN 'o_custkey_not_null' END,
                      CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'o_totalprice_type' END) AS reject_reasons
FROM orders WHERE o_orderpriority = '1-URGENT' OR (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
""")
def q_enforce_schema_rejects(spark, d):
    _, rejects = quality.enforce_schema(_orders_as_text(spark, d), orders_schema())
    return rejects.select("o_orderkey", F.array_join(quality.REASONS, ",").alias("reject_reasons"))


# --------------------------------------------------------------------------
# Dedup
# --------------------------------------------------------------------------

@register("q_latest_per_key", _latest_sql(cols="event_id, ts, user_id, event_type, value, props"))
def q_latest_per_key(spark, d):
    return latest_per_key(events(spark, d), ["user_id"], SEQ, how="window")


@register("q_latest_per_key_agg", _latest_sql(cols="event_id, ts, user_id, event_type, value, props"))
def q_latest_per_key_agg(spark, d):
    return latest_per_key(events(spark, d), ["user_id"], SEQ, how="agg")


@register("q_first_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
""")
def q_first_per_key(spark, d):
    return first_per_key(events(spark, d), ["user_id"], SEQ)


# --------------------------------------------------------------------------
# Upserts
# --------------------------------------------------------------------------

def old_latest(spark, d, keys=("user_id",)):
    e = events(spark, d).filter(F.col("ts") < ts(SPLIT)).select(*EV_COLS)
    return latest_per_key(e, list(keys), SEQ)


def batch_rows(spark, d):
    return events(spark, d).filter(F.col("ts") >= ts(SPLIT)).select(*EV_COLS)


OLD_SQL = _latest_sql(f"ts < {sql_ts(SPLIT)}")
BATCH_SQL = _latest_sql(f"ts >= {sql_ts(SPLIT)}")


@register("q_detect_changes_nullsafe", f"""
WITH o AS ({OLD_SQL}), n AS ({_latest_sql()})
SELECT coalesce(o.user_id, n.user_id) AS user_id,
       nullif(o.event_type, 'view') AS old_event_type, nullif(n.event_type, 'view') AS new_event_type,
       nullif(o.event_type, 'view') IS DISTINCT FROM nullif(n.event_type, 'view') AS is_changed
FROM o FULL JOIN n ON o.user_id = n.user_id
""")
def q_detect_changes_nullsafe(spark, d):
    def nv(df):
        return df.select("user_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"))
    o = nv(old_latest(spark, d)).alias("t")
    n = nv(latest_per_key(events(spark, d).select(*EV_COLS), ["user_id"], SEQ)).alias("s")
    return (o.join(n, on="user_id", how="full_outer")
             .select("user_id", F.col("t.event_type").alias("old_event_type"),
                     F.col("s.event_type").alias("new_event_type"),
                     changed_expr(["event_type"], "t", "s").alias("is_changed")))


UPSERT_SQL = f"""
WITH o AS ({OLD_SQL}), b AS ({BATCH_SQL})
SELECT * FROM o WHERE user_id NOT IN (SELECT user_id FROM b)
UNION ALL SELECT * FROM b
"""


@register("q_upsert_all", UPSERT_SQL)
def q_upsert_all(spark, d):
    b = latest_per_key(batch_rows(spark, d), ["user_id"], SEQ)
    return upsert(old_latest(spark, d), b, ["user_id"])


@register("q_upsert_from_raw", UPSERT_SQL)
def q_upsert_from_raw(spark, d):
    return upsert(old_latest(spark, d), batch_rows(spark, d), ["user_id"], sequence=SEQ)


@register("q_upsert_changed_only", f"""
WITH o AS ({OLD_SQL}), b AS ({BATCH_SQL}),
j AS (SELECT coalesce(o.user_id, b.user_id) AS user_id, o.event_id AS t_id, o.ts AS t_ts, o.event_type AS t_type,
             o.value AS t_value, b.event_id AS s_id, b.ts AS s_ts, b.event_type AS s_type, b.value AS s_value,
             CASE WHEN o.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'untouched'
                  WHEN o.event_type IS DISTINCT FROM b.event_type THEN 'update' ELSE 'unchanged' END AS act
      FROM o FULL JOIN b ON o.user_id = b.user_id)
SELECT user_id,
       CASE WHEN act IN ('insert', 'update') THEN s_id ELSE t_id END AS event_id,
       CASE WHEN act IN ('insert', 'update') THEN s_ts ELSE t_ts END AS ts,
       CASE WHEN act IN ('insert', 'update') THEN s_type ELSE t_type END AS event_type,
       CASE WHEN act IN ('insert', 'update') THEN s_value ELSE t_value END AS value,
       act AS _merge_action
FROM j
""")
def q_upsert_changed_only(spark, d):
    b = latest_per_key(batch_rows(spark, d), ["user_id"], SEQ)
    return merge_changed_only(old_latest(spark, d), b, ["user_id"], ["event_type"])


@register("q_upsert_composite_key", f"""
WITH o AS ({_latest_sql(f"ts < {sql_ts(SPLIT)}", keys="user_id, event_type")}),
b AS ({_latest_sql(f"ts >= {sql_ts(SPLIT)}", keys="user_id, event_type")})
SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = o.user_id AND b.event_type = o.event_type)
UNION ALL SELECT * FROM b
""")
def q_upsert_composite_key(spark, d):
    keys = ["user_id", "event_type"]
    return upsert(old_latest(spark, d, keys), batch_rows(spark, d), keys, sequence=SEQ)


@register("q_new_keys_anti", f"""
WITH h AS (SELECT DISTINCT user_id FROM events WHERE ts < {sql_ts(SPLIT_EARLY)}),
b AS ({_latest_sql(f"ts >= {sql_ts(SPLIT_EARLY)}")})
SELECT user_id, event_type, ts FROM b WHERE user_id NOT IN (SELECT user_id FROM h)
""")
def q_new_keys_anti(spark, d):
    e = events(spark, d)
    hist = scd2_history(e.filter(F.col("ts") < ts(SPLIT_EARLY)), ["user_id"], ["event_type"], SEQ)
    b = latest_per_key(e.filter(F.col("ts") >= ts(SPLIT_EARLY)).select(*EV_COLS), ["user_id"], SEQ)
    return new_keys(b, current_rows(hist), ["user_id"]).select("user_id", "event_type", "ts")


# --------------------------------------------------------------------------
# SCD type 1
# --------------------------------------------------------------------------

SCD1_COLS = ["user_sk", "user_id", "event_id", "ts", "event_type", "value",
             "_created_datetime", "_updated_datetime", "_is_deleted"]


def _scd1(spark, d, target, lo, hi, now, kind="delta", deletes=True):
    e = events(spark, d)
    cond = F.lit(True)
    if lo:
        cond = cond & (F.col("ts") >= ts(lo))
    if hi:
        cond = cond & (F.col("ts") < ts(hi))
    src = e.filter(cond).select("user_id", "event_id", "ts", "event_type", "value")
    return scd1_apply(target, src, ["user_id"], ["event_type"], now, sequence=SEQ,
                      source_kind=kind, is_delete=is_del() if deletes else None, sk_col="user_sk")


def silver0(spark, d):
    return _scd1(spark, d, None, None, SPLIT, NOW1)


def _win(lo, hi):
    c = []
    if lo:
        c.append(f"ts >= {sql_ts(lo)}")
    if hi:
        c.append(f"ts < {sql_ts(hi)}")
    return " AND ".join(c) or "TRUE"


def _scd1_initial_sql(hi, now):
    return (f"SELECT user_id, event_id, ts, event_type, value, {sql_ts(now)} AS _created_datetime, "
            f"{sql_ts(now)} AS _updated_datetime, false AS _is_deleted FROM ("
            + _latest_sql(_win(None, hi)) + ") WHERE event_type <> 'error'")


def extract(spark, d):
    """A full extract: the last event of each user over all events; users whose last one deletes them are gone."""
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(e, ["user_id"], SEQ).filter(~is_del())


EXTRACT_SQL = f"SELECT * FROM ({_latest_sql()}) WHERE event_type <> 'error'"


def _scd1_merge_sql(t_sql, lo, hi, now, kind="delta", deletes=True):
    """SCD1 merge of target CTE text with the latest batch row per key (all batches are newer)."""
    source = EXTRACT_SQL if kind == "snapshot" else _latest_sql(_win(lo, hi))
    n = sql_ts(now)
    sdel = "s.event_type = 'error'" if deletes else "false"
    missing = "CASE WHEN NOT t._is_deleted THEN 'delete' ELSE 'keep' END" if kind == "snapshot" else "'keep'"
    return f"""
SELECT user_id,
  coalesce(s_event_id, t_event_id) AS event_id, coalesce(s_ts, t_ts) AS ts,
  CASE WHEN act IN ('insert','update') THEN s_event_type ELSE t_event_type END AS event_type,
  CASE WHEN act IN ('insert','update') THEN s_value ELSE t_value END AS value,
  CASE WHEN act = 'insert' THEN {n} ELSE t_created END AS _created_datetime,
  CASE WHEN act <> 'keep' THEN {n} ELSE t_updated END AS _updated_datetime,
  CASE WHEN act = 'delete' THEN true WHEN act IN ('insert','update') THEN false ELSE t_deleted END AS _is_deleted
FROM (
  SELECT coalesce(t.user_id, s.user_id) AS user_id,
    t.event_id AS t_event_id, t.ts AS t_ts, t.event_type AS t_event_type, t.value AS t_value,
    t._created_datetime AS t_created, t._updated_datetime AS t_updated, t._is_deleted AS t_deleted,
    s.event_id AS s_event_id, s.ts AS s_ts, s.event_type AS s_event_type, s.value AS s_value,
    ({sdel}) AS s_is_del,
    CASE WHEN t.user_id IS NULL AND {sdel} THEN 'drop'
         WHEN t.user_id IS NULL THEN 'insert'
         WHEN s.user_id IS NULL THEN {missing}
         WHEN {sdel} THEN CASE WHEN t._is_deleted THEN 'keep' ELSE 'delete' END
         WHEN t.event_type IS DISTINCT FROM s.event_type OR t._is_deleted THEN 'update'
         ELSE 'keep' END AS act
  FROM ({t_sql}) t FULL JOIN ({source}) s ON t.user_id = s.user_id
) WHERE act <> 'drop'"""


def _with_sk(sql):
    return (f"SELECT sha256(CAST(user_id AS VARCHAR)) AS user_sk, user_id, event_id, ts, event_type, value, "
            f"_created_datetime, _updated_datetime, _is_deleted FROM ({sql})")


S0_SQL = _scd1_initial_sql(SPLIT, NOW1)
SCD1_DELTA_SQL = _scd1_merge_sql(S0_SQL, SPLIT, None, NOW2)


@register("q_scd1_delta", _with_sk(SCD1_DELTA_SQL))
def q_scd1_delta(spark, d):
    return _scd1(spark, d, silver0(spark, d), SPLIT, None, NOW2)


@register("q_scd1_insert_audit", _with_sk(SCD1_DELTA_SQL) + f" WHERE _created_datetime = {sql_ts(NOW2)}")
def q_scd1_insert_audit(spark, d):
    return q_scd1_delta(spark, d).filter(F.col("_created_datetime") == ts(NOW2))


@register("q_scd1_snapshot", _with_sk(_scd1_merge_sql(S0_SQL, None, None, NOW2, kind="snapshot", deletes=False)))
def q_scd1_snapshot(spark, d):
    return scd1_apply(silver0(spark, d), extract(spark, d), ["user_id"], ["event_type"], NOW2, sequence=SEQ,
                      source_kind="snapshot", sk_col="user_sk")


@register("q_soft_delete_missing", _with_sk(f"""
SELECT t.user_id, t.event_id, t.ts, t.event_type, t.value, t._created_datetime,
       CASE WHEN p.user_id IS NULL AND NOT t._is_deleted THEN {sql_ts(NOW2)} ELSE t._updated_datetime END AS _updated_datetime,
       CASE WHEN p.user_id IS NULL AND NOT t._is_deleted THEN true ELSE t._is_deleted END AS _is_deleted
FROM ({S0_SQL}) t LEFT JOIN (SELECT user_id FROM ({EXTRACT_SQL})) p
ON t.user_id = p.user_id"""))
def q_soft_delete_missing(spark, d):
    return soft_delete_missing(silver0(spark, d), extract(spark, d), ["user_id"], NOW2)


@register("q_scd1_reactivate", _with_sk(_scd1_merge_sql(
    _scd1_merge_sql(S0_SQL, SPLIT, SECOND_BATCH, NOW2), SECOND_BATCH, None, NOW3)))
def q_scd1_reactivate(spark, d):
    s1 = _scd1(spark, d, silver0(spark, d), SPLIT, SECOND_BATCH, NOW2)
    return _scd1(spark, d, s1, SECOND_BATCH, None, NOW3)


# --------------------------------------------------------------------------
# SCD type 2
# --------------------------------------------------------------------------

def _scd2_sql(where="TRUE", deletes=False, payload="event_type", start="scd_start_date",
              end="scd_end_date", current="is_current", version="scd_version"):
    dl = "event_type = 'error'" if deletes else "false"
    cur = f", nx IS NULL AS {current}" if current else ""
    ver = f", row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS {version}" if version else ""
    return f"""
WITH l AS (SELECT user_id, event_id, ts, event_type, value, {dl} AS del FROM events WHERE {where}),
p AS (SELECT *, lag(del) OVER w AS pd, lag(event_type) OVER w AS pv FROM l
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
k AS (SELECT * FROM p WHERE (del AND pd = false)
        OR (NOT del AND (pd IS NULL OR pd OR pv IS DISTINCT FROM event_type))),
e AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM k)
SELECT user_id, {payload}, ts AS {start}, nx AS {end}{cur}{ver}
FROM e WHERE NOT del"""


SCD2_SQL = _scd2_sql()


def history(spark, d, lo=None, hi=None, deletes=False):
    e = events(spark, d)
    if hi:
        e = e.filter(F.col("ts") < ts(hi))
    return scd2_history(e, ["user_id"], ["event_type"], SEQ, is_delete=is_del() if deletes else None)


@register("q_scd2_history", SCD2_SQL)
def q_scd2_history(spark, d):
    return history(spark, d)


@register("q_scd2_current", f"SELECT * FROM ({SCD2_SQL}) WHERE is_current")
def q_scd2_current(spark, d):
    return current_rows(history(spark, d))


@register("q_scd2_incremental", SCD2_SQL)
def q_scd2_incremental(spark, d):
    e = events(spark, d)
    target = history(spark, d, hi=SPLIT)
    batch = e.filter(F.col("ts") >= ts(SPLIT))
    return scd2_apply(target, e, batch, ["user_id"], ["event_type"], SEQ)


@register("q_scd2_incremental_fast", SCD2_SQL)
def q_scd2_incremental_fast(spark, d):
    """Batch newer than every stored key: continued from the last versions, log not read."""
    from ..session import scratch_path
    e = events(spark, d)
    old = e.filter(F.col("ts") < ts(SPLIT))
    root = scratch_path(spark, "scd2_fast")
    # the stored silver history and key state, as a pipeline would hold them
    history(spark, d, hi=SPLIT).write.parquet(f"{root}/history")
    scd2_key_state(old, ["user_id"], SEQ).write.parquet(f"{root}/state")
    target, state = spark.read.parquet(f"{root}/history"), spark.read.parquet(f"{root}/state")
    batch = e.filter(F.col("ts") >= ts(SPLIT))
    out, _ = scd2_apply_fast(target, state, batch, e, ["user_id"], ["event_type"], SEQ)
    return out


SCD2_OLD_SQL = _scd2_sql(f"ts < {sql_ts(SPLIT)}")
_APPEND_SQL = f"""
WITH cur AS (SELECT * FROM ({SCD2_OLD_SQL}) WHERE is_current), b AS ({BATCH_SQL}),
j AS (SELECT b.user_id, b.event_type AS s_type, b.ts AS s_ts, cur.event_type AS t_type,
             cur.scd_start_date AS t_start, cur.scd_version AS t_version
      FROM b LEFT JOIN cur ON b.user_id = cur.user_id
      WHERE cur.user_id IS NULL OR cur.event_type IS DISTINCT FROM b.event_type)
"""


@register("q_scd2_expire", _APPEND_SQL + """
SELECT user_id, t_type AS event_type, t_start AS scd_start_date, s_ts AS scd_end_date,
       false AS is_current, t_version AS scd_version FROM j WHERE t_version IS NOT NULL""")
def q_scd2_expire(spark, d):
    return _appended(spark, d).filter(~F.col("is_current"))


@register("q_scd2_next_version", _APPEND_SQL + """
SELECT user_id, s_type AS event_type, s_ts AS scd_start_date, CAST(NULL AS TIMESTAMP) AS scd_end_date,
       true AS is_current, coalesce(t_version + 1, 1) AS scd_version FROM j""")
def q_scd2_next_version(spark, d):
    return _appended(spark, d).filter(F.col("is_current"))


def _appended(spark, d):
    cur = history(spark, d, hi=SPLIT)
    inc = latest_per_key(batch_rows(spark, d), ["user_id"], SEQ)
    return scd2_append_latest(cur, inc, ["user_id"], ["event_type"], start="ts")


@register("q_scd2_as_of_date", f"""
SELECT * FROM ({SCD2_SQL}) WHERE scd_start_date <= {sql_ts(AS_OF)}
AND (scd_end_date IS NULL OR {sql_ts(AS_OF)} < scd_end_date)""")
def q_scd2_as_of_date(spark, d):
    return as_of_date(history(spark, d), AS_OF)


@register("q_scd2_as_of_join", f"""
WITH h AS ({_scd2_sql(deletes=True)}),
f AS (SELECT event_id, user_id, ts + INTERVAL 30 MINUTE AS probe_ts FROM events)
SELECT f.event_id, f.user_id, f.probe_ts, h.event_type AS version_event_type, h.scd_version AS version_scd_version
FROM f LEFT JOIN h ON f.user_id = h.user_id AND h.scd_start_date <= f.probe_ts
 AND (h.scd_end_date IS NULL OR f.probe_ts < h.scd_end_date)""")
def q_scd2_as_of_join(spark, d):
    h = history(spark, d, deletes=True)
    f = events(spark, d).select("event_id", "user_id",
                                (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("probe_ts"))
    return as_of_join(f, h, ["user_id"], "probe_ts", ["event_type", "scd_version"],
                      fact_order=["event_id"], prefix="version_")


# --------------------------------------------------------------------------
# Declarative CDC
# --------------------------------------------------------------------------

AUTO1_SQL = f"SELECT * FROM ({_latest_sql()}) WHERE event_type <> 'error'"


@register("q_auto_cdc_scd1", AUTO1_SQL)
def q_auto_cdc_scd1(spark, d):
    return apply_changes(events(spark, d), ["user_id"], SEQ, apply_as_deletes=is_del(),
                         except_column_list=["props"], stored_as_scd_type=1)


AUTO2_SQL = _scd2_sql(deletes=True, payload="ts, event_type", start="__START_AT", end="__END_AT", current=None)


@register("q_auto_cdc_scd2", AUTO2_SQL)
def q_auto_cdc_scd2(spark, d):
    return apply_changes(events(spark, d), ["user_id"], SEQ, apply_as_deletes=is_del(),
                         except_column_list=["props", "value", "event_id"], stored_as_scd_type=2,
                         version_col="scd_version")


# --------------------------------------------------------------------------
# Change feed
# --------------------------------------------------------------------------

def old_state(spark, d):
    e = events(spark, d).filter(F.col("ts") < ts(SPLIT))
    return apply_changes(e, ["user_id"], SEQ, apply_as_deletes=is_del(), except_column_list=["props"])


def new_state(spark, d):
    return apply_changes(events(spark, d), ["user_id"], SEQ, apply_as_deletes=is_del(),
                         except_column_list=["props"])


OLD_STATE_SQL = f"SELECT * FROM ({_latest_sql(f'ts < {sql_ts(SPLIT)}')}) WHERE event_type <> 'error'"
FEED_COLS = ["event_id", "ts", "event_type", "value"]
DIFF_SQL = f"""
WITH o AS ({OLD_STATE_SQL}), n AS ({AUTO1_SQL}),
j AS (SELECT coalesce(o.user_id, n.user_id) AS user_id, o.user_id AS ou, n.user_id AS nu,
             o.event_id AS oe, o.ts AS ot, o.event_type AS oy, o.value AS ov,
             n.event_id AS ne, n.ts AS nt, n.event_type AS ny, n.value AS nv,
             (o.event_id IS DISTINCT FROM n.event_id OR o.ts IS DISTINCT FROM n.ts
              OR o.event_type IS DISTINCT FROM n.event_type OR o.value IS DISTINCT FROM n.value) AS chg
      FROM o FULL JOIN n ON o.user_id = n.user_id)
SELECT user_id, ne AS event_id, nt AS ts, ny AS event_type, nv AS value, 'insert' AS _change_type FROM j WHERE ou IS NULL
UNION ALL SELECT user_id, oe, ot, oy, ov, 'delete' FROM j WHERE nu IS NULL
UNION ALL SELECT user_id, oe, ot, oy, ov, 'update_preimage' FROM j WHERE ou IS NOT NULL AND nu IS NOT NULL AND chg
UNION ALL SELECT user_id, ne, nt, ny, nv, 'update_postimage' FROM j WHERE ou IS NOT NULL AND nu IS NOT NULL AND chg
"""


def _diff(spark, d):
    return diff(old_state(spark, d), new_state(spark, d), ["user_id"], FEED_COLS)


@register("q_change_feed_diff", DIFF_SQL)
def q_change_feed_diff(spark, d):
    return _diff(spark, d)


@register("q_change_feed_postimages",
          f"SELECT * FROM ({DIFF_SQL}) WHERE _change_type IN ('insert', 'update_postimage')")
def q_change_feed_postimages(spark, d):
    return postimages(_diff(spark, d))


@register("q_change_feed_replay", AUTO1_SQL)
def q_change_feed_replay(spark, d):
    return replay(old_state(spark, d), _diff(spark, d), ["user_id"])


def event_change_log(spark, d):
    """Each event as a committed change: version = day number since the epoch."""
    e = events(spark, d).select(*EV_COLS)
    s = keyed_scan(e, ["user_id"], SEQ, lag=["event_type"], lag_prefix="_p_")
    kind = (F.when(is_del(), F.lit("delete"))
             .when(F.col("_p_event_type").isNull() | (F.col("_p_event_type") == "error"), F.lit("insert"))
             .otherwise(F.lit("update_postimage")))
    version = F.datediff(F.col("ts").cast("date"), F.lit(VERSION_EPOCH).cast("date")).cast("bigint")
    return s.select(*EV_COLS, kind.alias("_change_type"), version.alias("_commit_version"))


@register("q_change_feed_since_version", f"""
SELECT event_id, ts, user_id, event_type, value,
  CASE WHEN event_type = 'error' THEN 'delete'
       WHEN prev IS NULL OR prev = 'error' THEN 'insert' ELSE 'update_postimage' END AS _change_type,
  datediff('day', DATE '{VERSION_EPOCH}', CAST(ts AS DATE)) AS _commit_version
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE datediff('day', DATE '{VERSION_EPOCH}', CAST(ts AS DATE)) >= {FROM_VERSION}""")
def q_change_feed_since_version(spark, d):
    return read_changes(event_change_log(spark, d), from_version=FROM_VERSION)


@register("q_incremental_high_water_mark", f"""
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < {sql_ts(SPLIT)})""")
def q_incremental_high_water_mark(spark, d):
    e = events(spark, d)
    processed = e.filter(F.col("ts") < ts(SPLIT)).select("ts")
    return incremental_since(e, "ts", processed).select("event_id", "ts", "user_id", "event_type")


# --------------------------------------------------------------------------
# Ties, NULL keys, string sequences, arrival out of order
# --------------------------------------------------------------------------

DAY_SQL = "(SELECT * REPLACE (date_trunc('day', ts) AS ts) FROM events)"


def by_day(spark, d):
    """Events with their instant cut to the day: many rows of a key at one instant."""
    return events(spark, d).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))


@register("q_prev_event_ties", f"""
SELECT event_id, user_id, ts, event_type, lag(event_type) OVER w AS prev_event_type,
       row_number() OVER w AS n FROM {DAY_SQL} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def q_prev_event_ties(spark, d):
    e = by_day(spark, d).select("event_id", "user_id", "ts", "event_type")
    return keyed_scan(e, ["user_id"], SEQ, lag=["event_type"], row_number="n")


NULL_KEY_SQL = "(SELECT * REPLACE (CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS user_id) FROM events)"


@register("q_scd2_history_null_key", SCD2_SQL.replace("FROM events", f"FROM {NULL_KEY_SQL}"))
def q_scd2_history_null_key(spark, d):
    e = events(spark, d).withColumn("user_id", F.when(F.col("event_type") != "click", F.col("user_id")))
    return scd2_history(e, ["user_id"], ["event_type"], SEQ)


STRING_SEQ_SQL = "(SELECT * REPLACE (strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts) FROM events)"


@register("q_scd2_history_string_seq", SCD2_SQL.replace("FROM events", f"FROM {STRING_SEQ_SQL}"))
def q_scd2_history_string_seq(spark, d):
    e = events(spark, d).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return scd2_history(e, ["user_id"], ["event_type"], SEQ)


@register("q_scd2_as_of_ties", f"""
WITH h AS ({_scd2_sql(deletes=True).replace("FROM events", f"FROM {DAY_SQL}")}),
f AS (SELECT event_id, user_id, date_trunc('day', ts) AS probe_ts FROM events)
SELECT f.event_id, f.user_id, f.probe_ts, h.event_type AS version_event_type, h.scd_version AS version_scd_version
FROM f LEFT JOIN h ON f.user_id = h.user_id AND h.scd_start_date <= f.probe_ts
 AND (h.scd_end_date IS NULL OR f.probe_ts < h.scd_end_date)""")
def q_scd2_as_of_ties(spark, d):
    e = by_day(spark, d)
    h = scd2_history(e, ["user_id"], ["event_type"], SEQ, is_delete=is_del())
    return as_of_join(e.select("event_id", "user_id", F.col("ts").alias("probe_ts")), h, ["user_id"], "probe_ts",
                      ["event_type", "scd_version"], fact_order=["event_id"], prefix="version_")


@register("q_incremental_first_run", "SELECT event_id, ts, user_id, event_type FROM events")
def q_incremental_first_run(spark, d):
    e = events(spark, d)
    processed = spark.createDataFrame([], e.select("ts").schema)  # nothing processed so far
    return incremental_since(e, "ts", processed).select("event_id", "ts", "user_id", "event_type")


@register("q_upsert_out_of_order", _latest_sql())
def q_upsert_out_of_order(spark, d):
    """The newer half is stored; the older half arrives late and changes no newer row."""
    e = events(spark, d).select(*EV_COLS)
    stored = latest_per_key(e.filter(F.col("ts") >= ts(SPLIT)), ["user_id"], SEQ)
    return upsert(stored, e.filter(F.col("ts") < ts(SPLIT)), ["user_id"], sequence=SEQ)


SCD1_STATE_SQL = f"SELECT user_id, event_id, ts, event_type, value FROM ({_latest_sql()}) WHERE event_type <> 'error'"


@register("q_scd1_out_of_order", SCD1_STATE_SQL)
def q_scd1_out_of_order(spark, d):
    """Four batches by hash of the event, each over the whole time range: the live rows are the one-batch answer's."""
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type", "value")
    state = None
    for n in range(4):
        batch = e.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == n)
        state = scd1_apply(state, batch, ["user_id"], ["event_type", "value"], NOW1, sequence=SEQ,
                           is_delete=is_del(), keep_tombstones=True)
    return state.filter(~F.col("_is_deleted")).select("user_id", "event_id", "ts", "event_type", "value")


@register("q_scd2_snapshot_source", f"""
WITH a AS (SELECT user_id, event_type FROM ({_latest_sql(f"ts < {sql_ts(SPLIT)}")}) WHERE event_type <> 'error'),
b AS (SELECT user_id, event_type FROM ({EXTRACT_SQL})),
j AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, a.event_type AS old, b.event_type AS new,
             a.user_id IS NOT NULL AS was, b.user_id IS NOT NULL AS now,
             a.event_type IS NOT DISTINCT FROM b.event_type AS same FROM a FULL JOIN b ON a.user_id = b.user_id)
SELECT user_id, old AS event_type, {sql_ts(NOW1)} AS scd_start_date,
  CASE WHEN NOT now OR NOT same THEN {sql_ts(NOW2)} END AS scd_end_date, now AND same AS is_current,
  CAST(1 AS BIGINT) AS scd_version FROM j WHERE was
UNION ALL
SELECT user_id, new, {sql_ts(NOW2)}, NULL, true, CAST(CASE WHEN was THEN 2 ELSE 1 END AS BIGINT)
FROM j WHERE now AND NOT (was AND same)""")
def q_scd2_snapshot_source(spark, d):
    """Two full extracts; users gone from the second end their version."""
    first = latest_per_key(events(spark, d).filter(F.col("ts") < ts(SPLIT)).select(*EV_COLS), ["user_id"], SEQ)
    state = scd2_apply_snapshot(None, first.filter(~is_del()), ["user_id"], ["event_type"], NOW1)
    return scd2_apply_snapshot(state, extract(spark, d), ["user_id"], ["event_type"], NOW2)


# --------------------------------------------------------------------------
# NULL keys: histories take them as one key, merges reject them, lookups miss them
# --------------------------------------------------------------------------

def null_key_events(spark, d):
    return events(spark, d).withColumn("user_id", F.when(F.col("event_type") != "click", F.col("user_id")))


def _on_null_keys(sql: str) -> str:
    return sql.replace("FROM events", f"FROM {NULL_KEY_SQL}")


@register("q_scd2_incremental_null_key", _on_null_keys(SCD2_SQL))
def q_scd2_incremental_null_key(spark, d):
    e = null_key_events(spark, d)
    target = scd2_history(e.filter(F.col("ts") < ts(SPLIT)), ["user_id"], ["event_type"], SEQ)
    return scd2_apply(target, e, e.filter(F.col("ts") >= ts(SPLIT)), ["user_id"], ["event_type"], SEQ)


@register("q_scd2_incremental_fast_null_key", _on_null_keys(_scd2_sql(deletes=True)))
def q_scd2_incremental_fast_null_key(spark, d):
    e = null_key_events(spark, d)
    old, batch = e.filter(F.col("ts") < ts(SPLIT)), e.filter(F.col("ts") >= ts(SPLIT))
    target = scd2_history(old, ["user_id"], ["event_type"], SEQ, is_delete=is_del())
    out, _ = scd2_apply_fast(target, scd2_key_state(old, ["user_id"], SEQ), batch, e, ["user_id"], ["event_type"], SEQ,
                             is_delete=is_del())
    return out


@register("q_auto_cdc_null_key", f"SELECT * FROM ({_on_null_keys(_latest_sql())}) "
                                 "WHERE event_type <> 'error' AND user_id IS NOT NULL")
def q_auto_cdc_null_key(spark, d):
    """Three batches, the last of them twice: NULL keys neither win nor pile up."""
    e = null_key_events(spark, d).select(*EV_COLS)
    state = None
    for n in (0, 1, 2, 2):
        state = apply_changes(e.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == n), ["user_id"], SEQ,
                              apply_as_deletes=is_del(), target=state, keep_tombstones=True)
    return state.filter(~F.col("__deleted")).drop("__deleted")


@register("q_merge_null_key", f"""
WITH l AS ({_on_null_keys(_latest_sql())})
SELECT user_id, event_type, ts FROM l WHERE user_id IS NOT NULL""")
def q_merge_null_key(spark, d):
    """A conditional merge and then its replay, of whose rows none is new."""
    batch = latest_per_key(null_key_events(spark, d).select("user_id", "event_id", "ts", "event_type"), ["user_id"], SEQ)
    once = merge_changed_only(batch.limit(0), batch, ["user_id"], ["event_type"]).drop("_merge_action")
    again = merge_changed_only(once, batch, ["user_id"], ["event_type"]).drop("_merge_action")
    return again.unionByName(new_keys(batch, again, ["user_id"])).select("user_id", "event_type", "ts")


@register("q_scd2_as_of_null_key", f"""
WITH h AS ({_on_null_keys(SCD2_SQL)}),
f AS (SELECT event_id, user_id, ts FROM {NULL_KEY_SQL})
SELECT f.event_id, f.user_id, f.ts, h.event_type AS version_event_type, h.scd_version AS version_scd_version
FROM f LEFT JOIN h ON f.user_id = h.user_id AND h.scd_start_date <= f.ts
 AND (h.scd_end_date IS NULL OR f.ts < h.scd_end_date)""")
def q_scd2_as_of_null_key(spark, d):
    e = null_key_events(spark, d)
    h = scd2_history(e, ["user_id"], ["event_type"], SEQ)
    return as_of_join(e.select("event_id", "user_id", "ts"), h, ["user_id"], "ts", ["event_type", "scd_version"],
                      fact_order=["event_id"], prefix="version_")


# --------------------------------------------------------------------------
# Two histories of one key
# --------------------------------------------------------------------------

SEGMENT = "CASE WHEN value < 30 THEN 'low' WHEN value < 70 THEN 'mid' ELSE 'high' END"
SEGMENT_SQL = SCD2_SQL.replace("event_type, value, false", f"{SEGMENT} AS event_type, value, false")


def _two_histories(spark, d):
    """Status, which deletes end, and segment over the same users' time."""
    e = events(spark, d).withColumn("segment", F.expr(SEGMENT))
    return history(spark, d, deletes=True), scd2_history(e, ["user_id"], ["segment"], SEQ)


@register("q_scd2_join_histories", f"""
WITH a AS ({_scd2_sql(deletes=True)}), b AS ({SEGMENT_SQL})
SELECT a.user_id, a.event_type, b.event_type AS segment, greatest(a.scd_start_date, b.scd_start_date) AS scd_start_date,
  least(a.scd_end_date, b.scd_end_date) AS scd_end_date
FROM a JOIN b ON a.user_id = b.user_id AND a.scd_start_date < coalesce(b.scd_end_date, TIMESTAMP '9999-01-01')
 AND b.scd_start_date < coalesce(a.scd_end_date, TIMESTAMP '9999-01-01')
WHERE a.scd_start_date IS DISTINCT FROM a.scd_end_date AND b.scd_start_date IS DISTINCT FROM b.scd_end_date""")
def q_scd2_join_histories(spark, d):
    a, b = _two_histories(spark, d)
    return join_histories(a, b, ["user_id"], ["event_type"], ["segment"])


@register("q_entity_360_as_of", f"""
WITH a AS ({_scd2_sql(deletes=True)}), b AS ({SEGMENT_SQL}),
va AS (SELECT * FROM a WHERE scd_start_date <= {sql_ts(AS_OF)} AND (scd_end_date IS NULL OR {sql_ts(AS_OF)} < scd_end_date)),
vb AS (SELECT * FROM b WHERE scd_start_date <= {sql_ts(AS_OF)} AND (scd_end_date IS NULL OR {sql_ts(AS_OF)} < scd_end_date))
SELECT coalesce(va.user_id, vb.user_id) AS user_id, va.event_type, vb.event_type AS segment
FROM va FULL JOIN vb ON va.user_id = vb.user_id""")
def q_entity_360_as_of(spark, d):
    """Every user's status and segment at an instant, whichever of them there is."""
    a, b = _two_histories(spark, d)
    joined = join_histories(a, b, ["user_id"], ["event_type"], ["segment"], how="full")
    return as_of_date(joined, AS_OF).select("user_id", "event_type", "segment")
