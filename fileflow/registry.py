"""Driver-facing queries: each entry reads the given tables (or data Spark derives from them)
and exercises one or more operators; each has an equivalent DuckDB SQL twin where one exists.

"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.operators import catalog, contracts, quality, records, runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


TABLES = ["benchmark", "conversations", "customer", "documents", "embeddings", "events",
          "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier"]

# --- run tables derived from the given data -------------------------------------------------
# orders -> runs: F=SUCCESS, P=FAILED, O=RUNNING (no end time); duration = o_custkey minutes.


def runs_from_orders(orders: DataFrame) -> DataFrame:
    st = F.col("o_orderstatus")
    return orders.select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.col("o_orderpriority").alias("dag_id"),
        F.col("o_orderdate").alias("start_time"),
        F.when(st == "O", F.lit(None))
         .otherwise(F.col("o_orderdate") + F.make_dt_interval(mins=F.col("o_custkey").cast("int")))
         .alias("end_time"),
        F.when(st == "F", "SUCCESS").when(st == "P", "FAILED").otherwise("RUNNING").alias("status"),
        F.length("o_orderpriority").cast("long").alias("files_processed"),
        F.col("o_custkey").alias("rows_inserted"),
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("rows_updated"),
        F.when((st == "P") & (F.col("o_orderpriority") != "1-URGENT"),
               F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" failed")))
         .alias("error_message"))


RUNS_FROM_ORDERS_SQL = """
  SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id,
         o_orderpriority AS dag_id,
         o_orderdate AS start_time,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE o_orderdate + to_minutes(CAST(o_custkey AS BIGINT)) END AS end_time,
         CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'P' THEN 'FAILED'
              ELSE 'RUNNING' END AS status,
         CAST(length(o_orderpriority) AS BIGINT) AS files_processed,
         o_custkey AS rows_inserted,
         CAST(floor(o_totalprice / 1000) AS BIGINT) AS rows_updated,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'
              THEN 'order ' || CAST(o_orderkey AS VARCHAR) || ' failed' END AS error_message
  FROM orders"""

# events -> runs: error=FAILED, view=RUNNING (no end time), others SUCCESS;
# end = ts + value seconds (exact, via decimal micro-seconds).


def runs_from_events(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    secs = F.col("value").cast("decimal(18,2)").cast("decimal(18,6)")
    return events.select(
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("run_id"),
        et.alias("dag_id"),
        F.col("ts").alias("start_time"),
        F.when(et == "view", F.lit(None))
         .otherwise(F.col("ts") + F.make_dt_interval(secs=secs)).alias("end_time"),
        F.when(et == "error", "FAILED").when(et == "view", "RUNNING").otherwise("SUCCESS")
         .alias("status"),
        F.lit(1).cast("long").alias("files_processed"),
        F.col("user_id").alias("rows_inserted"),
        F.lit(0).cast("long").alias("rows_updated"),
        F.when(F.col("user_id") >= 50, F.col("props")).alias("error_message"))


RUNS_FROM_EVENTS_SQL = """
  SELECT 'ev-' || CAST(event_id AS VARCHAR) AS run_id,
         event_type AS dag_id,
         ts AS start_time,
         CASE WHEN event_type = 'view' THEN NULL
              ELSE ts + to_microseconds(CAST(CAST(value AS DECIMAL(18,2)) * 1000000 AS BIGINT))
         END AS end_time,
         CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type = 'view' THEN 'RUNNING'
              ELSE 'SUCCESS' END AS status,
         CAST(1 AS BIGINT) AS files_processed,
         user_id AS rows_inserted,
         CAST(0 AS BIGINT) AS rows_updated,
         CASE WHEN user_id >= 50 THEN props END AS error_message
  FROM events"""


# --- A5 + P8: the flagship ------------------------------------------------------------------

@register("daily_trend", """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
       CAST(count(*) AS DOUBLE) + CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events
WHERE ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-21'
GROUP BY 1""")
def q_daily_trend(spark, sf):
    ev = records.date_range(load(spark, sf, "events"), "ts", "2024-01-03", "2024-01-20")
    ev = ev.select("ts", F.lit(1).cast("long").alias("n_events"),
                   F.col("value").cast("decimal(18,2)").alias("value"))
    out = runs.daily_trend(ev, "ts", ("n_events", "value"), total_name=None)
    return out.select("date", "n_events", F.col("value").cast("double").alias("value"),
                      (F.col("n_events").cast("double") + F.col("value").cast("double"))
                      .alias("total"))


# --- catalog --------------------------------------------------------------------------------

@register("dataset_stats", """
SELECT 'events' AS dataset, count(*) AS row_count, min(ts) AS min_loaded_at,
       max(ts) AS max_loaded_at FROM events""")
def q_dataset_stats(spark, sf):
    s = catalog.stats(load(spark, sf, "events"), "events", time_col="ts", with_null_rates=False)
    return s.select("dataset", "row_count", "min_loaded_at", "max_loaded_at")


@register("null_rates", """
WITH o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
                  o_totalprice, o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority
           FROM orders)
SELECT 'o_orderkey' AS "column", avg(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_rate FROM o
UNION ALL SELECT 'o_custkey', avg(CASE WHEN o_custkey IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE FROM o
UNION ALL SELECT 'o_orderstatus', avg(CASE WHEN o_orderstatus IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE FROM o
UNION ALL SELECT 'o_totalprice', avg(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE FROM o
UNION ALL SELECT 'o_orderdate', avg(CASE WHEN o_orderdate IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE FROM o
UNION ALL SELECT 'o_orderpriority', avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE FROM o""")
def q_null_rates(spark, sf):
    o = load(spark, sf, "orders")
    o = o.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))) \
         .withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return catalog.null_rates(o)


_LIST_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS row_count, CAST(NULL AS TIMESTAMP) AS last_loaded "
    f"FROM {t}" for t in TABLES)


@register("list_datasets", _LIST_SQL)
def q_list_datasets(spark, sf):
    ds = catalog.list_datasets(spark, {t: load(spark, sf, t) for t in TABLES})
    return ds.withColumn("last_loaded", F.col("last_loaded").cast("timestamp_ntz"))


@register("kpi_totals", f"""
WITH d AS ({_LIST_SQL}),
r AS ({RUNS_FROM_ORDERS_SQL}),
l AS (SELECT * FROM r ORDER BY start_time DESC NULLS FIRST, run_id LIMIT 1)
SELECT (SELECT sum(row_count) FROM d)::BIGINT AS total_rows,
       (SELECT count(*) FROM d) AS total_datasets,
       (SELECT status FROM l) AS last_run_status,
       (SELECT coalesce(rows_inserted, 0) + coalesce(rows_updated, 0) FROM l)::BIGINT
         AS last_run_rows""")
def q_kpi_totals(spark, sf):
    ds = catalog.list_datasets(spark, {t: load(spark, sf, t) for t in TABLES})
    return runs.kpi_totals(ds, runs_from_orders(load(spark, sf, "orders")))


@register("describe_dataset", """
SELECT 'orders' AS dataset, c.ordinal, c.column_name, (SELECT count(*) FROM orders) AS row_count
FROM (VALUES (0, 'o_orderkey'), (1, 'o_custkey'), (2, 'o_orderstatus'), (3, 'o_totalprice'),
             (4, 'o_orderdate'), (5, 'o_orderpriority')) c(ordinal, column_name)""")
def q_describe_dataset(spark, sf):
    return catalog.describe(load(spark, sf, "orders"), "orders")


# --- records --------------------------------------------------------------------------------

@register("records_page", """
SELECT * FROM (
  SELECT *, row_number() OVER (ORDER BY event_id) AS rn FROM events
  WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-13')
WHERE rn > 100 AND rn <= 150""")
def q_records_page(spark, sf):
    ev = records.date_range(load(spark, sf, "events"), "ts", "2024-01-05", "2024-01-12")
    return records.page(ev, ["event_id"], limit=50, offset=100, with_rn=True)


@register("records_total", """
SELECT count(*) AS total FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-13'""")
def q_records_total(spark, sf):
    ev = records.date_range(load(spark, sf, "events"), "ts", "2024-01-05", "2024-01-12")
    return records.total(ev)


# --- run history ----------------------------------------------------------------------------

@register("latest_runs", f"""
SELECT * FROM ({RUNS_FROM_ORDERS_SQL}) ORDER BY start_time DESC NULLS FIRST, run_id LIMIT 20""")
def q_latest_runs(spark, sf):
    return runs.latest(runs_from_orders(load(spark, sf, "orders")), 20)


@register("run_lookup", f"""
SELECT * FROM ({RUNS_FROM_ORDERS_SQL}) WHERE run_id = 'run-4242'""")
def q_run_lookup(spark, sf):
    return records.lookup(runs_from_orders(load(spark, sf, "orders")), "run_id", "run-4242")


@register("last_run", f"""
SELECT run_id, status, files_processed, rows_inserted, rows_updated
FROM ({RUNS_FROM_ORDERS_SQL})
WHERE dag_id = '1-URGENT' AND start_time >= TIMESTAMP '1995-06-17'
  AND start_time < TIMESTAMP '1995-06-18'
ORDER BY start_time DESC NULLS FIRST, run_id LIMIT 1""")
def q_last_run(spark, sf):
    return runs.last_run_of_day(runs_from_orders(load(spark, sf, "orders")), "1-URGENT",
                                "1995-06-17")


@register("status_counts", f"""
SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS success,
       count(*) FILTER (WHERE status = 'FAILED') AS failed,
       count(*) FILTER (WHERE status = 'RUNNING') AS running
FROM ({RUNS_FROM_ORDERS_SQL})""")
def q_status_counts(spark, sf):
    return runs.status_counts(runs_from_orders(load(spark, sf, "orders")))


@register("success_rate", f"""
SELECT avg(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END)::DOUBLE * 100.0 AS success_rate,
       count(*) AS total_runs
FROM (SELECT * FROM ({RUNS_FROM_ORDERS_SQL}) ORDER BY start_time DESC NULLS FIRST, run_id
      LIMIT 50)""")
def q_success_rate(spark, sf):
    return runs.success_rate(runs.latest(runs_from_orders(load(spark, sf, "orders")), 50))


@register("avg_duration", f"""
SELECT sum(epoch_us(end_time) - epoch_us(start_time)) / count(end_time) / 60000000.0
       AS avg_duration_minutes
FROM ({RUNS_FROM_EVENTS_SQL})""")
def q_avg_duration(spark, sf):
    return runs.avg_duration(runs_from_events(load(spark, sf, "events")))


@register("duration_histogram", """
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE value IS NOT NULL),
h AS (SELECT least(CAST(floor(20.0 * (value - lo) / (hi - lo)) AS INTEGER) + 1, 20) AS bin, lo, hi
      FROM events, b WHERE value IS NOT NULL)
SELECT bin, lo + (bin - 1) * ((hi - lo) / 20) AS bin_start, lo + bin * ((hi - lo) / 20) AS bin_end,
       count(*) AS n
FROM h GROUP BY bin, lo, hi""")
def q_duration_histogram(spark, sf):
    ev = load(spark, sf, "events")
    return runs.duration_histogram(ev, bins=20, value="value")


@register("failed_runs", f"""
SELECT run_id, start_time, coalesce(nullif(error_message, ''), 'No error message recorded')
       AS error_message
FROM ({RUNS_FROM_EVENTS_SQL}) WHERE status = 'FAILED'""")
def q_failed_runs(spark, sf):
    return runs.failed_runs(runs_from_events(load(spark, sf, "events")))


@register("runs_today", f"""
SELECT count(*) AS runs_today FROM ({RUNS_FROM_EVENTS_SQL})
WHERE start_time >= TIMESTAMP '2024-01-09' AND start_time < TIMESTAMP '2024-01-10'""")
def q_runs_today(spark, sf):
    return runs.runs_started_on(runs_from_events(load(spark, sf, "events")), "2024-01-09")


@register("run_rollup", """
SELECT l_returnflag, count(*) AS files_processed,
       CAST(sum(coalesce(CAST(l_quantity AS BIGINT), 0)) AS BIGINT) AS rows_inserted,
       CAST(sum(coalesce(CAST(l_linenumber AS BIGINT), 0)) AS BIGINT) AS rows_updated
FROM lineitem GROUP BY l_returnflag""")
def q_run_rollup(spark, sf):
    li = load(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_quantity").cast("long").alias("rows_inserted"),
        F.col("l_linenumber").cast("long").alias("rows_updated"))
    return runs.rollup(li, ["l_returnflag"])


# --- W1 upsert: orders placed before 1997 are the target; every lineitem row is an update of
# its order (status, price, ship date); the highest line number wins per order. -------------

def _upsert_inputs(spark, sf, null_returns: bool = False):
    o = load(spark, sf, "orders")
    t = o.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    li = load(spark, sf, "lineitem")
    key = F.col("l_orderkey")
    if null_returns:
        key = F.when(F.col("l_returnflag") == "R", F.lit(None).cast("long")).otherwise(key)
    s = li.select(key.alias("o_orderkey"), F.col("l_linenumber").alias("o_line"),
                  F.col("l_extendedprice").alias("o_totalprice"),
                  F.col("l_linestatus").alias("o_orderstatus"),
                  F.col("l_shipdate").alias("o_shipdate"))
    return t, s


def _upsert_sql(null_returns: bool = False) -> str:
    key = ("CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END" if null_returns
           else "l_orderkey")
    return f"""
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
s0 AS (SELECT {key} AS o_orderkey, l_linenumber AS o_line, l_extendedprice AS o_totalprice,
              l_linestatus AS o_orderstatus, l_shipdate AS o_shipdate FROM lineitem),
s AS (SELECT o_orderkey, o_line, o_totalprice, o_orderstatus, o_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_line DESC,
               o_totalprice DESC, o_orderstatus DESC, o_shipdate DESC) AS rn
        FROM s0 WHERE o_orderkey IS NOT NULL) WHERE rn = 1),
g AS (SELECT o_orderkey, count(*) AS n FROM s0 WHERE o_orderkey IS NOT NULL GROUP BY 1)"""


_UPSERT_BODY = """
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END
         AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END
         AS o_totalprice,
       t.o_orderdate, t.o_orderpriority, s.o_line, s.o_shipdate
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""


@register("upsert_orders", _upsert_sql() + _UPSERT_BODY)
def q_upsert_orders(spark, sf):
    from fileflow.operators.upsert import merge
    t, s = _upsert_inputs(spark, sf)
    return merge(t, s, ["o_orderkey"], order_by=["o_line"]).result


@register("upsert_orders_shuffle", _upsert_sql() + _UPSERT_BODY)
def q_upsert_orders_shuffle(spark, sf):
    from fileflow.operators.upsert import merge
    t, s = _upsert_inputs(spark, sf)
    return merge(t, s, ["o_orderkey"], order_by=["o_line"], strategy="shuffle").result


@register("upsert_counts", _upsert_sql() + """
SELECT CAST(sum(CASE WHEN t.o_orderkey IS NULL THEN 1 ELSE 0 END)
            + (SELECT count(*) FROM s0 WHERE o_orderkey IS NULL) AS BIGINT) AS inserted,
       CAST(sum(CASE WHEN t.o_orderkey IS NULL THEN g.n - 1 ELSE g.n END) AS BIGINT) AS updated
FROM g LEFT JOIN t ON g.o_orderkey = t.o_orderkey""")
def q_upsert_counts(spark, sf):
    from fileflow.operators.upsert import merge
    t, s = _upsert_inputs(spark, sf)
    return merge(t, s, ["o_orderkey"], order_by=["o_line"]).counts


@register("upsert_null_keys", _upsert_sql(True) + _UPSERT_BODY + """
UNION ALL
SELECT NULL, NULL, o_orderstatus, o_totalprice, NULL, NULL, o_line, o_shipdate
FROM s0 WHERE o_orderkey IS NULL""")
def q_upsert_null_keys(spark, sf):
    from fileflow.operators.upsert import merge
    t, s = _upsert_inputs(spark, sf, null_returns=True)
    return merge(t, s, ["o_orderkey"], order_by=["o_line"], strategy="shuffle").result


# --- W3: run records. Target = runs from orders; updates = RUNNING orders finishing, plus one
# new run per event. "now" is fixed so the result is reproducible. --------------------------

_NOW = "2024-02-01 12:00:00"


@register("run_record_merge", f"""
WITH t AS ({RUNS_FROM_ORDERS_SQL}),
u AS (SELECT run_id, dag_id, 'SUCCESS' AS status, files_processed, rows_inserted + 1
             AS rows_inserted, rows_updated, '' AS error_message
      FROM t WHERE status = 'RUNNING'
      UNION ALL
      SELECT 'ev-' || CAST(event_id AS VARCHAR), event_type, 'RUNNING', CAST(1 AS BIGINT),
             user_id, CAST(0 AS BIGINT), props FROM events)
SELECT coalesce(t.run_id, u.run_id) AS run_id,
       CASE WHEN t.run_id IS NULL THEN u.dag_id ELSE t.dag_id END AS dag_id,
       CASE WHEN t.run_id IS NULL THEN TIMESTAMP '{_NOW}' ELSE t.start_time END AS start_time,
       CASE WHEN t.run_id IS NULL THEN NULL WHEN u.run_id IS NOT NULL THEN TIMESTAMP '{_NOW}'
            ELSE t.end_time END AS end_time,
       CASE WHEN u.run_id IS NOT NULL THEN u.status ELSE t.status END AS status,
       CASE WHEN u.run_id IS NOT NULL THEN u.files_processed ELSE t.files_processed END
         AS files_processed,
       CASE WHEN u.run_id IS NOT NULL THEN u.rows_inserted ELSE t.rows_inserted END
         AS rows_inserted,
       CASE WHEN u.run_id IS NOT NULL THEN u.rows_updated ELSE t.rows_updated END
         AS rows_updated,
       CASE WHEN u.run_id IS NOT NULL THEN substr(nullif(u.error_message, ''), 1, 4000)
            ELSE t.error_message END AS error_message
FROM t FULL OUTER JOIN u ON t.run_id = u.run_id""")
def q_run_record_merge(spark, sf):
    from fileflow.operators.upsert import merge_runs
    t = runs_from_orders(load(spark, sf, "orders"))
    fin = t.filter(F.col("status") == "RUNNING").select(
        "run_id", "dag_id", F.lit("SUCCESS").alias("status"), "files_processed",
        (F.col("rows_inserted") + 1).alias("rows_inserted"), "rows_updated",
        F.lit("").alias("error_message"))
    ev = load(spark, sf, "events").select(
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("event_type").alias("dag_id"), F.lit("RUNNING").alias("status"),
        F.lit(1).cast("long").alias("files_processed"), F.col("user_id").alias("rows_inserted"),
        F.lit(0).cast("long").alias("rows_updated"), F.col("props").alias("error_message"))
    now = F.lit(_NOW).cast("timestamp_ntz")
    return merge_runs(t, fin.unionByName(ev), now)


# --- W2 + S20 + S18: identity column over two appends (customers, then suppliers) ----------

@register("identity_append", """
SELECT row_number() OVER (ORDER BY c_custkey) AS data_id, 'customer' AS kind,
       c_custkey AS entity_key, c_name AS name, c_nationkey AS nationkey FROM customer
UNION ALL
SELECT (SELECT count(*) FROM customer) + row_number() OVER (ORDER BY s_suppkey), 'supplier',
       s_suppkey, s_name, s_nationkey FROM supplier""")
def q_identity_append(spark, sf):
    from fileflow.operators.identity import assign_identity
    from fileflow.operators.table import SnapshotTable
    from fileflow.session import scratch_path
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("data_id long, kind string, entity_key long, name string, "
                                "nationkey int")
    tbl = SnapshotTable(spark, scratch_path(spark, "identity_append"))
    tbl.create_if_absent(schema)
    c = load(spark, sf, "customer").select(F.lit("customer").alias("kind"),
                                           F.col("c_custkey").alias("entity_key"),
                                           F.col("c_name").alias("name"),
                                           F.col("c_nationkey").alias("nationkey"))
    tbl.append(assign_identity(tbl.read(), c, "data_id", order_by=["entity_key"]))
    s = load(spark, sf, "supplier").select(F.lit("supplier").alias("kind"),
                                           F.col("s_suppkey").alias("entity_key"),
                                           F.col("s_name").alias("name"),
                                           F.col("s_nationkey").alias("nationkey"))
    tbl.append(assign_identity(tbl.read(), s, "data_id", order_by=["entity_key"]))
    return tbl.read()


# --- cleaning -------------------------------------------------------------------------------

@register("normalize_names", """
SELECT c_custkey AS customer_id, c_name AS full_name, c_nationkey AS "région_key",
       c_acctbal AS col_3, c_mktsegment AS full_name_2
FROM customer""")
def q_normalize_names(spark, sf):
    from fileflow.operators.clean import normalize_columns
    c = load(spark, sf, "customer").toDF(" Customer ID ", "Full-Name", "Région/Key", "%",
                                         "full name")
    return normalize_columns(c)


_PAD_L = " \t "
_PAD_R = "　 \n"


_STRIP_SQL = ("regexp_replace({}, '^[\\s\\p{{Z}}\\x0b\\x{{85}}\\x1c-\\x1f]+|"
              "[\\s\\p{{Z}}\\x0b\\x{{85}}\\x1c-\\x1f]+$', '', 'g')")


@register("clean_strings", f"""
SELECT {_STRIP_SQL.format('t')} AS text, {_STRIP_SQL.format('s')} AS source
FROM (SELECT ' ' || chr(9) || chr(160) || text || chr(12288) || ' ' || chr(10) AS t,
             '  ' || source AS s FROM documents)
WHERE t IS NOT NULL OR s IS NOT NULL""")
def q_clean_strings(spark, sf):
    from fileflow.operators.clean import drop_empty_rows, strip_strings
    d = load(spark, sf, "documents")
    df = d.select(F.concat(F.lit(_PAD_L), "text", F.lit(_PAD_R)).alias("text"),
                  F.concat(F.lit("  "), "source").alias("source"))
    # one empty row for each document; all of them are dropped again
    empty = d.select(F.lit(None).cast("string").alias("text"),
                     F.lit(None).cast("string").alias("source"))
    return strip_strings(drop_empty_rows(df.unionByName(empty)))


_DATE_TEXT_SQL = """
CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN '2-HIGH' THEN strftime(o_orderdate, '%m/%d/%Y')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  WHEN '4-NOT SPECIFIED' THEN 'not a date ' || CAST(o_orderkey AS VARCHAR)
  ELSE NULL END"""


@register("coerce_dates", f"""
SELECT o_orderkey, d_text,
       coalesce(try_strptime(d_text, '%Y-%m-%d %H:%M:%S'), try_strptime(d_text, '%Y-%m-%d'),
                try_strptime(d_text, '%m/%d/%Y')) AS d_parsed
FROM (SELECT o_orderkey, {_DATE_TEXT_SQL} AS d_text FROM orders)""")
def q_coerce_dates(spark, sf):
    from fileflow.operators.clean import coerce_dates
    o = load(spark, sf, "orders")
    p = F.col("o_orderpriority")
    txt = (F.when(p == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(p == "2-HIGH", F.date_format("o_orderdate", "MM/dd/yyyy"))
           .when(p == "3-MEDIUM", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
           .when(p == "4-NOT SPECIFIED",
                 F.concat(F.lit("not a date "), F.col("o_orderkey").cast("string"))))
    df = o.select("o_orderkey", txt.alias("d_text"), txt.alias("d_parsed"))
    out = coerce_dates(df, ["d_parsed", "no_such_column"])
    return out.withColumn("d_parsed", F.col("d_parsed").cast("timestamp_ntz"))


@register("row_ids", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id,
       'orders.parquet' AS source_file, TIMESTAMP '2024-03-01 00:00:00' AS loaded_at
FROM orders""")
def q_row_ids(spark, sf):
    from fileflow.functions.paths import file_name
    from fileflow.operators.clean import add_audit, with_row_ids
    from fileflow.sources.files import with_file_info
    o = with_file_info(load(spark, sf, "orders")).select("o_orderkey", "_file", "_block")
    o = with_row_ids(o)
    o = add_audit(o, file_name("_file"), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    return o.select("o_orderkey", "row_id", "source_file", "loaded_at")


@register("pack_json", """
SELECT c_custkey AS source_key, c_name, c_nationkey, c_acctbal,
       nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
       c_mktsegment = 'BUILDING' AS null_field_kept
FROM customer""")
def q_pack_json(spark, sf):
    from fileflow.operators.clean import pack_json
    c = load(spark, sf, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    packed = pack_json(c, ["c_custkey"])
    schema = "c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    back = packed.select(F.col("c_custkey").alias("source_key"),
                         F.from_json("data_json", schema).alias("j"),
                         F.col("data_json").contains('"c_mktsegment":null').alias("null_field_kept"))
    return back.select("source_key", "j.*", "null_field_kept")


# --- checksums, landing, manifests ----------------------------------------------------------

@register("checksums", """
SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents""")
def q_checksums(spark, sf):
    from fileflow.functions.hashing import md5_hex, sha256_hex
    d = load(spark, sf, "documents")
    return d.select("doc_id", md5_hex("text").alias("md5"), sha256_hex("text").alias("sha256"))


# documents as files: key = lang/source/doc-<id>.csv; the known manifest holds the en and fr
# documents; the incoming run revises every src1 document.
_DOC_KEY_SQL = "lang || '/' || source || '/doc-' || CAST(doc_id AS VARCHAR) || '.csv'"
_INCOMING_SQL = f"""
WITH known AS (SELECT {_DOC_KEY_SQL} AS storage_path, md5(text) AS checksum_md5
               FROM documents WHERE lang IN ('en', 'fr')),
inc AS (SELECT doc_id, {_DOC_KEY_SQL} AS storage_path,
               md5(CASE WHEN source = 'src1' THEN text || ' (rev 2)' ELSE text END) AS checksum_md5
        FROM documents)"""


def _doc_files(spark, sf):
    d = load(spark, sf, "documents")
    key = F.concat_ws("/", "lang", "source",
                      F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv")))
    known = d.filter(F.col("lang").isin("en", "fr")).select(
        key.alias("storage_path"), F.md5("text").alias("checksum_md5"))
    body = F.when(F.col("source") == "src1", F.concat("text", F.lit(" (rev 2)"))) \
        .otherwise(F.col("text"))
    inc = d.select("doc_id", key.alias("storage_path"), F.md5(body).alias("checksum_md5"))
    return known, inc


@register("checksum_new_files", _INCOMING_SQL + """
SELECT * FROM inc WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.storage_path = inc.storage_path
                                    AND k.checksum_md5 = inc.checksum_md5)""")
def q_checksum_new_files(spark, sf):
    from fileflow.sources.landing import split_by_checksum
    known, inc = _doc_files(spark, sf)
    return split_by_checksum(inc, known)[0]


@register("checksum_skipped", _INCOMING_SQL + """
SELECT * FROM inc WHERE EXISTS (SELECT 1 FROM known k WHERE k.storage_path = inc.storage_path
                                AND k.checksum_md5 = inc.checksum_md5)""")
def q_checksum_skipped(spark, sf):
    from fileflow.sources.landing import split_by_checksum
    known, inc = _doc_files(spark, sf)
    return split_by_checksum(inc, known)[1]


@register("manifest", f"""
SELECT lang AS run_date, '2024-01-01T00:00:00' AS created_at,
       'doc-' || CAST(doc_id AS VARCHAR) || '.csv' AS file_name, {_DOC_KEY_SQL} AS minio_key,
       n_chars AS size_bytes, count(*) OVER (PARTITION BY lang) AS file_count
FROM documents""")
def q_manifest(spark, sf):
    from fileflow.session import scratch_path
    from fileflow.sources.landing import read_manifest, write_manifest
    d = load(spark, sf, "documents")
    files = d.select("lang",
                     F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv"))
                     .alias("file_name"),
                     F.concat_ws("/", "lang", "source", F.concat(
                         F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv")))
                     .alias("minio_key"),
                     F.col("n_chars").alias("size_bytes"))
    path = scratch_path(spark, "manifest")
    write_manifest(files, path, "lang", F.lit("2024-01-01T00:00:00"))
    return read_manifest(spark, path).select("run_date", "created_at", "file_name", "minio_key",
                                             "size_bytes", "file_count")


@register("manifest_lookup", f"""
SELECT lang AS run_id, 'doc-' || CAST(doc_id AS VARCHAR) || '.csv' AS file_name,
       CAST(doc_id AS VARCHAR) AS file_id, md5(text) AS checksum_md5,
       {_DOC_KEY_SQL} AS storage_path, n_chars AS row_count, 'LOADED' AS status
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def q_manifest_lookup(spark, sf):
    from fileflow.sources.landing import manifest_rows, metadata
    d = load(spark, sf, "documents")
    landed = d.select(
        "lang", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv"))
        .alias("file_name"), F.col("doc_id").cast("string").alias("file_id"),
        F.md5("text").alias("checksum_md5"),
        F.concat_ws("/", "lang", "source", F.concat(
            F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv"))).alias("storage_path"),
        F.col("n_chars").alias("row_count"))
    man = manifest_rows(landed, F.col("lang"), "LOADED")
    keys = load(spark, sf, "labels").join(d.select("doc_id", "lang", "source"), "doc_id") \
        .select(F.concat_ws("/", "lang", "source", F.concat(
            F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv"))).alias("storage_path"))
    return metadata(man, keys).drop("manifest_id", "processed_at")


@register("file_scan", """
SELECT page_id, split(url, '/')[-1] AS name,
       lower(regexp_extract(split(url, '/')[-1], '(\\.[^./]*)$', 1)) AS ext,
       regexp_replace(url, '/[^/]*$', '') AS parent_path,
       CAST(octet_length(encode(html)) AS BIGINT) AS size_bytes,
       octet_length(encode(html)) <= 4096 AS accepted
FROM pages WHERE starts_with(url, 'https://')""")
def q_file_scan(spark, sf):
    from fileflow.functions.paths import extension, file_name, parent_path
    from fileflow.sources.discover import size_guard
    p = load(spark, sf, "pages").filter(F.startswith("url", F.lit("https://")))
    files = p.select("page_id", file_name("url").alias("name"), extension("url").alias("ext"),
                     parent_path("url").alias("parent_path"),
                     F.octet_length("html").cast("long").alias("size_bytes"))
    ok, rejected = size_guard(files, max_bytes=4096)
    return ok.withColumn("accepted", F.lit(True)).unionByName(
        rejected.drop("reason").withColumn("accepted", F.lit(False)))


# --- contracts and quality ------------------------------------------------------------------

def _orders_for_rules(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey",
                    F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
                    "o_totalprice", "o_orderdate", "o_orderpriority",
                    F.concat_ws("-", "o_orderpriority", "o_orderstatus").alias("o_note"))


_PRIO_OK = "('1-URGENT', '2-HIGH', '3-MEDIUM')"


@register("validate_report", f"""
WITH o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
                  o_totalprice, o_orderdate, o_orderpriority,
                  o_orderpriority || '-' || o_orderstatus AS o_note FROM orders),
c AS (SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS k_null,
             count(*) FILTER (WHERE o_orderstatus IS NULL) AS s_null,
             count(*) FILTER (WHERE length(o_note) > 8) AS note_long,
             count(*) FILTER (WHERE o_orderpriority IS NOT NULL
                              AND o_orderpriority NOT IN {_PRIO_OK}) AS prio_bad FROM o),
s AS (SELECT '[' || string_agg('''' || v || '''', ', ' ORDER BY v) || ']' AS samples
      FROM (SELECT DISTINCT o_orderpriority AS v FROM o
            WHERE o_orderpriority NOT IN {_PRIO_OK} ORDER BY v LIMIT 5))
SELECT 'o_clerk' AS "column", 'missing' AS rule, CAST(1 AS BIGINT) AS n_bad,
       'Missing required column: ''o_clerk''' AS message
UNION ALL SELECT 'o_orderkey', 'not_null', k_null,
       'Column ''o_orderkey'' has ' || k_null || ' null values (not allowed)' FROM c WHERE k_null > 0
UNION ALL SELECT 'o_orderstatus', 'not_null', s_null,
       'Column ''o_orderstatus'' has ' || s_null || ' null values (not allowed)' FROM c WHERE s_null > 0
UNION ALL SELECT 'o_totalprice', 'int_type', 1, 'Column ''o_totalprice'' expected integer, got double'
UNION ALL SELECT 'o_custkey', 'float_type', 1, 'Column ''o_custkey'' expected float, got bigint'
UNION ALL SELECT 'o_note', 'max_length', note_long,
       'Column ''o_note'' has ' || note_long || ' values exceeding max length 8' FROM c WHERE note_long > 0
UNION ALL SELECT 'o_orderpriority', 'allowed_values', prio_bad,
       'Column ''o_orderpriority'' has invalid values: ' || samples
       || '. Allowed: [''1-URGENT'', ''2-HIGH'', ''3-MEDIUM'']' FROM c, s WHERE prio_bad > 0""")
def q_validate_report(spark, sf):
    from fileflow.operators.contracts import report
    from fileflow.schemas import ColumnSpec
    specs = [
        ColumnSpec("o_orderkey", "int64", nullable=False),
        ColumnSpec("o_clerk", "object", nullable=False),
        ColumnSpec("o_comment", "object"),
        ColumnSpec("o_orderstatus", "object", nullable=False),
        ColumnSpec("o_totalprice", "int64"),
        ColumnSpec("o_custkey", "float64"),
        ColumnSpec("o_note", "object", max_length=8),
        ColumnSpec("o_orderpriority", "object", allowed_values=["1-URGENT", "2-HIGH", "3-MEDIUM"]),
    ]
    return report(_orders_for_rules(spark, sf), specs).select("column", "rule", "n_bad", "message")


@register("constraint_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_constraint_unique(spark, sf):
    return contracts.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("constraint_fk", """
SELECT * FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM customer c WHERE c.c_mktsegment <> 'BUILDING' AND c.c_custkey = o.o_custkey)""")
def q_constraint_fk(spark, sf):
    parent = load(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return contracts.orphans(load(spark, sf, "orders"), parent, ["o_custkey"], ["c_custkey"])


_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "note"]
_CHECKS_SQL = """
WITH e AS (SELECT *, CAST(NULL AS VARCHAR) AS note FROM events)
SELECT 'rows_loaded_today' AS "check", count(*) > 0 AS ok, count(*) AS observed,
       'ts >= day start' AS detail FROM e WHERE ts >= TIMESTAMP '2024-01-30'
""" + "".join(
    f"UNION ALL SELECT 'no_all_null_columns:{c}', count({c}) > 0, count({c}), 'non-null values' "
    f"FROM e\n" for c in _EV_COLS) + """
UNION ALL SELECT 'no_duplicate_keys', coalesce(sum(n - 1), 0) = 0,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT), 'duplicate groups: ' || count(*)
FROM (SELECT event_id, count(*) AS n FROM e GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'no_duplicate_user_type', coalesce(sum(n - 1), 0) = 0,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT), 'duplicate groups: ' || count(*)
FROM (SELECT user_id, event_type, count(*) AS n FROM e GROUP BY 1, 2 HAVING count(*) > 1)"""


def _checks(spark, sf):
    e = load(spark, sf, "events").withColumn("note", F.lit(None).cast("string"))
    return quality.suite(
        quality.loaded_and_filled(e, "2024-01-30", time_col="ts"),
        quality.no_duplicates(e, ["event_id"]),
        quality.no_duplicates(e, ["user_id", "event_type"], name="no_duplicate_user_type"))


@register("quality_checks", _CHECKS_SQL)
def q_quality_checks(spark, sf):
    return _checks(spark, sf)


@register("quality_gate", f"""
SELECT CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS passed, count(*) AS total,
       bool_and(ok) AS ok,
       string_agg(CASE WHEN NOT ok THEN "check" END, ',' ORDER BY "check") AS failing
FROM ({_CHECKS_SQL})""")
def q_quality_gate(spark, sf):
    return quality.rollup(_checks(spark, sf))


# --- file sources: every fixture below is written by Spark from the given tables into the
# shared scratch folder (under spark.checkpoint.dir), then read back by the library ---------

def _scratch(spark, name):
    from fileflow.session import scratch_path
    return scratch_path(spark, name)




def _orders_out(df):
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
                     "o_orderpriority")


@register("csv_roundtrip", "SELECT * FROM orders")
def q_csv_roundtrip(spark, sf):
    from fileflow.sources.csv import export_csv, read_csv
    path = _scratch(spark, "csv_roundtrip")
    export_csv(load(spark, sf, "orders"), path, maxRecordsPerFile=2000)
    return _orders_out(read_csv(spark, path, date_columns=["o_orderdate"], root=path).data)


@register("csv_drift", """
SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, CAST(NULL AS BIGINT), o_orderstatus, o_totalprice
FROM orders WHERE o_orderstatus <> 'F'""")
def q_csv_drift(spark, sf):
    from fileflow.sources.csv import export_csv, read_csv
    o = load(spark, sf, "orders")
    root = _scratch(spark, "csv_drift")
    export_csv(o.filter(F.col("o_orderstatus") == "F")
               .select("o_orderkey", "o_custkey", "o_totalprice"), f"{root}/finished")
    export_csv(o.filter(F.col("o_orderstatus") != "F")
               .select("o_totalprice", "o_orderkey", "o_orderstatus"), f"{root}/open")
    return read_csv(spark, root).data.select("o_orderkey", "o_custkey", "o_orderstatus",
                                             "o_totalprice")


_LAYOUTS = 60


@register("csv_many_layouts", f"""
SELECT o_orderkey, CAST(o_orderkey % {_LAYOUTS} AS BIGINT) AS layout, o_custkey AS kept,
       o_totalprice FROM orders""")
def q_csv_many_layouts(spark, sf):
    """Every file has a header of its own: own column names, in turned order."""
    from fileflow.sources.csv import read_csv
    root, k = _scratch(spark, "csv_many_layouts"), F.col("o_orderkey") % _LAYOUTS
    cells = F.array(*[F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_totalprice")])
    names = F.array(F.lit("o_orderkey"), F.concat(F.lit("Kept "), F.col("k")), F.lit("o_totalprice"))

    def line(values):
        at = (F.col("k") % 3 + 1).cast("int")
        return F.concat_ws(",", F.slice(values, at, F.lit(3)), F.slice(values, F.lit(1), at - 1))

    rows = load(spark, sf, "orders").withColumn("k", k).withColumn("cells", cells)
    heads = rows.select("k").distinct().select("k", F.lit(0).alias("n"), line(names).alias("value"))
    rows = rows.select("k", F.lit(1).alias("n"), line(F.col("cells")).alias("value"))
    heads.union(rows).repartition("k").sortWithinPartitions("k", "n").select("k", "value") \
        .write.partitionBy("k").text(root)
    data = read_csv(spark, root).data
    mine = [i for i in range(_LAYOUTS) if f"kept_{i}" in data.columns]
    layout = F.coalesce(*[F.when(F.col(f"kept_{i}").isNotNull(), F.lit(i).cast("long"))
                          for i in mine])
    return data.select("o_orderkey", layout.alias("layout"),
                       F.coalesce(*[F.col(f"kept_{i}") for i in mine]).alias("kept"), "o_totalprice")


_NOTE = " – café €"


def _encoding_rows(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", "c_name", F.concat("c_name", F.lit(_NOTE)).alias("note"))


@register("encodings", "\nUNION ALL\n".join(
    f"SELECT '{v}' AS variant, c_custkey, c_name, c_name || ' – café €' AS note FROM customer"
    for v in ("utf8", "utf8bom", "utf16", "cp1252")))
def q_encodings(spark, sf):
    from fileflow.sources.csv import export_csv, read_csv
    rows = _encoding_rows(spark, sf)
    root = _scratch(spark, "encodings")
    export_csv(rows, f"{root}/utf8")
    export_csv(rows.withColumnRenamed("c_custkey", "﻿c_custkey"), f"{root}/utf8bom")
    export_csv(rows, f"{root}/utf16", encoding="UTF-16")
    export_csv(rows, f"{root}/cp1252", encoding="windows-1252")
    data = read_csv(spark, root, root=root).data
    return data.select(F.regexp_extract("source_file", r"^([^/]+)/", 1).alias("variant"),
                       "c_custkey", "c_name", "note")


@register("delimiters", "\nUNION ALL\n".join(
    [f"SELECT '{v}' AS variant, c_custkey, c_name, c_acctbal FROM customer"
     for v in ("comma", "semicolon", "tab", "pipe")]
    + ["SELECT 'single', CAST(NULL AS BIGINT), c_name, CAST(NULL AS DOUBLE) FROM customer"]))
def q_delimiters(spark, sf):
    from fileflow.sources.csv import export_csv, read_csv
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    root = _scratch(spark, "delimiters")
    for name, sep in (("comma", ","), ("semicolon", ";"), ("tab", "\t"), ("pipe", "|")):
        export_csv(c, f"{root}/{name}", sep=sep)
    export_csv(c.select("c_name"), f"{root}/single")
    data = read_csv(spark, root, root=root).data
    return data.select(F.regexp_extract("source_file", r"^([^/]+)/", 1).alias("variant"),
                       "c_custkey", "c_name", "c_acctbal")


def _ragged(spark, sf):
    from fileflow.sources.csv import read_csv
    from fileflow.testing import write_csv_with_header_rows
    c = load(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    base = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")
    line = (F.when(seg == "MACHINERY", F.concat_ws(",", base, seg, F.lit("extra")))
            .when(seg == "HOUSEHOLD", base)
            .otherwise(F.concat_ws(",", base, seg)))
    path = _scratch(spark, "ragged")
    write_csv_with_header_rows(c.select(line.alias("line")), path,
                               ["c_custkey", "c_name", "c_mktsegment"])
    return read_csv(spark, path, root=path)


@register("csv_ragged", """
SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END
       AS c_mktsegment
FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def q_csv_ragged(spark, sf):
    return _ragged(spark, sf).data.select("c_custkey", "c_name", "c_mktsegment")


@register("csv_reject_lines", """
SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || c_mktsegment || ',extra' AS line,
       'more fields than the header' AS reason
FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def q_csv_reject_lines(spark, sf):
    return _ragged(spark, sf).rejects.select("line", "reason")


def _workbooks(spark, sf):
    """One workbook per (nation, block of 5000 customer keys): sheet 'Customers' + 'Summary'."""
    import pandas as pd

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        from fileflow.testing import workbook_bytes
        pdf = pdf.sort_values("c_custkey")
        nation = int(pdf["c_nationkey"].iloc[0])
        block = int(pdf["blk"].iloc[0])
        rows = [["Customer Key", "Name", "Account Balance", "Segment"]]
        rows += [[int(k), n, float(b), s] for k, n, b, s in
                 zip(pdf.c_custkey, pdf.c_name, pdf.c_acctbal, pdf.c_mktsegment)]
        summary = [["Nation", "Customers"], [nation, len(pdf)]]
        data = workbook_bytes([("Customers", rows), ("Summary", summary)])
        return pd.DataFrame({"path": [f"wb/nation-{nation}-{block}.xlsx"], "content": [data]})

    c = load(spark, sf, "customer").withColumn("blk", F.floor(F.col("c_custkey") / 5000))
    return c.groupBy("c_nationkey", "blk").applyInPandas(build, "path string, content binary")


@register("xlsx_roundtrip", """
SELECT c_custkey AS customer_key, c_name AS name, c_acctbal AS account_balance,
       c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS nation
FROM customer""")
def q_xlsx_roundtrip(spark, sf):
    from fileflow.sources.excel import read_excel
    data = read_excel(spark, _workbooks(spark, sf), sheet="Customers").data
    nation = F.regexp_extract("source_file", r"nation-(\d+)-", 1).cast("bigint")
    return data.select("customer_key", "name", "account_balance", "segment",
                       nation.alias("nation"))


@register("xlsx_all_sheets", """
SELECT 'Customers' AS sheet, c_custkey AS customer_key, c_name AS name,
       CAST(NULL AS BIGINT) AS nation, CAST(NULL AS BIGINT) AS customers
FROM customer
UNION ALL
SELECT 'Summary', NULL, NULL, CAST(c_nationkey AS BIGINT), count(*)
FROM customer GROUP BY c_nationkey, floor(c_custkey / 5000)""")
def q_xlsx_all_sheets(spark, sf):
    from fileflow.sources.excel import read_excel
    data = read_excel(spark, _workbooks(spark, sf), sheet=None).data
    return data.select("sheet", "customer_key", "name", "nation", "customers")


@register("silver_partitions", """
SELECT event_id, ts, user_id, event_type, value, props, event_type AS source_file,
       strftime(ts, '%Y-%m-%d') AS run_date
FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-07' AND event_type = 'click'""")
def q_silver_partitions(spark, sf):
    from fileflow.sources.silver import read_silver, write_silver
    e = load(spark, sf, "events")
    root = _scratch(spark, "silver")
    write_silver(e.withColumn("run_date", F.date_format("ts", "yyyy-MM-dd"))
                 .withColumn("source_file", F.col("event_type")), root)
    return read_silver(spark, root, "2024-01-07", "click")


@register("incremental_ingest", "SELECT * FROM orders")
def q_incremental_ingest(spark, sf):
    from fileflow.operators.table import SnapshotTable
    from fileflow.sources.csv import export_csv
    from fileflow.streaming.incremental import run_available
    o = load(spark, sf, "orders")
    root = _scratch(spark, "incremental")
    src, cp = f"{root}/source", f"{root}/checkpoint"
    tbl = SnapshotTable(spark, f"{root}/table")
    export_csv(o.filter(F.col("o_orderstatus") == "F"), f"{src}/batch1")
    run_available(spark, src, tbl, cp, natural_keys=["o_orderkey"], date_columns=["o_orderdate"])
    export_csv(o.filter(F.col("o_orderstatus") != "F"), f"{src}/batch2")
    run_available(spark, src, tbl, cp, natural_keys=["o_orderkey"], date_columns=["o_orderdate"])
    return _orders_out(tbl.read())


@register("incremental_changes", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS price
FROM orders""")
def q_incremental_changes(spark, sf):
    """Files of one folder are rewritten under their paths between two runs of the stream."""
    from fileflow.operators.table import SnapshotTable
    from fileflow.sources.csv import export_csv
    from fileflow.streaming.incremental import run_available
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"),
                                         "o_orderstatus")
    root = _scratch(spark, "changes")
    src, cp, args = f"{root}/source", f"{root}/checkpoint", {"natural_keys": ["o_orderkey"]}
    tbl = SnapshotTable(spark, f"{root}/table")
    part = F.col("o_orderstatus") == "P"
    export_csv(o.filter(~part), f"{src}/done")
    _fixed_names(spark, o.filter(part), f"{src}/part")
    run_available(spark, src, tbl, cp, changed=True, chunk_bytes=1 << 16, **args)
    _fixed_names(spark, o.filter(part).withColumn("price", F.col("price") + 1), f"{src}/part")
    run_available(spark, src, tbl, cp, changed=True, chunk_bytes=1 << 16, **args)
    return tbl.read().select("o_orderkey", "price")


def _fixed_names(spark, df, folder, files=4):
    """``df`` as CSV files whose names are the same each time: <folder>/<k>.csv, by key."""
    from fileflow.sources.csv import export_csv
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(folder))
    for k in range(files):
        aside = _scratch(spark, "aside")
        export_csv(df.filter(F.pmod(F.col("o_orderkey"), F.lit(files)) == k).coalesce(1), aside)
        made = [f.getPath() for f in fs.listStatus(fs_path(aside))
                if f.getPath().getName().endswith(".csv")]
        fs.delete(fs_path(f"{folder}/{k}.csv"), False)
        fs.rename(made[0], fs_path(f"{folder}/{k}.csv"))


def _full_run(spark, sf):
    from fileflow.plans.full import full_run
    from fileflow.plans.lake import Lake
    from fileflow.sources.csv import export_csv
    import datetime as dt
    o = load(spark, sf, "orders")
    root = _scratch(spark, "full_run")
    src = f"{root}/source"
    export_csv(o, src, maxRecordsPerFile=4000)
    lake = Lake(spark, f"{root}/lake")
    today = dt.datetime.now(dt.timezone.utc).date()
    res = full_run(spark, lake, src, today.isoformat(), "run-1", natural_keys=["o_orderkey"],
                   date_columns=["o_orderdate"], as_of=today)
    return lake, res


@register("full_run", "SELECT * FROM orders")
def q_full_run(spark, sf):
    lake, _ = _full_run(spark, sf)
    return _orders_out(lake.table("records").read())


@register("full_run_checks", """
SELECT 'rows_loaded_today' AS "check", true AS ok, count(*) AS observed,
       'loaded_at >= day start' AS detail FROM orders
""" + "".join(f"UNION ALL SELECT 'no_all_null_columns:{c}', true, count({c}), 'non-null values' "
              f"FROM orders\n" for c in ("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice", "o_orderdate", "o_orderpriority")) + """
UNION ALL SELECT 'no_duplicate_keys', true, CAST(0 AS BIGINT), 'duplicate groups: 0'
UNION ALL SELECT 'latest_run_succeeded', true, CAST(1 AS BIGINT), 'full_pipeline'""")
def q_full_run_checks(spark, sf):
    _, res = _full_run(spark, sf)
    return res.checks


@register("discover_read", """
SELECT doc_id, source, n_chars, lang FROM documents""")
def q_discover_read(spark, sf):
    from fileflow.sources import discover
    from fileflow.sources.dispatch import read_files
    d = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    root = _scratch(spark, "discover")
    d.write.partitionBy("lang").option("header", "true").csv(f"{root}/docs")
    d.write.partitionBy("lang").json(f"{root}/docs_json")       # unsupported: must be skipped
    files = discover.scan(spark, root)
    ok, _ = discover.size_guard(files)
    data = read_files(spark, ok, root=root).data
    return data.select("doc_id", "source", "n_chars",
                       F.regexp_extract("source_file", r"lang=([^/]+)/", 1).alias("lang"))


@register("param_query", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority = '2-HIGH' AND o_totalprice > 300000""")
def q_param_query(spark, sf):
    from fileflow.sources.jdbc import query
    return query(spark, "SELECT O_ORDERKEY, O_TOTALPRICE FROM {t} "
                        "WHERE o_orderpriority = :prio AND o_totalprice > :minp",
                 {"prio": "2-HIGH", "minp": 300000}, t=load(spark, sf, "orders"))


@register("status_table", "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"Dataset\", count(*) AS \"Row Count\", "
    f"CAST(NULL AS TIMESTAMP) AS \"Last Loaded\" FROM {t}" for t in TABLES))
def q_status_table(spark, sf):
    st = catalog.status_table(catalog.list_datasets(spark, {t: load(spark, sf, t)
                                                            for t in TABLES}))
    return st.withColumn("Last Loaded", F.col("Last Loaded").cast("timestamp_ntz"))


# --- cases that files, tables and runs meet in practice ----------------------------------------

_NA_SQL = "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', " \
          "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"


@register("csv_quoted", f"""
SELECT src, id, turn, CASE WHEN text IN {_NA_SQL} THEN NULL ELSE {_STRIP_SQL.format('text')} END
       AS text
FROM (SELECT 'documents' AS src, doc_id AS id, CAST(0 AS BIGINT) AS turn, text FROM documents
      UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations)""")
def q_csv_quoted(spark, sf):
    from fileflow.sources.csv import export_csv, read_csv
    root = _scratch(spark, "csv_quoted")
    export_csv(load(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit(0).alias("turn"), "text"), f"{root}/documents")
    export_csv(load(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "turn", "text"),
               f"{root}/conversations")
    return read_csv(spark, root, root=root).data.select(
        F.regexp_extract("source_file", "^([^/]+)/", 1).alias("src"), "id", "turn", "text")


@register("csv_long_digits", """
SELECT c_custkey, CAST('9007199254740993' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS VARCHAR) AS account,
       CAST(c_custkey AS VARCHAR) || '.123456789012345678' AS ratio,
       repeat('8', 40) || CAST(c_custkey AS VARCHAR) AS card FROM customer""")
def q_csv_long_digits(spark, sf):
    """Numbers that neither bigint nor double holds: every digit comes back."""
    from fileflow.sources.csv import export_csv, read_csv
    key = F.col("c_custkey").cast("string")
    c = load(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("9007199254740993"), F.lpad(key, 9, "0")).alias("account"),
        F.concat(key, F.lit(".123456789012345678")).alias("ratio"),
        F.concat(F.lit("8" * 40), key).alias("card"))
    path = _scratch(spark, "long_digits")
    export_csv(c, path)
    return read_csv(spark, path).data.select(
        "c_custkey", F.col("account").cast("string"), F.col("ratio").cast("string"), "card")


@register("upsert_long_keys", """
SELECT CAST(9007199254740000 + o_orderkey AS VARCHAR) AS key, o_orderstatus AS status FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR) || '.5', 'half' FROM orders""")
def q_upsert_long_keys(spark, sf):
    """Whole keys beyond a double's digits meet a source whose keys are doubles."""
    from fileflow.operators.table import SnapshotTable
    o = load(spark, sf, "orders")
    t = SnapshotTable(spark, _scratch(spark, "long_keys"))
    t.append(o.select((F.col("o_orderkey") + 9007199254740000).alias("key"),
                      F.col("o_orderstatus").alias("status")))
    t.upsert(o.select((F.col("o_orderkey") + 0.5).cast("double").alias("key"),
                      F.lit("half").alias("status")), ["key"])
    text = F.regexp_replace(F.col("key").cast("string"), r"\.0+$|(?<=\.5)0+$", "")
    return t.read().select(text.alias("key"), "status")


@register("upsert_buckets", """
SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN o_totalprice + 1
       ELSE o_totalprice END AS price, CAST(15 AS BIGINT) AS folders_kept FROM orders""")
def q_upsert_buckets(spark, sf):
    """A delta on one key rewrites one bucket of 16: the folders of the others stay live."""
    from fileflow.operators.table import SnapshotTable
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    t = SnapshotTable(spark, _scratch(spark, "buckets"))
    t.upsert(o, ["o_orderkey"], buckets=16)
    before = set(t.head().folders)
    last = o.agg(F.max_by(F.struct("o_orderkey", "price"), "o_orderkey").alias("x")).select("x.*")
    t.upsert(last.withColumn("price", F.col("price") + 1), ["o_orderkey"])
    kept = len(before & set(t.head().folders))
    return t.read().withColumn("folders_kept", F.lit(kept).cast("long"))


@register("csv_ranges", f"""
SELECT doc_id, CASE WHEN text IN {_NA_SQL} THEN NULL ELSE {_STRIP_SQL.format('text')} END AS text
FROM documents WHERE doc_id IS NOT NULL OR text NOT IN {_NA_SQL}""")
def q_csv_ranges(spark, sf):
    """Files with quoted line breaks, each parsed by many tasks in ranges of 64 KiB."""
    from fileflow.sources.chunks import read_chunks
    from fileflow.sources.csv import export_csv, read_csv
    path = _scratch(spark, "csv_ranges")
    export_csv(load(spark, sf, "documents").select("doc_id", "text"), path)
    return read_csv(spark, read_chunks(spark, path, 1 << 16)).data.select("doc_id", "text")


@register("full_run_chunks", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS price,
       'two' || chr(10) || 'lines' AS note FROM orders""")
def q_full_run_chunks(spark, sf):
    """A day of files that land in chunks; in its second run one folder has changed."""
    from fileflow.plans.full import full_run
    o, src, lake, day, args, export_csv = _runs_twice(spark, sf, "run_chunks")
    args = {"natural_keys": ["o_orderkey"], "as_of": args["as_of"], "row_bytes": 4096,
            "chunk_bytes": 1 << 15}
    o = o.select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus",
                 F.lit("two\nlines").alias("note"))
    done = F.col("o_orderstatus") != "P"
    export_csv(o.filter(done), f"{src}/done")
    export_csv(o.filter(~done), f"{src}/part")
    full_run(spark, lake, src, day, "run-1", **args)
    export_csv(o.filter(~done).withColumn("price", F.col("price") + 1), f"{src}/part")
    full_run(spark, lake, src, day, "run-2", **args)
    return lake.table("records").read().select("o_orderkey", "price", "note")


@register("chunk_digests", """
WITH parts AS (
  SELECT doc_id, text, unnest(range(0, octet_length(encode(text)), 1024)) AS a,
         hex(encode(text)) AS x FROM documents WHERE text <> ''),
nodes AS (
  SELECT doc_id, any_value(text) AS text, count(*) AS n_chunks,
         list(sha256(unhex(substr(x, 2 * a + 1, 2048))) ORDER BY a) AS d FROM parts GROUP BY 1)
SELECT doc_id, md5(text) AS checksum_md5, n_chunks,
       CASE WHEN n_chunks = 1 THEN d[1] ELSE sha256(array_to_string(d, '')) END AS digest
FROM nodes""")
def q_chunk_digests(spark, sf):
    """Every text as a file in chunks of 1 KiB: md5 over the chunks, and the tree over them."""
    from fileflow.sources.chunks import chunked, digests
    files = load(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return digests(chunked(files, 1024)).select(
        F.col("path").cast("long").alias("doc_id"), "checksum_md5", "n_chunks", "digest")


#: Files of the late-quote and late-byte queries, by ranges of the key.
_LATE_FILES = 8


def _by_key(df, key):
    """Rows in files by key range, sorted, as one program after the other would write them."""
    return df.repartitionByRange(_LATE_FILES, key).sortWithinPartitions(key)


def _late(orders):
    """The last tenth of each of _LATE_FILES key ranges."""
    top = orders.agg(F.max("o_orderkey")).first()[0] + 1
    x = F.col("o_orderkey") * F.lit(float(_LATE_FILES)) / F.lit(float(top))
    return orders.withColumn("part", F.floor(x).cast("int")), x - F.floor(x) > 0.9


def _late_files(df, path, **options):
    """One file per range, the late rows at its end."""
    from fileflow.sources.csv import export_csv
    export_csv(df.repartition(_LATE_FILES, "part").sortWithinPartitions("part", "o_orderkey")
               .drop("part"), path, **options)


_X = f"o_orderkey * CAST({_LATE_FILES} AS DOUBLE) / (SELECT CAST(max(o_orderkey) + 1 AS DOUBLE) FROM orders)"
_LATE = f"{_X} - floor({_X}) > CAST(0.9 AS DOUBLE)"


@register("csv_late_quote", f"""
SELECT o_orderkey, CASE WHEN {_LATE} THEN 'two' || chr(10) || 'lines, "quoted"' ELSE 'plain' END
       AS note FROM orders""")
def q_csv_late_quote(spark, sf):
    from fileflow.sources.csv import read_csv
    o, late = _late(load(spark, sf, "orders").select("o_orderkey"))
    path = _scratch(spark, "late_quote")
    _late_files(o.withColumn("note", F.when(late, F.lit('two\nlines, "quoted"'))
                             .otherwise("plain")), path)
    return read_csv(spark, path).data.select("o_orderkey", "note")


@register("csv_late_encoding", f"""
SELECT o_orderkey, CASE WHEN {_LATE} THEN 'café €' ELSE 'plain' END AS note FROM orders""")
def q_csv_late_encoding(spark, sf):
    from fileflow.sources.csv import read_csv
    o, late = _late(load(spark, sf, "orders").select("o_orderkey"))
    path = _scratch(spark, "late_encoding")
    _late_files(o.withColumn("note", F.when(late, F.lit("café €")).otherwise("plain")), path,
                encoding="windows-1252")
    return read_csv(spark, path).data.select("o_orderkey", "note")


_WIDE = [f"column_{i:04d}_" + "x" * 90 for i in range(700)]


@register("csv_wide_header", f"""
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey,
       CAST({len(_WIDE)} * n_nationkey + {sum(range(len(_WIDE)))} AS BIGINT) AS total FROM nation""")
def q_csv_wide_header(spark, sf):
    from pyspark.sql.types import LongType, StructField, StructType
    from fileflow.sources.csv import export_csv, read_csv
    n = load(spark, sf, "nation")
    path = _scratch(spark, "wide_header")
    export_csv(n.select("n_nationkey", *[(F.col("n_nationkey") + i).alias(c)
                                         for i, c in enumerate(_WIDE)]), path)
    schema = StructType([StructField(c, LongType()) for c in ["n_nationkey", *_WIDE]])
    data = read_csv(spark, path, schema=schema).data
    return data.select("n_nationkey", F.aggregate(F.array(*_WIDE), F.lit(0).cast("long"),
                                                  lambda a, x: a + x).alias("total"))


@register("csv_code_columns", """
SELECT c_custkey, CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN 'D' ELSE 'F' END
       AS code, CAST(c_custkey AS DOUBLE) / 2 AS half FROM customer""")
def q_csv_code_columns(spark, sf):
    from fileflow.sources.csv import export_csv, read_csv
    c = load(spark, sf, "customer").select(
        "c_custkey", F.concat(F.col("c_custkey").cast("string"), F.when(
            F.col("c_custkey") % 2 == 0, "D").otherwise("F")).alias("code"),
        (F.col("c_custkey") / 2).alias("half"))
    path = _scratch(spark, "code_columns")
    export_csv(c, path)
    return read_csv(spark, path).data.select("c_custkey", "code", "half")


@register("coerce_dates_forms", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE o_orderdate END AS parsed FROM orders""")
def q_coerce_dates_forms(spark, sf):
    from fileflow.operators.clean import coerce_dates
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 7
    text = (F.when(k == 0, F.date_format(d, "M/d/yyyy"))
            .when(k == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k == 2, F.date_format(F.timestamp_add("HOUR", F.lit(2), d),
                                        "yyyy-MM-dd HH:mm:ss'+02:00'"))
            .when(k == 3, F.date_format(d, "yyyy-M-d")).when(k == 4, F.date_format(d, "d MMM yyyy"))
            .when(k == 5, F.date_format(d, "yyyy-MM-dd HH:mm:ss'.000000000'"))
            .otherwise(F.date_format(d, "'week' D 'of' yyyy")))
    o = load(spark, sf, "orders").select("o_orderkey", text.alias("parsed"))
    return coerce_dates(o, ["parsed"]).withColumn("parsed", F.col("parsed").cast("timestamp_ntz"))


@register("upsert_type_drift", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'c-' || CAST(o_custkey AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) END AS buyer FROM orders""")
def q_upsert_type_drift(spark, sf):
    from fileflow.operators.table import SnapshotTable
    o = load(spark, sf, "orders")
    t = SnapshotTable(spark, _scratch(spark, "type_drift"))
    t.append(o.select("o_orderkey", F.col("o_custkey").alias("buyer")))
    t.upsert(o.filter("o_orderstatus = 'F'").select(
        "o_orderkey", F.concat(F.lit("c-"), F.col("o_custkey").cast("string")).alias("buyer")),
        ["o_orderkey"])
    return t.read()


@register("upsert_composite_key", """
SELECT l_orderkey, l_linenumber,
       coalesce(max(l_quantity) FILTER (WHERE l_returnflag = 'R') * 2, sum(l_quantity)) AS qty
FROM lineitem GROUP BY ALL""")
def q_upsert_composite_key(spark, sf):
    from fileflow.operators.table import SnapshotTable
    li, keys = load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    t = SnapshotTable(spark, _scratch(spark, "composite"))
    t.append(li.groupBy(*keys).agg(F.sum("l_quantity").alias("qty")))
    t.upsert(li.filter("l_returnflag = 'R'").groupBy(*keys)
             .agg((F.max("l_quantity") * 2).alias("qty")), keys)
    return t.read()


@register("incremental_replay", "SELECT * FROM orders")
def q_incremental_replay(spark, sf):
    """A writer dies after its data is written and before its log row; its batch is replayed."""
    from fileflow.operators.table import SnapshotTable
    o, t = load(spark, sf, "orders"), SnapshotTable(spark, _scratch(spark, "replay"))
    t.append(o.filter("o_orderstatus = 'F'"))
    rest = o.filter("o_orderstatus <> 'F'")
    t._write(rest, None)
    for _ in range(2):
        t.upsert(rest, ["o_orderkey"])
    return _orders_out(t.read())


def _runs_twice(spark, sf, name):
    from fileflow.plans.lake import Lake
    from fileflow.sources.csv import export_csv
    import datetime as dt
    root = _scratch(spark, name)
    today = dt.datetime.now(dt.timezone.utc).date()
    args = {"natural_keys": ["o_orderkey"], "date_columns": ["o_orderdate"], "as_of": today}
    return load(spark, sf, "orders"), f"{root}/source", Lake(spark, f"{root}/lake"), \
        today.isoformat(), args, export_csv


@register("full_run_retry", "SELECT * FROM orders")
def q_full_run_retry(spark, sf):
    """The first load fails after landing; the next run lands nothing and loads everything."""
    from fileflow.operators.contracts import SchemaValidationError
    from fileflow.plans.full import full_run
    from fileflow.schemas import ColumnSpec
    o, src, lake, day, args, export_csv = _runs_twice(spark, sf, "run_retry")
    export_csv(o, src, maxRecordsPerFile=4000)
    try:
        full_run(spark, lake, src, day, "run-1", specs=[ColumnSpec("absent", nullable=False)], **args)
    except SchemaValidationError:
        pass
    full_run(spark, lake, src, day, "run-2", **args)
    return _orders_out(lake.table("records").read())


@register("full_run_second", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS price,
       'records' AS src FROM orders
UNION ALL SELECT count(*), CAST(NULL AS DOUBLE), 'silver' FROM orders
UNION ALL SELECT CAST(1 AS BIGINT), CAST(NULL AS DOUBLE), 'day manifests'""")
def q_full_run_second(spark, sf):
    """Second run of a day: unchanged files are skipped, a changed folder and a new one load,
    and silver keeps one copy of every file."""
    from fileflow.plans.full import full_run
    from fileflow.sources.landing import manifest_runs
    from fileflow.sources.silver import read_silver
    o, src, lake, day, args, export_csv = _runs_twice(spark, sf, "run_second")
    args = {"natural_keys": ["o_orderkey"], "as_of": args["as_of"]}
    o = o.select("o_orderkey", "o_totalprice", "o_orderstatus")
    status = F.col("o_orderstatus")
    export_csv(_by_key(o.filter(status == "F"), "o_orderkey"), f"{src}/done")
    export_csv(_by_key(o.filter(status == "P"), "o_orderkey"), f"{src}/part")
    full_run(spark, lake, src, day, "run-1", **args)
    _replace_text(spark, f"{src}/part", o.filter(status == "P").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1))
    export_csv(_by_key(o.filter(status == "O"), "o_orderkey"), f"{src}/open")
    full_run(spark, lake, src, day, "run-2", **args)
    silver = read_silver(spark, lake.silver_root, day)
    days = manifest_runs(spark, lake.manifests)
    one = F.lit(None).cast("double").alias("price")
    return (lake.table("records").read().select("o_orderkey", F.col("o_totalprice").alias("price"),
                                                F.lit("records").alias("src"))
            .union(silver.dropDuplicates(["o_orderkey"]).agg(F.count("*")).select(
                "*", one, F.lit("silver")))
            .union(days.agg(F.count("*")).select("*", one, F.lit("day manifests"))))


def _replace_text(spark, path, df):
    """New files in place of the folder's old ones, as an outside program would leave them."""
    from fileflow.sources.csv import export_csv
    export_csv(_by_key(df, "o_orderkey"), path)


@register("constraint_not_null", """
SELECT 'o_orderkey' AS "column", CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) AS n_null
FROM orders
UNION ALL SELECT 'o_clerk', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders""")
def q_constraint_not_null(spark, sf):
    o = load(spark, sf, "orders").withColumn(
        "o_clerk", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")))
    return contracts.null_counts(o, ["o_orderkey", "o_clerk"])


@register("prefix_listing", "SELECT DISTINCT 'docs/lang=de/source=' || source AS folder "
                            "FROM documents WHERE lang = 'de'")
def q_prefix_listing(spark, sf):
    from fileflow.sources import discover
    root = _scratch(spark, "prefix")
    load(spark, sf, "documents").select("doc_id", "lang", "source").repartition("lang", "source") \
        .write.partitionBy("lang", "source").option("header", "true").csv(f"{root}/docs")
    return discover.scan(spark, root, prefix="docs/lang=de/") \
        .select(F.regexp_replace("file_id", "/[^/]*$", "").alias("folder")).distinct()


@register("null_rate_map", "\nUNION ALL ".join(
    f"SELECT 'events' AS dataset, count(*) AS row_count, '{c}' AS \"column\", "
    f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM "
    "(SELECT *, CASE WHEN event_type = 'click' THEN value END AS click_value FROM events)"
    for c in ("event_id", "props", "click_value")))
def q_null_rate_map(spark, sf):
    e = load(spark, sf, "events").withColumn(
        "click_value", F.when(F.col("event_type") == "click", F.col("value")))
    s = catalog.stats(e.select("event_id", "props", "click_value"), "events")
    return s.select("dataset", "row_count", F.explode("null_rates").alias("column", "null_rate"))


@register("manifest_update", f"""
SELECT {_DOC_KEY_SQL} AS storage_path, CASE WHEN lang = 'fr' THEN 'LOADED' ELSE 'PENDING' END AS status,
       CASE WHEN lang = 'fr' THEN n_chars END AS row_count FROM documents""")
def q_manifest_update(spark, sf):
    from fileflow.operators.table import SnapshotTable
    from fileflow.sources.landing import manifest_rows
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv"))
    d = load(spark, sf, "documents").select(
        "lang", "n_chars", name.alias("file_name"), F.md5("text").alias("checksum_md5"),
        F.concat_ws("/", "lang", "source", name).alias("storage_path"))
    t = SnapshotTable(spark, _scratch(spark, "manifest_update"))
    t.append(manifest_rows(d, "run-1"))
    t.upsert(manifest_rows(d.filter("lang = 'fr'").withColumn("row_count", F.col("n_chars")),
                           "run-1", "LOADED"), ["storage_path"])
    return t.read().select("storage_path", "status", "row_count")


@register("packed_load", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_packed_load(spark, sf):
    from fileflow.plans.extract import extract
    from fileflow.plans.transform import transform_load
    o, src, lake, day, _, export_csv = _runs_twice(spark, sf, "packed")
    export_csv(o.select("o_orderkey", "o_custkey", "o_orderstatus"), src, maxRecordsPerFile=4000)
    extract(spark, lake, src, day, "run-1")
    transform_load(spark, lake, day, "run-1", mode="packed")
    row = F.from_json("data_json", "o_orderkey long, o_custkey long, o_orderstatus string")
    return lake.table("elt_data").read().select(row.alias("r")).select("r.*")


@register("catalog_listing", """
SELECT 'fileflow_customer' AS name, count(*) AS row_count FROM customer
UNION ALL SELECT 'fileflow_orders', count(*) FROM orders""")
def q_catalog_listing(spark, sf):
    for t in ("orders", "customer"):
        load(spark, sf, t).createOrReplaceTempView(f"fileflow_{t}")
    return catalog.list_datasets(spark).filter(F.startswith("name", F.lit("fileflow_"))) \
        .select("name", "row_count")


@register("xlsx_missing_sheet", """
SELECT DISTINCT 'wb/nation-' || c_nationkey || '-' || CAST(floor(c_custkey / 5000) AS BIGINT) || '.xlsx'
       AS source_file, 'no rows in sheet ' || chr(39) || 'Nowhere' || chr(39) AS reason FROM customer""")
def q_xlsx_missing_sheet(spark, sf):
    from fileflow.sources.excel import read_excel
    return read_excel(spark, _workbooks(spark, sf), sheet="Nowhere").rejects


@register("dispatch_mixed", """
SELECT c_custkey AS customer_key, c_name AS name, c_nationkey < 10 AS from_csv FROM customer""")
def q_dispatch_mixed(spark, sf):
    from fileflow.sources.csv import export_csv
    from fileflow.sources.dispatch import read_files
    path = _scratch(spark, "mixed")
    export_csv(load(spark, sf, "customer").filter("c_nationkey < 10").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Name")), path)
    books = _workbooks(spark, sf).filter(
        F.regexp_extract("path", r"nation-(\d+)-", 1).cast("int") >= 10)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    files = files.filter(F.endswith("path", F.lit(".csv"))).unionByName(books)
    data = read_files(spark, files, sheet="Customers").data
    return data.select("customer_key", "name",
                       F.endswith("source_file", F.lit(".csv")).alias("from_csv"))


@register("records_page_after", """
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10'
   OR (ts = TIMESTAMP '2024-01-10' AND event_id > 0) ORDER BY ts, event_id LIMIT 100""")
def q_records_page_after(spark, sf):
    return records.page_after(load(spark, sf, "events"), ["ts", "event_id"],
                              ["2024-01-10 00:00:00", 0], limit=100)


@register("records_page_deep", """
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)
WHERE rn > (SELECT count(*) * 9 // 10 FROM events)
  AND rn <= (SELECT count(*) * 9 // 10 FROM events) + 100""")
def q_records_page_deep(spark, sf):
    from fileflow.operators.rankindex import of_table
    from fileflow.operators.table import SnapshotTable
    t = SnapshotTable(spark, _scratch(spark, "page_deep"))
    t.append(load(spark, sf, "events"))
    index = of_table(t, ["ts", "event_id"], rows_per_range=400)
    return index.page(limit=100, offset=index.rows * 9 // 10, with_rn=True)


def _catalog_tables(spark, sf, tag, names):
    """Tables of a database of their own, over copies of the given ones."""
    import uuid

    from fileflow.operators import tablestats
    base = _scratch(spark, tag)
    db = f"{tag}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}/db'")
    out = []
    for n in names:
        df = load(spark, sf, n)
        df.write.parquet(f"{base}/{n}")
        tablestats.register(spark, f"{db}.{n}", df.schema, f"{base}/{n}")
        out.append(f"{db}.{n}")
    return out, base


@register("catalog_kept_counts", """
SELECT 'customer' AS name, (SELECT count(*) FROM customer) AS row_count, 'fresh' AS status
UNION ALL SELECT 'events', (SELECT count(*) FROM events), 'stale'
UNION ALL SELECT 'orders', NULL, 'none'""")
def q_catalog_kept_counts(spark, sf):
    from fileflow.operators import tablestats
    names, base = _catalog_tables(spark, sf, "kept_counts", ["customer", "events", "orders"])
    for n in names[:2]:
        tablestats.analyze(spark, n)
    load(spark, sf, "events").write.mode("append").parquet(f"{base}/events")
    return tablestats.list_datasets(spark, names).select(
        F.element_at(F.split("name", r"\."), -1).alias("name"), "row_count", "status")


@register("catalog_kept_columns", """
SELECT 'o_custkey' AS column_name, count(*) AS row_count,
       count(*) - count(o_custkey) AS null_count,
       CAST(min(o_custkey) AS VARCHAR) AS min_value, CAST(max(o_custkey) AS VARCHAR) AS max_value
FROM orders
UNION ALL SELECT 'o_orderkey', count(*), count(*) - count(o_orderkey),
       CAST(min(o_orderkey) AS VARCHAR), CAST(max(o_orderkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), NULL, NULL
FROM orders""")
def q_catalog_kept_columns(spark, sf):
    from fileflow.operators import tablestats
    names, _ = _catalog_tables(spark, sf, "kept_columns", ["orders"])
    tablestats.refresh(spark, names)
    return tablestats.column_stats(spark, names[0]).filter(
        F.col("column_name").isin("o_orderkey", "o_custkey", "o_orderstatus")).select(
        "column_name", "row_count", "null_count", "min_value", "max_value")
