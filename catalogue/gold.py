"""Gold publications, the Silver to Gold chain, history and ad-hoc queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import ORDER_COLUMNS, layers, load, query, stamp, view
from tierlake import tables
from tierlake.plans import audit
from tierlake.plans.chain import transform_and_publish
from tierlake.plans.gold import publish_gold
from tierlake.plans.silver import write_silver


def silver_orders(spark, sf, space, df=None):
    write_silver(spark, space, "orders", load(spark, sf, "orders") if df is None else df)


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def gold_replace(spark, sf):
    space = layers(spark)
    silver_orders(spark, sf, space)
    for strategy in ("replace", "truncate"):
        publish_gold(spark, space, "orders", "orders", strategy)
    return tables.read(spark, space.resolve("orders", "gold"))


@query(f"SELECT {ORDER_COLUMNS} FROM orders UNION ALL SELECT {ORDER_COLUMNS} FROM orders")
def gold_append(spark, sf):
    space = layers(spark)
    silver_orders(spark, sf, space)
    for strategy in ("replace", "append"):
        publish_gold(spark, space, "orders", "orders", strategy)
    return tables.read(spark, space.resolve("orders", "gold"))


DATE_REPLACED = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN CAST(o_orderdate AS DATE) = DATE '1995-06-19' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
       {{date}} AS o_orderdate, o_orderpriority FROM orders
"""


def replace_one_date(spark, sf, orders, partition_by=None):
    space = layers(spark)
    silver_orders(spark, sf, space, orders)
    publish_gold(spark, space, "orders", "orders", partition_by=partition_by)
    # Every price changes in Silver, but only one day is published.
    silver_orders(spark, sf, space, orders.withColumn("o_totalprice", -F.col("o_totalprice")))
    for _ in range(2):
        publish_gold(spark, space, "orders", "orders", "delete_and_insert", "O_ORDERDATE", "1995-06-19")
    return tables.read(spark, space.resolve("orders", "gold"))


@query(DATE_REPLACED.format(date=stamp("o_orderdate")))
def gold_date_replace(spark, sf):
    return replace_one_date(spark, sf, load(spark, sf, "orders"))


@query(DATE_REPLACED.format(date="strftime(o_orderdate, '%Y-%m')").replace(
    "CAST(o_orderdate AS DATE) = DATE '1995-06-19'", "date_trunc('month', o_orderdate) = DATE '1995-06-01'"))
def gold_date_replace_partition(spark, sf):
    # Partitioned by the first day of the month: only that partition is rewritten.
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    orders = load(spark, sf, "orders").withColumn("o_orderdate", month)
    space = layers(spark)
    silver_orders(spark, sf, space, orders)
    publish_gold(spark, space, "orders", "orders", partition_by="o_orderdate")
    silver_orders(spark, sf, space, orders.withColumn("o_totalprice", -F.col("o_totalprice")))
    for _ in range(2):
        publish_gold(spark, space, "orders", "orders", "delete_and_insert", "o_orderdate", "1995-06-01")
    gold = tables.read(spark, space.resolve("orders", "gold"))
    return gold.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM"))


@query(f"""
SELECT event_id, {stamp('ts')} AS ts, user_id, event_type, props,
       CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value * 2 ELSE value END AS value
FROM events
""")
def gold_date_replace_day(spark, sf):
    # Partitioned by the day of a timestamp, in a column that Gold does not show.
    events, space = load(spark, sf, "events"), layers(spark)
    write_silver(spark, space, "events", events)
    publish_gold(spark, space, "events", "events", partition_by="ts")
    write_silver(spark, space, "events", events.withColumn("value", F.col("value") * 2))
    for _ in range(2):
        publish_gold(spark, space, "events", "events", "delete_and_insert", "ts", "2024-01-10")
    return tables.read(spark, space.resolve("events", "gold"))


@query("""
SELECT c.c_nationkey, o.o_orderkey, o.o_totalprice * 2 AS price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def chain_silver_gold(spark, sf):
    space = layers(spark)
    spec = {
        "target_table": "order_prices", "strategy": "overwrite",
        "sources": [
            {"fqn": view(spark, sf, "orders"), "alias": "o"},
            {"fqn": view(spark, sf, "customer"), "alias": "c",
             "join_conds": [{"lh": "o.o_custkey", "rh": "c.c_custkey"}]}],
        "columns": [{"source_expr": "c.c_nationkey"}, {"source_expr": "o.o_orderkey"},
                    {"source_expr": "o.o_totalprice * 2", "target": "price"}],
    }
    transform_and_publish(spark, space, spec, "order_prices",
                          tests=[{"test": "unique", "column": "o_orderkey"}])
    return tables.read(spark, space.resolve("order_prices", "gold"))


@query("""
SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS spent FROM orders
GROUP BY o_custkey ORDER BY spent DESC, o_custkey LIMIT 20
""")
def adhoc_topk(spark, sf):
    orders = view(spark, sf, "orders")
    return audit.run_sql(spark, f"""
        SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM {orders}
        GROUP BY o_custkey ORDER BY spent DESC, o_custkey""", limit=20)


@query("""
SELECT t."table", t.position, t."column", t.type, count(*) FILTER (v.value IS NOT NULL) AS filled
FROM (VALUES ('orders', 1, 'o_orderkey', 'bigint'), ('orders', 2, 'o_custkey', 'bigint'),
  ('orders', 3, 'o_orderstatus', 'string'), ('orders', 4, 'o_totalprice', 'double'),
  ('orders', 5, 'o_orderdate', 'timestamp_ntz'), ('orders', 6, 'o_orderpriority', 'string'))
  t("table", position, "column", type)
JOIN (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM orders) ON COLUMNS(*)) v ON v.name = t."column"
GROUP BY ALL
""")
def catalog_listing(spark, sf):
    # Each listed column with the number of its values.
    space = layers(spark)
    silver_orders(spark, sf, space)
    rows = tables.read(spark, space.resolve("orders", "silver"))
    counts = rows.agg(*(F.count(c).alias(c) for c in rows.columns))
    filled = counts.unpivot([], counts.columns, "column", "filled")
    return audit.list_columns(spark, space, "silver").drop("database").join(filled, "column")


def run_log(spark, sf):
    """The events read as a run history: a job per type, a run per event."""
    return load(spark, sf, "events").select(
        F.col("event_type").alias("job"), F.to_date("ts").alias("run_date"),
        F.col("ts").cast("timestamp").alias("started_at"),
        (F.col("ts").cast("timestamp") + F.expr("INTERVAL 1 MINUTE")).alias("ended_at"),
        F.concat(F.when(F.col("value") > 50, "failed-").otherwise("success-"), F.col("event_id")).alias("status"))


RUN_LOG = f"""SELECT event_type AS job, strftime(ts, '%Y-%m-%d') AS run_date, {stamp('ts')} AS started_at,
       {stamp('ts + INTERVAL 1 MINUTE')} AS ended_at,
       CASE WHEN value > 50 THEN 'failed-' ELSE 'success-' END || event_id AS status FROM events"""


@query(f"""
SELECT *, row_number() OVER (PARTITION BY job, run_date ORDER BY started_at, ended_at, status) AS attempt
FROM ({RUN_LOG})
""")
def run_attempts(spark, sf):
    return audit.attempts(run_log(spark, sf))


@query(f"""
SELECT * FROM ({RUN_LOG}) QUALIFY row_number() OVER (PARTITION BY job
  ORDER BY started_at DESC, run_date DESC, ended_at DESC, status DESC) = 1
""")
def run_last_status(spark, sf):
    return audit.last_status(run_log(spark, sf))


@query(f"SELECT * FROM ({RUN_LOG}) ORDER BY started_at DESC, job, run_date LIMIT 50")
def run_newest(spark, sf):
    return audit.run_history(run_log(spark, sf))
