"""Bronze snapshots: full, delta, chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import EVENT_COLUMNS, EVENTS, ORDER_COLUMNS, contract, layers, load, query
from tierlake import tables
from tierlake.operators.quality import reconcile
from tierlake.operators.snapshots import latest_per_key
from tierlake.plans.bronze import bronze_delta, bronze_full, latest_snapshot, rebuild_from
from tierlake.plans.chain import ingest_and_promote
from tierlake.plans.lake import ingest

LATEST = "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1"

# First day: the first half of the month. Second day: the rest, with the errors dated a
# month back, so that they arrive late.
FIRST = "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15'"
SECOND = """SELECT event_id, CASE WHEN event_type = 'error' THEN ts - INTERVAL 30 DAY ELSE ts END AS ts,
       user_id, event_type, value, props FROM events WHERE ts >= TIMESTAMP '2024-01-15'"""


def two_days(events):
    later = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    late = F.when(F.col("event_type") == "error", F.col("ts") - F.expr("INTERVAL 30 DAYS"))
    return events.filter(~later), events.filter(later).withColumn("ts", F.coalesce(late, F.col("ts")))


@query(f"SELECT {EVENT_COLUMNS}, '2024-01-31' AS snapshot_date FROM (SELECT * FROM events {LATEST})")
def bronze_full_latest(spark, sf):
    sheet, space = contract(spark, EVENTS), layers(spark)
    ingest(spark, space, "events", load(spark, sf, "events"), sheet, "2024-01-31")
    bronze_full(spark, space, "events", "2024-01-31", sheet)
    return tables.read(spark, space.resolve("events", "bronze"))


@query(f"SELECT {EVENT_COLUMNS} FROM (SELECT * FROM events {LATEST})")
def latest_by_key(spark, sf):
    return latest_per_key(load(spark, sf, "events"), ["user_id", "event_type"], "ts")


@query(f"SELECT DISTINCT {ORDER_COLUMNS} FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)")
def bronze_full_distinct(spark, sf):
    orders = load(spark, sf, "orders")
    return latest_per_key(orders.unionByName(orders), [])


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey DESC, l_suppkey DESC,
     l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC) = 1
""")
def bronze_full_keys(spark, sf):
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    return latest_per_key(lines, ["l_orderkey"])


@query(f"""
WITH d1 AS (SELECT * FROM ({FIRST}) {LATEST}),
d2 AS (SELECT * FROM ({SECOND}) {LATEST}),
merged AS (SELECT * FROM (SELECT *, 0 AS old FROM d2 UNION ALL SELECT *, 1 AS old FROM d1)
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, old) = 1)
SELECT {EVENT_COLUMNS}, '2024-01-14' AS snapshot_date FROM d1
UNION ALL SELECT {EVENT_COLUMNS}, '2024-01-31' FROM merged
""")
def bronze_delta_late(spark, sf):
    sheet, space = contract(spark, EVENTS), layers(spark)
    for day, rows in zip(("2024-01-14", "2024-01-31"), two_days(load(spark, sf, "events"))):
        ingest(spark, space, "events", rows, sheet, day)
        bronze_delta(spark, space, "events", day, sheet)
    bronze_delta(spark, space, "events", "2024-01-31", sheet)
    return tables.read(spark, space.resolve("events", "bronze"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
UNION SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice FROM orders
""")
def bronze_delta_nokey(spark, sf):
    sheet = contract(spark, "o_orderkey bigint\no_custkey bigint\no_orderstatus string\no_totalprice double")
    orders, space = load(spark, sf, "orders").select(*sheet.names), layers(spark)
    days = {"2024-01-14": orders, "2024-01-15": orders.withColumn("o_orderstatus", F.lit("F"))}
    for day, rows in days.items():
        ingest(spark, space, "orders", rows, sheet, day)
        bronze_delta(spark, space, "orders", day, sheet)
    bronze = tables.read(spark, space.resolve("orders", "bronze"))
    return bronze.filter("snapshot_date = DATE '2024-01-15'").drop("snapshot_date")


@query(f"""
WITH d1 AS (SELECT * FROM ({FIRST}) {LATEST}),
d2 AS (SELECT * FROM ({SECOND}) {LATEST}),
merged AS (SELECT * FROM (SELECT *, 0 AS old FROM d2 UNION ALL SELECT *, 1 AS old FROM d1)
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, old) = 1)
SELECT {EVENT_COLUMNS}, '2024-01-14' AS snapshot_date FROM d1
UNION ALL SELECT {EVENT_COLUMNS}, '2024-01-31' FROM merged
""")
def bronze_rebuild(spark, sf):
    # The days arrive in the wrong order; the later snapshot is then built again.
    sheet, space = contract(spark, EVENTS), layers(spark)
    first, second = two_days(load(spark, sf, "events"))
    for day, rows in (("2024-01-31", second), ("2024-01-14", first)):
        ingest(spark, space, "events", rows, sheet, day)
        bronze_delta(spark, space, "events", day, sheet)
    rebuild_from(spark, space, "events", "2024-01-14", sheet)
    return tables.read(spark, space.resolve("events", "bronze"))


CHAIN = """SELECT event_id, CASE WHEN event_type = 'error' THEN ts - INTERVAL 9 DAY WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts,
       user_id, event_type, value, props, CAST(ts AS DATE) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-08'"""


@query(f"""
WITH moved AS ({CHAIN}), days AS (SELECT DISTINCT day FROM moved),
best AS (SELECT * FROM moved QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day
  ORDER BY ts DESC NULLS LAST, event_id DESC, value DESC, props DESC) = 1),
state AS (SELECT days.day AS snapshot, best.* FROM days JOIN best ON best.day <= days.day
  QUALIFY row_number() OVER (PARTITION BY snapshot, user_id, event_type ORDER BY ts DESC NULLS LAST, best.day DESC) = 1)
SELECT {EVENT_COLUMNS}, strftime(snapshot, '%Y-%m-%d') AS snapshot_date FROM state
""")
def bronze_rebuild_chain(spark, sf):
    # A Lake partition a day, with late records and some without a time. A first snapshot stands, the others follow.
    sheet, space = contract(spark, EVENTS), layers(spark)
    events = load(spark, sf, "events").filter(F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz"))
    late = F.when(F.col("event_type") == "error", F.col("ts") - F.expr("INTERVAL 9 DAYS"))
    time = late.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("ts"))
    rows = events.withColumn("ingest_date", F.to_date("ts")).withColumn("ts", time.cast("timestamp"))
    space.ensure(spark, "lake")
    tables.replace(spark, space.resolve("events", "lake"), rows, ["ingest_date"])
    bronze_delta(spark, space, "events", "2024-01-08", sheet)
    rebuild_from(spark, space, "events", "2024-01-09", sheet)
    return tables.read(spark, space.resolve("events", "bronze"))


@query(f"""
SELECT 'lake' AS layer, '2024-01-31' AS day, count(*) AS n FROM events
UNION ALL SELECT 'bronze', '2024-01-31', (SELECT count(*) FROM (SELECT * FROM events {LATEST}))
""")
def chain_lake_bronze(spark, sf):
    sheet, space = contract(spark, EVENTS), layers(spark)
    ingest_and_promote(spark, space, "events", load(spark, sf, "events"), sheet, "2024-01-31", "replace")
    lake, bronze = (space.resolve("events", layer) for layer in ("lake", "bronze"))
    last = latest_snapshot(spark, bronze, "2024-02-01")
    counted = [
        tables.read(spark, table).groupBy(F.lit(layer).alias("layer"), F.col(date).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        for table, layer, date in ((lake, "lake", "ingest_date"), (bronze, "bronze", "snapshot_date"))
    ]
    return counted[0].unionByName(counted[1]).filter(F.col("day") == F.lit(last))


@query("""
WITH a AS (SELECT * FROM lineitem), b AS (SELECT DISTINCT * FROM lineitem),
pa AS (SELECT count(*) AS r, sum(CAST(l_quantity AS DECIMAL(28,6))) AS q, count(DISTINCT (l_orderkey, l_linenumber)) AS k,
       count_if(l_quantity IS NULL) AS n FROM a),
pb AS (SELECT count(*) AS r, sum(CAST(l_quantity AS DECIMAL(28,6))) AS q, count(DISTINCT (l_orderkey, l_linenumber)) AS k,
       count_if(l_quantity IS NULL) AS n FROM b)
SELECT 'rows' AS measure, CAST(pa.r AS DOUBLE) AS left_value, CAST(pb.r AS DOUBLE) AS right_value,
       pa.r = pb.r AS matches FROM pa, pb
UNION ALL SELECT 'sum_l_quantity', CAST(pa.q AS DOUBLE), CAST(pb.q AS DOUBLE), pa.q = pb.q FROM pa, pb
UNION ALL SELECT 'nulls_l_quantity', CAST(pa.n AS DOUBLE), CAST(pb.n AS DOUBLE), pa.n = pb.n FROM pa, pb
UNION ALL SELECT 'keys', CAST(pa.k AS DOUBLE), CAST(pb.k AS DOUBLE), pa.k = pb.k FROM pa, pb
""")
def layer_reconcile(spark, sf):
    lines = load(spark, sf, "lineitem")
    return reconcile(lines, latest_per_key(lines, []), ["l_orderkey", "l_linenumber"], ["l_quantity"])
