"""Silver specifications, joins, merges, models and data tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import EVENT_COLUMNS, EVENTS, ORDER_COLUMNS, contract, layers, load, query, stamp, view
from tierlake import tables
from tierlake.operators.checksums import differing_rows
from tierlake.operators.filters import date_scope
from tierlake.operators.joins import missing_keys
from tierlake.operators.quality import require_passing, run_tests
from tierlake.operators.sequences import day_gap
from tierlake.plans.batch_tests import run_batch_tests
from tierlake.plans.bronze import bronze_full
from tierlake.plans.gold import publish_gold
from tierlake.plans.lake import ingest
from tierlake.plans.silver import build_silver, materialise, run_silver, state_day_gap_model, write_silver


def column(expression, target="", cast=""):
    return {"source_expr": expression, "target": target, "cast": cast}


def on(left, right):
    return {"lh": left, "rh": right}


@query(f"""
SELECT o.o_orderkey, c.c_name, n.n_name AS nation, o.o_totalprice * 2 AS double_price,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,1)) AS DOUBLE) AS price,
       strftime(o.o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE o.o_totalprice >= 1000 AND o.o_orderpriority LIKE '%-%' AND c.c_mktsegment <> 'BUILDING'
  AND n.n_name IS NOT NULL
""")
def silver_mapper(spark, sf):
    orders, customer, nation = (view(spark, sf, t) for t in ("orders", "customer", "nation"))
    return build_silver(spark, {
        "target_table": "orders_by_nation",
        "sources": [
            {"fqn": orders, "alias": "o"},
            {"fqn": customer, "alias": "c", "join_conds": [on("o.o_custkey", "c.c_custkey")]},
            {"fqn": nation, "alias": "n", "join_type": "left join",
             "join_conds": [on("n.n_nationkey", "c.c_nationkey")]},
        ],
        "columns": [
            column("o.o_orderkey"), column("c.c_name"), column("n.n_name", "nation"),
            column("o.o_totalprice * 2", "double_price"),
            column("o.o_totalprice", "price", "decimal(18,1)"), column("o.o_orderdate", "", "date"),
        ],
        "filters": [
            {"col": "o.o_totalprice", "op": ">=", "val": "1000"},
            {"col": "o.o_orderpriority", "op": "like", "val": "%-%"},
            {"col": "c.c_mktsegment", "op": "<>", "val": "BUILDING"},
            {"col": "n.n_name", "op": "is not null"}, {"col": "o.o_orderkey", "op": "=", "val": ""},
        ],
    })


def part_customer(how):
    def frame(spark, sf):
        part, customer = view(spark, sf, "part"), view(spark, sf, "customer")
        columns = [column("p.p_partkey"), column("p.p_name"), column("c.c_custkey"), column("c.c_name")]
        return build_silver(spark, {
            "sources": [{"fqn": part, "alias": "p"},
                        {"fqn": customer, "alias": "c", "join_type": how,
                         "join_conds": [on("c.c_custkey + 700", "p.p_partkey")]}],
            "columns": columns[:2] if "SEMI" in how or "ANTI" in how else columns,
        })
    return frame


for name, how in {"left": "LEFT JOIN", "right": "RIGHT OUTER JOIN", "full": "FULL OUTER JOIN"}.items():
    frame = part_customer(how)
    frame.__name__ = f"silver_join_{name}"
    query(f"SELECT p_partkey, p_name, c_custkey, c_name FROM part {how} customer "
          "ON c_custkey + 700 = p_partkey")(frame)
for name, test in {"semi": "", "anti": "NOT"}.items():
    frame = part_customer(f"LEFT {name.upper()} JOIN")
    frame.__name__ = f"silver_join_{name}"
    query(f"SELECT p_partkey, p_name FROM part WHERE {test} EXISTS "
          "(FROM customer WHERE c_custkey + 700 = p_partkey)")(frame)


@query("""
SELECT o.o_orderkey, c.c_custkey, c.c_name, p.p_partkey, s.s_suppkey
FROM orders o FULL JOIN customer c ON c.c_custkey + 200 = o.o_custkey
FULL JOIN part p ON p.p_partkey = c.c_custkey + 300 RIGHT JOIN supplier s ON s.s_suppkey = p.p_partkey
""")
def silver_full_then_full(spark, sf):
    views = {name: view(spark, sf, name) for name in ("orders", "customer", "part", "supplier")}

    def joined(name, alias, how, left, right):
        return {"fqn": views[name], "alias": alias, "join_type": how, "join_conds": [{"lh": left, "rh": right}]}

    return build_silver(spark, {
        "sources": [
            {"fqn": views["orders"], "alias": "o"},
            joined("customer", "c", "FULL JOIN", "o.o_custkey", "c.c_custkey + 200"),
            joined("part", "p", "FULL OUTER JOIN", "c.c_custkey + 300", "p.p_partkey"),
            joined("supplier", "s", "RIGHT JOIN", "p.p_partkey", "s.s_suppkey")],
        "columns": [{"source_expr": e} for e in (
            "o.o_orderkey", "c.c_custkey", "c.c_name", "p.p_partkey", "s.s_suppkey")],
    })


@query("""
SELECT l.l_orderkey, l.l_linenumber, o.o_orderkey, c.c_custkey, c.c_name
FROM orders o FULL JOIN lineitem l ON l.l_orderkey = o.o_orderkey + 5000
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""")
def silver_full_then_left(spark, sf):
    orders, lineitem, customer = (view(spark, sf, t) for t in ("orders", "lineitem", "customer"))
    return build_silver(spark, {
        "sources": [
            {"fqn": orders, "alias": "o"},
            {"fqn": lineitem, "alias": "l", "join_type": "FULL JOIN",
             "join_conds": [on("l.l_orderkey", "o.o_orderkey + 5000")]},
            {"fqn": customer, "alias": "c", "join_type": "LEFT JOIN",
             "join_conds": [on("c.c_custkey", "o.o_custkey")]},
        ],
        "columns": [column("l.l_orderkey"), column("l.l_linenumber"), column("o.o_orderkey"),
                    column("c.c_custkey"), column("c.c_name")],
    })


@query("""
SELECT a.event_id, b.value - a.value AS change, a.user_id
FROM events a JOIN events b ON a.event_id = b.event_id AND a.user_id = b.user_id
""")
def silver_self_join(spark, sf):
    sheet, space = contract(spark, EVENTS), layers(spark)
    ingest(spark, space, "events", load(spark, sf, "events"), sheet, "2024-01-31")
    fqn = f"spark_catalog.{space.lake}.events"
    return build_silver(spark, {
        "sources": [{"fqn": fqn, "alias": "a"},
                    {"fqn": fqn, "alias": "b",
                     "join_conds": [on("a.event_id", "b.event_id"), on("a.user_id", "b.user_id")]}],
        "columns": [column("a.event_id"), column("b.value - a.value", "change"), column("a.user_id")],
    })


@query(f"""
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
       strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') AS due,
       split_part(o_orderpriority, '-', 2) AS priority,
       regexp_replace(o_orderpriority, '[^0-9]', '', 'g') AS rank,
       nullif(o_orderstatus, 'P') AS status, coalesce(nullif(o_orderstatus, 'P'), 'none') AS shown,
       CASE WHEN o_totalprice > 100000 THEN 'large' ELSE 'small' END AS size,
       TRY_CAST(o_orderpriority AS INTEGER) AS bad, concat(o_orderstatus, ':', CAST(o_orderkey AS VARCHAR)) AS label,
       date_sub('day', o_orderdate, TIMESTAMP '2002-01-01') AS age,
       '1970-01-02 00:00:00' AS epoch, CAST(2 AS INTEGER) AS parts, 'x/y' AS joined
FROM orders
""")
def mapper_vocabulary(spark, sf):
    expressions = {
        "o_orderkey": "o_orderkey",
        "month": "date_format(date_trunc('month', o_orderdate), 'yyyy-MM-dd')",
        "ym": "date_format(o_orderdate, 'yyyy-MM')",
        "due": "date_format(date_add(to_date(o_orderdate), 3), 'yyyy-MM-dd')",
        "priority": "split_part(o_orderpriority, '-', 2)",
        "rank": "regexp_replace(o_orderpriority, '[^0-9]', '')",
        "status": "nullif(o_orderstatus, 'P')",
        "shown": "coalesce(nullif(o_orderstatus, 'P'), 'none')",
        "size": "if(o_totalprice > 100000, 'large', 'small')",
        "bad": "try_cast(o_orderpriority AS int)",
        "label": "concat(o_orderstatus, ':', o_orderkey)",
        "age": "timestampdiff(DAY, o_orderdate, timestamp_ntz'2002-01-01')",
        "epoch": "from_unixtime(86400)",
        "parts": "cardinality(split(o_orderpriority, '-'))",
        "joined": "array_join(array('x', element_at(array('y', 'z'), 1)), '/')",
    }
    return build_silver(spark, {
        "sources": [{"fqn": view(spark, sf, "orders")}],
        "columns": [column(expression, target) for target, expression in expressions.items()],
    })


@query(f"SELECT {ORDER_COLUMNS} FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1995-06-19'")
def date_scope_day(spark, sf):
    return date_scope(load(spark, sf, "orders"), "o_orderdate", "1995-06-19")


@query(f"""SELECT {ORDER_COLUMNS} FROM orders
WHERE o_orderdate IS NULL OR CAST(o_orderdate AS DATE) <> DATE '1995-06-19'""")
def date_scope_keep(spark, sf):
    return date_scope(load(spark, sf, "orders"), "o_orderdate", "1995-06-19", keep=True)


@query("""
SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def key_difference(spark, sf):
    returned = load(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_partkey"))
    return missing_keys(load(spark, sf, "lineitem"), returned, ["l_partkey"])


GAP = """date_sub('day', ts, lead(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id)) AS {name}"""


@query(f"SELECT event_id, user_id, {GAP.format(key='user_id', name='d_diff')} FROM events")
def silver_day_gap(spark, sf):
    events = load(spark, sf, "events").select("event_id", "user_id", "ts")
    return day_gap(events, "user_id", "ts", ["event_id"]).drop("ts")


@query(f"SELECT event_type AS s_fips, {GAP.format(key='event_type', name='d_diff')} FROM events")
def model_state_day_gap(spark, sf):
    events = load(spark, sf, "events")
    return state_day_gap_model(events.select(
        F.col("event_type").alias("state_fips"), F.col("ts").alias("date"), "event_id"))


def daily(df):
    return df.withColumn("snapshot_date", F.to_date("ts"))


DAY = "strftime({}, '%Y-%m-%d') AS snapshot_date"

# A replay of the last ten days: every event one day later with twice the value.
REPLAY = """SELECT event_id, ts, user_id, event_type, value * 2 AS value, props,
       CAST(ts AS DATE) + 1 AS snapshot_date FROM events WHERE ts >= TIMESTAMP '2024-01-20'"""


@query(f"""
SELECT {EVENT_COLUMNS}, {DAY.format('ts')} FROM events WHERE ts < TIMESTAMP '2024-01-20'
UNION ALL SELECT {EVENT_COLUMNS}, {DAY.format('snapshot_date')} FROM ({REPLAY})
""")
def silver_merge_key(spark, sf):
    # The event ids move to other dates; one of those dates is left without rows.
    events, space = load(spark, sf, "events"), layers(spark)
    replay = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).withColumns(
        {"value": F.col("value") * 2, "snapshot_date": F.date_add(F.to_date("ts"), 1)})
    for rows in (daily(events), replay, replay):
        write_silver(spark, space, "events", rows, "merge", keys=["event_id"])
    return tables.read(spark, space.resolve("events", "silver"))


@query(f"""
SELECT user_id, event_type, {DAY.format('d')}, CASE WHEN event_type = 'error' THEN v + 1 ELSE v END AS value FROM
 (SELECT user_id, event_type, CAST(ts AS DATE) AS d, value AS v FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)
""")
def silver_merge_composite(spark, sf):
    from tierlake.operators.snapshots import latest_per_key

    keys, space = ["user_id", "event_type", "snapshot_date"], layers(spark)
    rows = latest_per_key(daily(load(spark, sf, "events")), keys, "ts").select(*keys, "value")
    changed = rows.filter("event_type = 'error'").withColumn("value", F.col("value") + 1)
    for source in (rows, changed, changed):
        write_silver(spark, space, "daily", source, "merge", keys=keys)
    return tables.read(spark, space.resolve("daily", "silver"))


@query(f"""
SELECT {EVENT_COLUMNS}, {DAY.format('ts')} FROM events
WHERE CAST(ts AS DATE) <> DATE '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
UNION ALL SELECT {EVENT_COLUMNS}, {DAY.format('snapshot_date')} FROM
 (SELECT * REPLACE (-value AS value), CAST(ts AS DATE) AS snapshot_date FROM events WHERE ts >= TIMESTAMP '2024-01-20')
""")
def silver_insert_overwrite(spark, sf):
    events, space = daily(load(spark, sf, "events")), layers(spark)
    late = events.filter("snapshot_date >= DATE '2024-01-20'").withColumn("value", -F.col("value"))
    write_silver(spark, space, "events", events)
    for _ in range(2):
        write_silver(spark, space, "events", late, "insert_overwrite", delete_date="2024-01-05")
    return tables.read(spark, space.resolve("events", "silver"))


@query(f"""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) FROM lineitem
""")
def silver_overwrite_append(spark, sf):
    space = layers(spark)
    spec = {
        "target_table": "net_lines", "strategy": "overwrite",
        "sources": [{"fqn": view(spark, sf, "lineitem"), "alias": "l"}],
        "columns": [column("l.l_orderkey"), column("l.l_linenumber"),
                    column("l.l_extendedprice * (1 - l.l_discount)", "net")],
    }
    for strategy in ("overwrite", "overwrite", "append"):
        run_silver(spark, space, spec | {"strategy": strategy},
                   tests=[{"test": "not_null", "column": "net"}])
    return tables.read(spark, space.resolve("net_lines", "silver"))


@query(f"""
SELECT user_id, event_type, value * 2 AS doubled FROM
 (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1)
""")
def silver_snapshot_spec(spark, sf):
    sheet, space = contract(spark, EVENTS), layers(spark)
    ingest(spark, space, "events", load(spark, sf, "events"), sheet, "2024-01-31")
    bronze_full(spark, space, "events", "2024-01-31", sheet)
    spec = {
        "target_table": "events", "strategy": "insert_overwrite",
        "sources": [{"fqn": f"{space.bronze}.events", "alias": "b", "snapshot_date": True}],
        "columns": [column("b.user_id"), column("b.event_type"), column("b.value * 2", "doubled"),
                    column("b.snapshot_date")],
    }
    for _ in range(2):
        run_silver(spark, space, spec, "2024-01-31")
    return tables.read(spark, space.resolve("events", "silver")).drop("snapshot_date")


@query("SELECT * FROM region")
def silver_view_and_mart(spark, sf):
    space = layers(spark)
    materialise(spark, space, "stg_region", load(spark, sf, "region"), "view")
    materialise(spark, space, "mart_region", spark.table("stg_region"))
    return tables.read(spark, space.resolve("mart_region", "silver"))


@query("""
SELECT 'not_null' AS test, 'l_orderkey' AS "column", count_if(l_orderkey IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'accepted_values', 'l_returnflag', count_if(l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'unique', 'l_orderkey', count(*) FROM (FROM lineitem SELECT l_orderkey
   WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'unique_combination', 'l_orderkey,l_linenumber', count(*) FROM (FROM lineitem
   SELECT l_orderkey, l_linenumber GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'l_partkey', count(*) FROM (FROM lineitem SELECT l_partkey
   WHERE l_partkey IS NOT NULL GROUP BY l_partkey HAVING count(*) > 1)
""")
def quality_report(spark, sf):
    return run_tests(load(spark, sf, "lineitem"), [
        {"test": "not_null", "column": "l_orderkey"},
        {"test": "accepted_values", "column": "l_returnflag", "values": ["A", "N"]},
        {"test": "unique", "column": "l_orderkey"},
        {"test": "unique_combination", "columns": ["l_orderkey", "l_linenumber"]},
        {"test": "unique", "column": "l_partkey"},
    ])


@query("""
SELECT 'not_null' AS test, 'quality' AS "column", count_if(quality IS NULL) AS violations FROM labels
UNION ALL SELECT 'accepted_values', 'quality', count_if(quality NOT IN (0, 1)) FROM labels
UNION ALL SELECT 'accepted_values', 'toxic', count_if(toxic NOT IN (0)) FROM labels
UNION ALL SELECT 'unique', 'doc_id', count(*) FROM (FROM labels SELECT doc_id GROUP BY doc_id HAVING count(*) > 1)
""")
def quality_labels(spark, sf):
    return run_tests(load(spark, sf, "labels"), [
        {"test": "not_null", "column": "quality"},
        {"test": "accepted_values", "column": "quality", "values": [0, 1]},
        {"test": "accepted_values", "column": "toxic", "values": [0]},
        {"test": "unique", "column": "doc_id"},
    ])


@query("""
WITH late AS (SELECT event_id, event_type, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-25'),
 again AS (SELECT event_id, event_type, user_id, value FROM events WHERE ts < TIMESTAMP '2024-01-05' AND event_id % 11 = 0),
 twice AS (SELECT event_id, upper(event_type), user_id, value FROM late WHERE event_id % 7 = 0),
 whole AS (SELECT event_id, event_type, user_id, value FROM events UNION ALL FROM again UNION ALL FROM twice)
SELECT 'not_null' AS test, 'user_id' AS "column", count_if(user_id IS NULL) AS violations FROM whole
UNION ALL SELECT 'accepted_values', 'event_type',
 count_if(event_type NOT IN (SELECT DISTINCT event_type FROM events)) FROM whole
UNION ALL SELECT 'unique', 'event_id', count(*) FROM (FROM whole SELECT event_id
   WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1)
UNION ALL SELECT 'unique_combination', 'event_id,event_type', count(*) FROM (FROM whole SELECT event_id, event_type
   GROUP BY ALL HAVING count(*) > 1)
""")
def silver_batch_tests(spark, sf):
    # An append that brings ids of the first days again and some of its own twice, tested without the history between.
    space, events = layers(spark), daily(load(spark, sf, "events"))
    kinds = [row[0] for row in events.select("event_type").distinct().collect()]
    late = F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")
    again = events.filter((F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz")) & (F.col("event_id") % 11 == 0)).withColumn(
        "snapshot_date", F.lit("2024-01-31").cast("date"))
    twice = events.filter(late & (F.col("event_id") % 7 == 0)).withColumn("event_type", F.upper("event_type"))
    batch = events.filter(late).unionByName(again).unionByName(twice)
    tests = [{"test": "not_null", "column": "user_id"}, {"test": "accepted_values", "column": "event_type", "values": kinds},
             {"test": "unique", "column": "event_id"}, {"test": "unique_combination", "columns": ["event_id", "event_type"]}]
    table = space.resolve("events", "silver")
    write_silver(spark, space, "events", events.filter(~late))
    # A first batch without rows builds the indexes, as the tests of an earlier run have done.
    require_passing(run_batch_tests(spark, table, events.limit(0), tests))
    write_silver(spark, space, "events", batch, "append", keep_index=True)
    return run_batch_tests(spark, table, batch, tests)


@query("""
SELECT l_orderkey, l_linenumber, CASE kind WHEN 1 THEN 'lost' WHEN 2 THEN 'doubled' ELSE 'changed' END AS status,
       CASE kind WHEN 2 THEN 0 ELSE n END AS missing, CASE kind WHEN 1 THEN 0 ELSE n END AS extra
FROM (SELECT l_orderkey, l_linenumber, l_orderkey % 7 AS kind, count(*) AS n FROM lineitem
      WHERE l_orderkey % 7 IN (1, 2, 3) AND l_partkey % 50 = 0 GROUP BY ALL)
UNION ALL SELECT l_orderkey + 1000000000, l_linenumber, 'added', 0, n
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_partkey % 900 = 0 GROUP BY ALL)
""")
def reconcile_rows(spark, sf):
    # A copy of a table in which some rows were lost, doubled, changed and added.
    lines = load(spark, sf, "lineitem")
    kind, hit = F.col("l_orderkey") % 7, F.col("l_partkey") % 50 == 0
    copy = lines.filter(~(hit & (kind == 1))).withColumn(
        "l_shipdate", F.when(hit & (kind == 3), F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("l_shipdate")))
    new = lines.filter("l_partkey % 900 = 0").withColumn("l_orderkey", F.col("l_orderkey") + 1000000000)
    copy = copy.unionByName(lines.filter(hit & (kind == 2))).unionByName(new)
    return differing_rows(lines, copy, ["l_orderkey", "l_linenumber"])


@query(f"SELECT {EVENT_COLUMNS}, {DAY.format('ts')} FROM events")
def silver_verified_writes(spark, sf):
    # Every way to write, with the values of what was written compared by checksums.
    space, events = layers(spark), daily(load(spark, sf, "events"))
    early = F.col("snapshot_date") < F.lit("2024-01-10").cast("date")
    wrong = events.withColumn("value", F.lit(0.0))
    write_silver(spark, space, "events", events.filter(~early), verify="values")
    write_silver(spark, space, "events", wrong.filter(early), "append", verify="values")
    write_silver(spark, space, "events", wrong.filter("snapshot_date >= DATE '2024-01-25'"), "insert_overwrite", verify="values")
    write_silver(spark, space, "events", events, "merge", keys=["event_id"], verify="values")
    publish_gold(spark, space, "events", "events", verify="values")
    return tables.read(spark, space.resolve("events", "gold"))
