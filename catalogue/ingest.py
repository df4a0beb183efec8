"""Sources, contract, protection and the Lake."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import EVENT_COLUMNS, ORDER_COLUMNS, EVENTS, contract, layers, load, query, stamp
from tierlake import tables
from tierlake.functions.privacy import Keys, decrypt, hmac_sha256, mask, protect
from tierlake.operators.quality import duplicate_names
from tierlake.plans.lake import ingest, prepare
from tierlake.plans.quarantine import ingest_checked
from tierlake.session import workspace
from tierlake.sources.files import read_files, resolve_dated_file

LINEITEM = """
l_orderkey bigint
l_partkey long
l_suppkey integer
l_linenumber smallint
l_quantity numeric
l_extendedprice decimal 18,2
l_discount decimal
l_tax float
l_returnflag char
l_linestatus varchar
l_shipdate date
"""

CUSTOMER = """
c_custkey bigint key
c_name string
c_nationkey int
c_acctbal double
c_mktsegment string
"""


def as_text(df):
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


@query("""
SELECT l_orderkey, l_partkey, CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, l_quantity,
       l_extendedprice, l_discount, CAST(round(l_tax, 2) AS DOUBLE) AS l_tax, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
""")
def contract_cast(spark, sf):
    rows = prepare(as_text(load(spark, sf, "lineitem")), contract(spark, LINEITEM))
    # A float has no short decimal form of its own in every engine.
    return rows.withColumn("l_tax", F.round(F.col("l_tax").cast("double"), 2))


@query("""
SELECT 'c_custkey' AS "column", 'bigint' AS datatype, CAST(0 AS BIGINT) AS failures
UNION ALL SELECT 'c_name', 'int', count_if(TRY_CAST(c_name AS INTEGER) IS NULL) FROM customer
UNION ALL SELECT 'c_nationkey', 'int', 0
UNION ALL SELECT 'c_acctbal', 'int', count_if(TRY_CAST(CAST(c_acctbal AS VARCHAR) AS INTEGER) IS NULL
          OR contains(CAST(c_acctbal AS VARCHAR), '.')) FROM customer
UNION ALL SELECT 'c_mktsegment', 'string', 0
""")
def contract_cast_report(spark, sf):
    wrong = contract(spark, CUSTOMER.replace("c_name string", "c_name int")
                     .replace("c_acctbal double", "c_acctbal int"))
    return wrong.cast_report(as_text(load(spark, sf, "customer")))


@query("SELECT * FROM customer")
def csv_dated_scan(spark, sf):
    folder = workspace(spark, "csv")
    load(spark, sf, "customer").write.option("header", True).csv(f"{folder}/customer__2024-01-15.csv")
    found = resolve_dated_file(spark, f"{folder}/customer__YYYY-MM-DD.csv", "2024-01-15")
    sheet = contract(spark, CUSTOMER)
    return prepare(read_files(spark, found, sheet), sheet)


@query("SELECT * FROM customer")
def csv_glob_reordered(spark, sf):
    # Two kinds of files under one glob, with other orders of columns.
    folder, customer = workspace(spark, "csv"), load(spark, sf, "customer")
    for part, columns in enumerate((customer.columns, customer.columns[::-1])):
        half = customer.filter(F.col("c_custkey") % 2 == part).select(*columns)
        half.write.option("header", True).csv(f"{folder}/part={part}")
    sheet = contract(spark, CUSTOMER)
    return prepare(read_files(spark, f"{folder}/part=*/*.csv", sheet), sheet)


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def json_glob_scan(spark, sf):
    folder = workspace(spark, "json")
    orders = load(spark, sf, "orders")
    orders.withColumn("status", F.col("o_orderstatus")).write.partitionBy("status").json(
        f"{folder}/day=2024-01-15")
    found = resolve_dated_file(spark, f"{folder}/day=YYYY-MM-DD/status=*/*.json", "2024-01-15")
    sheet = contract(spark, """
        o_orderkey bigint
        o_custkey bigint
        o_orderstatus string
        o_totalprice double
        o_orderdate timestamp
        o_orderpriority string
    """)
    return prepare(read_files(spark, found, sheet), sheet)


@query("SELECT * FROM supplier")
def parquet_scan(spark, sf):
    return read_files(spark, f"{sf}/supplier.parquet")


@query("SELECT lower(trim(p_name)) AS name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_name_report(spark, sf):
    return duplicate_names(load(spark, sf, "part"), "p_name")


SALT = "a-test-salt-of-some-length"
INNER, OUTER = (bytes(b ^ x for b in SALT.encode().ljust(64, b"\0")).hex() for x in (0x36, 0x5C))


def hmac_sql(column: str) -> str:
    return (f"sha256(unhex('{OUTER}') || unhex(sha256(unhex('{INNER}') || encode({column}))))")


@query(f"SELECT c_custkey, {hmac_sql('c_name')} AS c_name FROM customer")
def pii_hash(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", hmac_sha256("c_name", SALT.encode()).alias("c_name"))


@query(f"SELECT doc_id, {hmac_sql('text')} AS text FROM documents")
def pii_hash_text(spark, sf):
    return load(spark, sf, "documents").select("doc_id", hmac_sha256("text", SALT.encode()).alias("text"))


@query("""
SELECT c_custkey, CASE WHEN length(c_mktsegment) <= 4 THEN '****'
       ELSE left(c_mktsegment, 2) || repeat('*', length(c_mktsegment) - 4) || right(c_mktsegment, 2) END AS masked,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) <= 4 THEN '****'
       ELSE left(CAST(c_custkey AS VARCHAR), 2) || repeat('*', length(CAST(c_custkey AS VARCHAR)) - 4)
            || right(CAST(c_custkey AS VARCHAR), 2) END AS masked_key
FROM customer
""")
def pii_mask(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", mask("c_mktsegment").alias("masked"), mask("c_custkey").alias("masked_key"))


@query("SELECT c_custkey, c_name, c_mktsegment, true AS sealed FROM customer")
def pii_roundtrip(spark, sf):
    keys = Keys(SALT, "another-test-salt", b"0123456789abcdef0123456789abcdef")
    customer = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    sheet = contract(spark, "c_custkey bigint\nc_name string pii\nc_mktsegment string")
    sealed = protect(customer, sheet, keys)
    return sealed.select(
        "c_custkey", decrypt("c_name", keys.cipher).alias("c_name"), "c_mktsegment",
        (~F.col("c_name").contains("Customer")).alias("sealed"))


@query(f"""
SELECT c_custkey, {hmac_sql('c_name')} AS c_name, c_nationkey, c_acctbal,
       left(c_mktsegment, 2) || repeat('*', length(c_mktsegment) - 4) || right(c_mktsegment, 2) AS c_mktsegment,
       '2024-01-15' AS ingest_date
FROM customer
""")
def lake_protected(spark, sf):
    sheet = contract(spark, CUSTOMER.replace("c_name string", "c_name string hash")
                     .replace("c_mktsegment string", "c_mktsegment string mask"))
    space = layers(spark)
    ingest(spark, space, "customer", as_text(load(spark, sf, "customer")), sheet, "2024-01-15",
           keys=Keys(SALT))
    return tables.read(spark, space.resolve("customer", "lake"))


@query(f"""
SELECT {EVENT_COLUMNS}, '2024-01-15' AS ingest_date FROM events
UNION ALL SELECT {EVENT_COLUMNS}, '2024-01-15' FROM events
UNION ALL SELECT {EVENT_COLUMNS}, '2024-01-16' FROM events
""")
def lake_append(spark, sf):
    events, sheet, space = load(spark, sf, "events"), contract(spark, EVENTS), layers(spark)
    for day in ("2024-01-15", "2024-01-15", "2024-01-16"):
        ingest(spark, space, "events", events, sheet, day, "append")
    return tables.read(spark, space.resolve("events", "lake"))


@query(f"""
SELECT {EVENT_COLUMNS}, 'west' AS site, '2024-01-15' AS ingest_date FROM events
UNION ALL SELECT {EVENT_COLUMNS}, 'east', '2024-01-15' FROM events
""")
def lake_overwrite(spark, sf):
    events, sheet, space = load(spark, sf, "events"), contract(spark, EVENTS), layers(spark)
    for site in ("west", "east", "west"):
        ingest(spark, space, "events", events, sheet, "2024-01-15", extra_partitions={"site": site})
    return tables.read(spark, space.resolve("events", "lake"))


@query(f"SELECT o_orderkey, {stamp('o_orderdate')} AS o_orderdate, '2024-01-16' AS ingest_date FROM orders")
def lake_replace(spark, sf):
    orders, space = load(spark, sf, "orders"), layers(spark)
    wide = contract(spark, "o_orderkey bigint\no_orderdate timestamp\no_orderstatus string")
    slim = contract(spark, "o_orderkey bigint\no_orderdate timestamp")
    ingest(spark, space, "orders", orders.select(*wide.names), wide, "2024-01-15")
    ingest(spark, space, "orders", orders.select(*slim.names), slim, "2024-01-16", "replace")
    return tables.read(spark, space.resolve("orders", "lake"))


# A line of four cells; of five rows one has a cell that is no number, one a cell too many, one a cell too few.
ODD_USER = "CASE WHEN event_id % 5 = 1 THEN 'x' ELSE '' END || coalesce(CAST(user_id AS {text}), '')"


@query(f"""
WITH lines AS (SELECT event_id, event_type, {ODD_USER.format(text='VARCHAR')} AS cell,
  CASE WHEN event_id % 10 = 1 THEN 'never' ELSE {stamp('ts')} END AS moment FROM events),
texts AS (SELECT *, event_id || ',' || moment || ',' || event_type || ',' || cell AS line FROM lines)
SELECT event_id, NULL AS reason, NULL AS "column", NULL AS value FROM texts WHERE event_id % 5 IN (0, 4)
UNION ALL SELECT event_id, 'uncastable', 'user_id', cell FROM texts WHERE event_id % 5 = 1
UNION ALL SELECT event_id, 'uncastable', 'ts', 'never' FROM texts WHERE event_id % 10 = 1
UNION ALL SELECT NULL, 'ragged', NULL, line || ',more' FROM texts WHERE event_id % 5 = 2
UNION ALL SELECT NULL, 'ragged', NULL, event_id || ',' || moment FROM texts WHERE event_id % 5 = 3
""")
def quarantine_faults(spark, sf):
    # CSV files with planted faults; a row for each good row, each faulty cell and each ragged line.
    folder, space = workspace(spark, "quarantine"), layers(spark)
    sheet = contract(spark, "event_id bigint key\nts timestamp\nevent_type string\nuser_id bigint")
    moment = F.expr("CASE WHEN event_id % 10 = 1 THEN 'never' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') END")
    cells = [F.col("event_id").cast("string"), moment, F.col("event_type"), F.expr(ODD_USER.format(text="STRING"))]
    kind = F.col("event_id") % 5
    line = F.when(kind == 2, F.concat_ws(",", *cells, F.lit("more"))).when(
        kind == 3, F.concat_ws(",", *cells[:2])).otherwise(F.concat_ws(",", *cells))
    # The name of the only column is the header, and the line its only cell.
    lines = load(spark, sf, "events").select(line.alias("event_id,ts,event_type,user_id"))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(f"{folder}/events")
    ingest_checked(spark, space, "events", f"{folder}/events/*.csv", sheet, "2024-01-31")
    good = tables.read(spark, space.resolve("events", "lake")).select("event_id")
    bad = tables.read(spark, space.resolve("events_quarantine", "lake")).filter("file LIKE '%.csv'")
    cells = bad.select("reason", "row", F.explode("faults").alias("cell")).select(
        F.get_json_object("row", "$.event_id").cast("bigint").alias("event_id"), "reason", "cell.*")
    ragged = bad.filter("reason = 'ragged'").select("reason", F.col("row").alias("value"))
    return good.unionByName(cells, True).unionByName(ragged, True)
