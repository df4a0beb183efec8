"""Warehouse types, statements and the all-or-nothing load, with a recording connection.

No database is started: the connection and the staging writer are stand-ins.
"""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tierlake.plans.export import (
    converted, create_statement, ddl_type, export_jdbc, load_statements, staging_options)


@pytest.mark.parametrize("source, target", [
    ("timestamp(6) with time zone", "TIMESTAMP(6) WITH TIME ZONE"), ("timestamp", "TIMESTAMP(6)"),
    ("timestamp(3)", "TIMESTAMP(3)"), ("decimal(38,18)", "NUMBER(38,18)"), ("decimal(10, 2)", "NUMBER(10,2)"),
    ("varchar", "CLOB"), ("varchar(9000)", "CLOB"), ("varchar(36)", "VARCHAR2(36 CHAR)"),
    ("varchar(4000)", "VARCHAR2(4000 CHAR)"), ("char", "CHAR(255 CHAR)"), ("char(2001)", "CLOB"), ("char(9)", "CHAR(9 CHAR)"),
    ("varbinary", "BLOB"), ("boolean", "NUMBER(1)"), ("tinyint", "NUMBER(19)"), ("bigint", "NUMBER(19)"),
    ("real", "BINARY_DOUBLE"), ("double", "BINARY_DOUBLE"), ("date", "DATE"), ("time(3)", "VARCHAR2(64)"),
    ("time with time zone", "VARCHAR2(64)"), ("uuid", "VARCHAR2(36)"), ("json", "CLOB"),
])
def test_types(source, target):
    assert ddl_type(source) == target


@pytest.mark.parametrize("source", ["array(varchar)", "map(varchar,int)", "decimal(39,0)", "decimal(5,6)", "decimal", "row(x int)"])
def test_unsupported_types(source):
    with pytest.raises(ValueError, match="has no type"):
        ddl_type(source)


def test_spark_types(spark):
    df = spark.sql("SELECT 1 AS i, true AS b, timestamp'2026-01-01' AS t, timestamp_ntz'2026-01-01' AS n, "
                   "X'00' AS x, 1.5BD AS d, parse_json('{\"a\":1}') AS v, 'x' AS s")
    assert create_statement(df, "dw.t").sql == (
        'CREATE TABLE dw.t ("I" NUMBER(19), "B" NUMBER(1), "T" TIMESTAMP(6) WITH TIME ZONE, "N" TIMESTAMP(6), '
        '"X" BLOB, "D" NUMBER(2,1), "V" CLOB, "S" CLOB)')
    row = converted(df).first()
    assert (row.B, row.V, row.I) == (1, '{"a":1}', 1)
    with pytest.raises(ValueError, match="has no type"):
        create_statement(spark.sql("SELECT array(1) AS a"), "t")
    with pytest.raises(ValueError, match="apart"):
        converted(spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "A"))
    with pytest.raises(ValueError):
        create_statement(df, "a.b.c")


def test_statements():
    def sql(*args):
        return [s.sql for s in load_statements(["A", "D"], "dw.t", "dw.s", *args)]

    insert = 'INSERT INTO dw.t ("A", "D") SELECT "A", "D" FROM dw.s'
    assert sql("append") == [insert]
    assert sql("truncate") == ["DELETE FROM dw.t", insert]
    assert sql("delete_and_insert", "d", "2026-10-21") == ['DELETE FROM dw.t WHERE "D" >= ? AND "D" < ?', insert]
    scope = load_statements(["A"], "t", "s", "delete_and_insert", "d", "2026-10-31")[0]
    assert scope.days == (date(2026, 10, 31), date(2026, 11, 1))
    for bad in (("merge",), ("delete_and_insert",), ("delete_and_insert", "d"), ("delete_and_insert", "d x", "2026-10-21")):
        with pytest.raises(ValueError):
            sql(*bad)


class Recorder:
    """Stands in for a JDBC connection: keeps the statements in order."""

    def __init__(self, staged, fail_on=None, present=True):
        self.log, self.staged, self.fail_on, self.present = [], staged, fail_on, present

    def _run(self, sql):
        if self.fail_on and self.fail_on in sql:
            raise RuntimeError(sql)
        self.log.append(sql.split(" (")[0])

    def setAutoCommit(self, on):
        self.log.append(f"auto={on}")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")

    def createStatement(self):
        return self

    def prepareStatement(self, sql):
        recorder = self

        class Prepared:
            def setDate(self, position, value):
                recorder.log.append(f"{position}={value}")

            def executeUpdate(self):
                recorder._run(sql)

            def close(self):
                pass

        return Prepared()

    execute = _run

    def executeQuery(self, sql):
        return self

    def getMetaData(self):
        return self

    def getTables(self, *names):
        assert names == (None, "DW", "T", None)
        self.listed = self.present
        return self

    def next(self):
        listed, self.listed = getattr(self, "listed", True), True
        return listed

    def getLong(self, _):
        return self.staged[0]


def export(spark, df, strategy, *args, fail_on=None, present=True, lose=0):
    staged = [0]
    recorder = Recorder(staged, fail_on, present)

    def stage(rows, options, table):
        rows.write.format("noop").mode("overwrite").save()
        staged[0] = rows.count() - lose

    try:
        count = export_jdbc(spark, df, {"url": "jdbc:x"}, "dw.t", strategy, *args, connect=lambda *_: recorder, stage=stage)
    except Exception as exc:
        return exc, recorder.log
    return count, recorder.log


@pytest.fixture
def data(spark):
    return spark.createDataFrame([(1, date(2026, 10, 21)), (2, date(2026, 10, 22))], "id int, day date")


def kinds(log):
    return [" ".join(entry.split()[:2]) for entry in log if entry != "close"]


def test_replacement_is_one_transaction(spark, data):
    count, log = export(spark, data, "truncate", present=False)
    assert count == 2
    assert kinds(log) == ["CREATE TABLE", "CREATE TABLE", "auto=False", "DELETE FROM", "INSERT INTO", "commit",
                          "auto=True", "DROP TABLE"]


def test_one_day(spark, data):
    count, log = export(spark, data, "delete_and_insert", "DAY", "2026-10-21")
    assert count == 1
    assert log[log.index("auto=False") + 1:][:3] == ["1=2026-10-21", "2=2026-10-22", 'DELETE FROM dw.t WHERE "DAY" >= ? AND "DAY" < ?']


def test_failures_roll_back(spark, data):
    error, log = export(spark, data, "truncate", fail_on="INSERT")
    assert isinstance(error, RuntimeError)
    assert kinds(log)[-4:] == ["DELETE FROM", "rollback", "auto=True", "DROP TABLE"] and "commit" not in log
    error, log = export(spark, data, "append", lose=1)
    assert "Staged 1 rows of 2" in str(error)
    assert "auto=False" not in log and kinds(log)[-1] == "DROP TABLE"
    error, log = export(spark, data.withColumn("x", F.array("id")), "append")
    assert isinstance(error, ValueError) and log == []


def test_staging_options():
    assert staging_options({"url": "u"}, "s") == {
        "url": "u", "batchsize": "5000", "numPartitions": "16", "dbtable": "s"}
    assert staging_options({"url": "u", "batchsize": "10"}, "s")["batchsize"] == "10"
