from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from tierlake import Contract


def frame(spark, *lines):
    names = lines[0].split(",")
    return spark.createDataFrame([tuple(v or None for v in line.split(",")) for line in lines[1:]],
                                 ", ".join(f"{n} string" for n in names))


def test_load_trims_and_reads_flags(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("column_name,datatype,security_level,primary_key,is_timestamp,data_length,data_precision\n"
                    " id , BIGINT ,, Yes ,,,\nprice,decimal,Hash,n,,18,4\nseen,Timestamp,,,TRUE,,\n"
                    "later,timestamp,,,1,,\nkind,string, PII ,1,,,\n")
    contract = Contract.load(spark, str(path))
    assert contract.names == ["id", "price", "seen", "later", "kind"]
    assert contract.keys == ["id", "kind"]
    assert contract.order_by == "seen"
    assert [f.level for f in contract.fields] == ["none", "hash", "none", "none", "pii"]
    assert contract.data_type(contract.fields[1]) == T.DecimalType(18, 4)


def test_blank_duplicate_and_missing_columns(spark, sheet):
    with pytest.raises(ValueError, match="names no column"):
        Contract.from_frame(frame(spark, "column_name,datatype", " ,string"))
    with pytest.raises(ValueError, match="defines 'id' again|defines 'ID' again"):
        Contract.from_frame(frame(spark, "column_name,datatype", "id,string", " ID,int"))
    with pytest.raises(ValueError, match="unknown security level 'hsah'"):
        sheet([("id", "int")], levels={"id": "hsah"})
    with pytest.raises(ValueError, match="no column 'datatype'"):
        Contract.from_frame(frame(spark, "column_name,kind", "id,string"))


@pytest.mark.parametrize("name, text, value", [
    ("string", "x", "x"), ("str", "x", "x"), ("varchar", "x", "x"), ("text", "x", "x"), ("char", "x", "x"),
    ("integer", "7", 7), ("int", "7", 7), ("smallint", "70000", 70000), ("bigint", "9999999999", 9999999999),
    ("long", "7", 7), ("double", "1.5", 1.5), ("numeric", "1.5", 1.5), ("float", "1.5", 1.5), ("real", "1.5", 1.5),
    ("boolean", "Y", True), ("bool", "1", True), ("date", "2026-10-21", date(2026, 10, 21)),
    ("timestamp", "2026-10-21 04:00:00", datetime(2026, 10, 21, 4)),
    ("datetime", "2026-10-21T04:00:00Z", datetime(2026, 10, 21, 4)), ("decimal", "1.5", 1.5),
])
def test_every_type(spark, sheet, name, text, value):
    contract = sheet([("v", name)])
    got = contract.cast(spark.createDataFrame([(text,), (None,)], "v string")).collect()
    if isinstance(value, datetime):
        assert str(got[0][0]) == str(value)
    else:
        assert got[0][0] == value
    assert got[1][0] is None


def test_decimal_rules(spark, sheet):
    sized = sheet([("v", "decimal")], sizes={"v": ("5", "2")})
    data = spark.createDataFrame([("1.005",)], "v string")
    assert sized.cast(data).first()[0] == Decimal("1.01")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        sized.cast(spark.createDataFrame([("12345.6",)], "v string")).collect()
    bare = Contract.from_frame(frame(spark, "column_name,datatype,data_length", "v,decimal,5"))
    with pytest.raises(ValueError, match="unknown type 'decimal'"):
        bare.cast(data)
    with pytest.raises(ValueError, match="unknown type 'interval'"):
        sheet([("v", "interval")]).cast(data)


def test_bad_value_fails_the_job_and_is_reported(spark, sheet):
    contract = sheet([("n", "int"), ("d", "date")])
    data = spark.createDataFrame([("1", "2026-01-01"), ("x", "2026-01-02"), (None, "soon")], "n string, d string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        contract.cast(data).collect()
    assert rows(contract.cast_report(data)) == [("d", "date", 1), ("n", "int", 1)]
    good, bad = contract.split(data)
    assert rows(good) == [(1, date(2026, 1, 1))]
    assert rows(bad) == [(None, "soon"), ("x", "2026-01-02")]


def test_cast_leaves_other_columns(spark, sheet):
    data = spark.createDataFrame([("1", "2")], "a string, b string")
    assert sheet([("a", "int"), ("absent", "int")]).cast(data).dtypes == [("a", "int"), ("b", "string")]


def test_column_check(spark, sheet):
    contract = sheet([("id", "int"), ("name", "string")])
    contract.check(spark.createDataFrame([("1", "2")], "name string, id string"))
    with pytest.raises(ValueError, match="'other' is not declared; 'name' is absent"):
        contract.check(spark.createDataFrame([("1", "2")], "id string, other string"))
    with pytest.raises(ValueError, match="'Name' must be written 'name'"):
        contract.check(spark.createDataFrame([("1", "2")], "id string, Name string"))
