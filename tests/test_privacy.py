import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake.functions.privacy import Keys, decrypt, encrypt, hmac_sha256, mask, protect

VALUES = ["", "a", "plain", "zażółć", "日本", "with|pipe", "x" * 5000, None]
KEY = bytes(range(32))


@pytest.mark.parametrize("key", [b"short", b"k" * 64, b"k" * 65, "sól".encode()])
def test_hash_equals_the_standard_library(spark, key):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string").select("v", hmac_sha256("v", key).alias("h"))
    for row in df.collect():
        expected = None if row.v is None else hmac.new(key, row.v.encode(), hashlib.sha256).hexdigest()
        assert row.h == expected


def test_hash_of_a_number(spark):
    got = spark.range(42, 43).select(hmac_sha256("id", b"k")).first()[0]
    assert got == hmac.new(b"k", b"42", hashlib.sha256).hexdigest()


def test_encryption_round_trip(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string").withColumn("c", encrypt("v", KEY, "s1", "s2")).cache()
    assert rows(df.select("v", decrypt("c", KEY).alias("d")).filter("NOT v <=> d")) == []
    sealed = df.filter("v = 'plain'").first().c
    plain = spark.range(1).select(F.expr(f"string(aes_decrypt(unbase64('{sealed}'), X'{KEY.hex()}', 'GCM'))")).first()[0]
    assert plain == f"{hashlib.sha256(b's1').hexdigest()}|{hashlib.md5(b's2').hexdigest()}|plain"
    with pytest.raises(Exception, match="INVALID_PARAMETER_VALUE.AES_CRYPTO_ERROR"):
        df.filter("v = 'plain'").select(decrypt("c", bytes(32))).collect()


def test_mask(spark):
    df = spark.createDataFrame([(v,) for v in ("", "abcd", "abcde", "abcdefgh", None)], "v string")
    assert [r[0] for r in df.select(mask("v")).collect()] == ["****", "****", "ab*de", "ab****gh", None]


def test_protect(spark, sheet):
    df = spark.createDataFrame([(1, "Ann", "x@y.z", "secret", "open")], "id int, name string, mail string, pin string, note string")
    contract = sheet([(c, "string") for c in df.columns] + [("absent", "string")],
                     levels={"name": "HASH", "mail": "pii", "pin": "mask", "note": "none", "absent": "hash"})
    keys = Keys("a good salt", "a second salt", KEY)
    row = protect(df, contract, keys).first()
    assert row.name == hmac.new(b"a good salt", b"Ann", hashlib.sha256).hexdigest()
    assert row.pin == "se**et" and row.note == "open" and row.id == 1
    assert protect(df, contract, keys).select(decrypt("mail", KEY)).first()[0] == "x@y.z"
    for bad in (Keys(), Keys("REQUIRED_X"), Keys("change-me-please"), Keys("ok"), Keys("ok", "REQUIRED_2", KEY),
                Keys("ok", "ok", b"short")):
        with pytest.raises(ValueError):
            protect(df, contract, bad)
    plan = protect(df, contract, keys)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert protect(df, sheet([("id", "int")])).collect() == df.collect()
