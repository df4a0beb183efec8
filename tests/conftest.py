import os
import sys
import tempfile
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierlake import Layers, configure  # noqa: E402
from tierlake.session import workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def layers(spark):
    mark = uuid.uuid4().hex[:8]
    return Layers(*(f"{name}_{mark}" for name in ("lake", "bronze", "silver", "gold", "audit")),
                  root=workspace(spark, "tests"))


@pytest.fixture
def sheet(spark):
    """A contract from ``(name, type)`` rows; keys and the time column by name."""
    from tierlake import Contract

    def make(columns, keys=(), time=None, levels=None, sizes=None):
        rows = [
            (name, kind, (levels or {}).get(name), "Y" if name in keys else None,
             "yes" if name == time else "", *(sizes or {}).get(name, (None, None)))
            for name, kind in columns
        ]
        schema = ("column_name string, datatype string, security_level string, primary_key string, "
                  "is_timestamp string, data_length string, data_precision string")
        return Contract.from_frame(spark.createDataFrame(rows, schema))

    return make


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    found = [tuple(row) for row in (df.select(*order) if order else df).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
