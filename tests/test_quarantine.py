"""Faulty rows set apart with file, reason and cells."""

import pytest

from tests.conftest import rows
from tierlake import tables
from tierlake.plans.quarantine import ingest_checked, split_rows, tag_rows

COLUMNS = [("id", "bigint"), ("name", "string"), ("day", "date")]


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        kind = "json" if text.startswith("{") else "csv"
        (folder / f"{name}.{kind}").write_text(text)


def found(df):
    return sorted((r.file.rpartition("/")[2], r.reason, [tuple(f) for f in r.faults], r.row) for r in df.collect())


def test_csv_faults_name_file_and_cells(spark, tmp_path, layers, sheet):
    contract = sheet(COLUMNS, ["id"])
    write(tmp_path / "in", a="id,name,day\n1,x,2026-01-01\n2,y\n3,z,2026-01-01,more\nq,,soon\n,,\n",
          b="day,id,name\n2026-01-02,5,x\nnever,6,x\n")
    path = f"{tmp_path}/in/*.csv"
    assert ingest_checked(spark, layers, "people", path, contract, "2026-02-01") == (3, 4)
    good = tables.read(spark, layers.resolve("people", "lake")).select("id", "name")
    assert rows(good) == [(None, None), (1, "x"), (5, "x")]
    bad = tables.read(spark, layers.resolve("people_quarantine", "lake"))
    assert found(bad) == [
        ("a.csv", "ragged", [], "2,y"), ("a.csv", "ragged", [], "3,z,2026-01-01,more"),
        ("a.csv", "uncastable", [("id", "q"), ("day", "soon")], '{"id":"q","day":"soon"}'),
        ("b.csv", "uncastable", [("day", "never")], '{"id":"6","name":"x","day":"never"}')]
    # The files are mended and the day runs again.
    write(tmp_path / "in", a="id,name,day\n1,x,2026-01-01\n", b="day,id,name\n2026-01-02,5,x\n")
    assert ingest_checked(spark, layers, "people", path, contract, "2026-02-01") == (2, 0)
    assert tables.read(spark, layers.resolve("people_quarantine", "lake")).count() == 0


def test_count_of_text_only_rows_sees_ragged_ones(spark, tmp_path, sheet):
    contract = sheet([("a", "string"), ("b", "string")])
    write(tmp_path / "in", t="a,b\n1,2\n3\n4,5,6\n")
    good, bad = split_rows(tag_rows(spark, f"{tmp_path}/in/t.csv", contract), contract)
    assert good.count() == 1 and bad.count() == 2
    write(tmp_path / "in", u="b,a\n7,8\n9\n")
    good, bad = split_rows(tag_rows(spark, f"{tmp_path}/in/*.csv", contract), contract)
    assert good.count() == 2 and bad.count() == 3 and rows(good) == [("1", "2"), ("8", "7")]


def test_json_faults(spark, tmp_path, sheet):
    contract = sheet(COLUMNS, ["id"])
    write(tmp_path / "in", j='{"id": 1, "name": "x"}\n{"id": "q"}\n{"id": 2, "more": 1}\n{"id"\n')
    good, bad = split_rows(tag_rows(spark, f"{tmp_path}/in/j.json", contract), contract)
    assert rows(good) == [("1", "x", None)]
    assert found(bad) == [("j.json", "uncastable", [("id", "q")], '{"id": "q"}'),
                          ("j.json", "undeclared: more", [], '{"id": 2, "more": 1}'),
                          ("j.json", "unparsable", [], '{"id"')]


def test_protected_values_are_withheld_and_headers_checked(spark, tmp_path, sheet):
    contract = sheet(COLUMNS, ["id"], levels={"id": "hash"})
    write(tmp_path / "in", a="id,name,day\nq,x,soon\n")
    bad = split_rows(tag_rows(spark, f"{tmp_path}/in/a.csv", contract), contract)[1]
    assert found(bad) == [("a.csv", "uncastable", [("id", None), ("day", "soon")], None)]
    write(tmp_path / "in", c="id,name\n1,x\n")
    with pytest.raises(ValueError, match="'day' is absent"):
        tag_rows(spark, f"{tmp_path}/in/c.csv", contract)
    with pytest.raises(FileNotFoundError):
        tag_rows(spark, f"{tmp_path}/none.csv", contract)
