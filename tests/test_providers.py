from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from helpers import rows

from clinspark.operators.providers import curation_plan, fan_out, filter_by_number, hospital_numbers, literal_csv, urgent_care
from clinspark.plans.providers import curate_lists, curate_providers
from clinspark.sources.csv_tables import scan_csv


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "npi bigint, name string")


def test_options():
    assert hospital_numbers("MGUH") == [1427145176]
    assert hospital_numbers("WHC") == hospital_numbers("MWHC") == [1548378235]
    assert len(hospital_numbers("both")) == 2
    with pytest.raises(ValueError):
        hospital_numbers("other")
    plan = {target: (source, numbers) for source, target, numbers in curation_plan("both")}
    assert len(plan) == 11
    assert plan["dialysis.csv"] == ("hospitals.csv", [1427145176, 1548378235])
    assert plan["hospice.csv"] == ("hospitals.csv", [1427145176])


def test_filter_never_matches_null(listed):
    assert rows(filter_by_number(listed, [1, 3, None]), "name") == [("a",), ("d",)]
    assert filter_by_number(listed, [1]).columns == listed.columns
    assert filter_by_number(listed, []).count() == 0


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "double"])
def test_long_and_short_lists_filter_alike(spark, kind):
    numbers = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", None), ("d", "2")], "name string, npi string")
    df = numbers.select("name", F.col("npi").cast(kind))
    if kind == "string":
        df = df.unionByName(spark.createDataFrame(
            [("e", " 3"), ("f", "3.0"), ("g", "3.5"), ("h", "x"), ("i", "99999999999999999999")], "name string, npi string"))
    want = ["a", "b", *(["e", "f"] if kind == "string" else [])]
    for long in ([], range(10, 2010), [2**62]):
        got = filter_by_number(df, [1, 3, None, *long])
        assert got.columns == df.columns and [r[0] for r in rows(got, "name")] == want
    assert [r[0] for r in rows(fan_out(df, {"t": [1, 3]}), "name")] == want


def test_one_provider_in_two_targets(listed):
    got = fan_out(listed, {"x": [1, 2], "y": [1], "z": []})
    assert rows(got, "target", "name") == [("x", "a"), ("x", "b"), ("y", "a")]


def test_literal_table(spark):
    df = urgent_care(spark)
    assert df.count() == 2 and len(df.columns) == 15
    assert rows(df, "_c0", "id", "zip")[0] == (4810, 4001, 20009)
    assert {r["type"] for r in df.collect()} == {
        "URGENT MEDICAL CARE CENTERS AND CLINICS (EXCEPT HOSPITALS), FREESTANDING"}
    indented = literal_csv(spark, "a,b\n   1,\"x, y\"\n   \n", "a int, b string")
    assert rows(indented) == [(1, "x, y")]


def test_curation(spark, tmp_path):
    sources = {s for s, _, _ in curation_plan("both")}
    numbers = sorted({n for _, _, ns in curation_plan("both") for n in ns})
    (tmp_path / "in").mkdir()
    for source in sources:
        lines = [",id,npi,name"] + [f"{i},{i},{n},{source}" for i, n in enumerate([*numbers, "", 42])]
        (tmp_path / "in" / source).write_text("\n".join(lines) + "\n")
    written = curate_providers(spark, str(tmp_path / "in"), str(tmp_path / "out"), "both")
    assert len(written) == 12
    for source, target, wanted in curation_plan("both"):
        got = scan_csv(spark, f"{tmp_path}/out/{source}/target={target}").rows
        assert got.columns == ["_c0", "id", "npi", "name"]
        assert rows(got, "npi") == sorted((str(n),) for n in wanted)
    assert scan_csv(spark, f"{tmp_path}/out/urgent_care_facilities.csv").rows.count() == 2


def test_curation_keeps_bad_lines_and_the_blank_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(',npi,name\n0,1.0,x\n1,2,"Road, 2"\n2,1,Road, 3\n3,,z\n')
    curate_lists(spark, str(tmp_path / "in"), str(tmp_path / "out"), [("a.csv", "t.csv", [1, 2])])
    parts = [p.read_text() for p in (tmp_path / "out" / "a.csv" / "target=t.csv").glob("part*")]
    lines = sorted(line for p in parts for line in p.splitlines() if not line.startswith(",npi"))
    assert all(p.startswith(",npi,name\n") for p in parts) and lines == ["0,1.0,x", '1,2,"Road, 2"']
    bad = spark.read.parquet(str(tmp_path / "out" / "rejects" / "a.csv"))
    assert rows(bad, "line", "reason") == [("2,1,Road, 3", "too many fields")]
