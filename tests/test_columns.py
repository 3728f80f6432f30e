from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.functions.columns import (
    cast_codes, drop_descriptions, is_code_column, lower_columns, rename_back, rename_columns, storage_schema,
    to_storage,
)
from clinspark.functions.dates import parse_dates, parse_instant, parse_strict_date, parse_timestamp
from clinspark.operators.trim import history_window, launch_trim
from clinspark.spec import CLINICAL_TABLES, LoadConfig, columns_present, select_tables


def test_lower_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "ID int, Start int")
    assert lower_columns(df).columns == ["id", "start"]
    twice = spark.createDataFrame([(1, 2)], "ID int, id int")
    with pytest.raises(ValueError, match="collide"):
        lower_columns(twice)


def test_rename_and_back(spark):
    df = spark.createDataFrame([(1, 2)], "start_date int, end_date int")
    names = {"start_date": "start_year", "end_date": "end_year"}
    assert rename_columns(df, names).columns == ["start_year", "end_year"]
    assert rename_back(rename_columns(df, names), names).columns == df.columns
    with pytest.raises(ValueError):
        rename_columns(df, {"nothing": "x"})


def test_timestamps_are_utc_whatever_the_session_zone(spark):
    df = spark.createDataFrame(
        [("2010-01-01T05:00:00Z",), ("2010-01-01",), ("2010-01-01 05:00:00",), ("2010-01-01T05:00:00+02:00",),
         ("31/12/2009",), (None,)], "t string",
    )
    want = [(None,), (None,), (ts("2010-01-01"),), (ts("2010-01-01T03:00"),), (ts("2010-01-01T05:00"),),
            (ts("2010-01-01T05:00"),)]
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert rows(df.select(parse_timestamp("t"))) == want
    assert rows(df.limit(1).select(F.unix_micros(parse_instant("t")))) == [(1262322000000000,)]


def test_parse_dates(spark):
    df = spark.createDataFrame([("1950-02-03", "2001-02-03T04:05:06Z")], "birthdate string, start string")
    parsed = parse_dates(df, ["birthdate", "start"])
    assert rows(parsed) == [(dt.date(1950, 2, 3), ts("2001-02-03T04:05:06"))]
    assert parsed.schema["start"].dataType == T.TimestampNTZType()
    with pytest.raises(ValueError, match="stop"):
        parse_dates(df, ["stop"])


def test_strict_date(spark):
    df = spark.createDataFrame([("2010-01-02",), ("2010-01-02 more",), ("2010-13-02",)], "t string")
    assert rows(df.select(parse_strict_date("t"))) == [(None,), (None,), (dt.date(2010, 1, 2),)]


def test_launch_trim_keeps_the_day_itself_and_drops_open_ends(spark):
    df = spark.createDataFrame(
        [(1, ts("2009-12-31T23:59:59")), (2, ts("2010-01-01")), (3, None)], "id int, stop timestamp_ntz"
    )
    day = dt.date(2010, 1, 1)
    assert rows(launch_trim(df, "stop", day), "id") == [(2,)]
    assert rows(launch_trim(df, "stop", day, open_ended="keep"), "id") == [(2,), (3,)]


def test_history_window(spark):
    df = spark.createDataFrame(
        [(1, ts("2020-06-01T12:00")), (2, ts("2018-06-01T12:00")), (3, ts("2018-06-01T11:59"))],
        "id int, start timestamp_ntz",
    )
    assert rows(history_window(df, "start", 2), "id") == [(1,), (2,)]
    assert history_window(df, "start", 0).count() == 3


def test_storage_types(spark):
    schema = T.StructType.fromDDL(
        "id string, code int, n int, cost float, birthdate timestamp_ntz, start timestamp_ntz, ok boolean, name string"
    )
    stored = {c.name: (c.data_type.simpleString(), c.max_length) for c in storage_schema(schema)}
    assert stored == {
        "id": ("string", 64), "code": ("string", 32), "n": ("bigint", None), "cost": ("double", None),
        "birthdate": ("date", None), "start": ("timestamp_ntz", None), "ok": ("boolean", None),
        "name": ("string", 1024),
    }
    df = spark.createDataFrame([(123456789012345678,)], "code bigint")
    assert rows(to_storage(df)) == [("123456789012345678",)]


def test_cast_codes_keeps_whole_values(spark):
    df = spark.createDataFrame([(10509002, "x" * 40)], "code bigint, reasoncode string")
    assert rows(cast_codes(df, ["code", "reasoncode"])) == [("10509002", "x" * 40)]


def test_drop_descriptions(spark):
    df = spark.createDataFrame([("1", "a")], "code string, description string")
    assert rows(drop_descriptions(df, "SNOMED")) == [("1", "SNOMED")]


def test_code_columns():
    assert all(is_code_column(c) for c in ("code", "reasoncode", "bodysite_code", "diagnosis1", "id", "patient"))
    assert not is_code_column("base_cost")


def test_manifest():
    specs = {t.name: t for t in CLINICAL_TABLES}
    assert len(specs) == 18
    assert specs["encounters"].trim_column == "stop"
    assert specs["procedures"].trim_column == "start"
    assert specs["allergies"].trim_column is None
    assert specs["payer_transitions"].trim_column is None
    assert sorted(t.name for t in CLINICAL_TABLES if t.orphans == "reassign") == [
        "allergies", "careplans", "conditions", "devices", "immunizations", "medications"]
    assert sorted(t.name for t in CLINICAL_TABLES if t.orphans == "delete") == [
        "imaging_studies", "observations", "procedures", "supplies"]


def test_select_tables():
    names = ["a", "b", "c"]
    assert select_tables(names, include=["b.csv"]) == ["b"]
    assert select_tables(names, exclude=["b"]) == ["a", "c"]
    assert select_tables(names, include=["a"], exclude=["b"]) == names
    assert select_tables(names) == names
    with pytest.raises(ValueError):
        LoadConfig("x", "y", open_ended="maybe")


def test_columns_present():
    assert columns_present(("id", "patient", "date"), ["date", "id", "x"]) == ["id", "date"]
