from __future__ import annotations

import datetime as dt

import pytest
from helpers import plan, rows, ts

from clinspark.operators.dedup import dedup_table, distinct_rows, first_per_key
from clinspark.plans.load import load_table
from clinspark.sources.csv_tables import POSITION, infer_types, read_table, scan_csv
from clinspark.sources.sinks import append_table, cluster_table, replace_table, write_bucketed, write_csv
from clinspark.sources.vocab import scan_vocabulary
from clinspark.spec import TableSpec

ENCOUNTERS = """\
Id,START,STOP,PATIENT,CODE,DESCRIPTION,COST,FLAG,REASONCODE
e1,2011-01-01T08:00:00Z,2011-01-01T09:00:00Z,p1,185345009,"Visit, short",10.5,true,
e2,2009-01-01T08:00:00Z,2009-01-01T09:00:00Z,p1,55822004,Check,3,false,55822004
e1,2012-01-01T08:00:00Z,2012-01-01T09:00:00Z,p1,185345009,Copy,10.5,true,
e3,2012-05-01T08:00:00Z,,p2,702927004000000001,NA,7,true,
e4,2012-05-01T08:00:00Z,2012-05-02T08:00:00Z,p2,1,Main St, Apt 4,7,true,
e5,2012-05-01T08:00:00Z,2012-05-02T08:00:00Z,p3,1,Short line
"""
SPEC = TableSpec("encounters", ("stop", "start"), trimmed=True)


def write(tmp_path, text, name="encounters.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_text_first_then_types(spark, tmp_path):
    table = read_table(spark, write(tmp_path, ENCOUNTERS), SPEC)
    types = dict(table.rows.dtypes)
    assert types == {
        "id": "string", "start": "timestamp_ntz", "stop": "timestamp_ntz", "patient": "string",
        "code": "string", "description": "string", "cost": "double", "flag": "boolean", "reasoncode": "string",
    }
    got = {r["id"]: r for r in table.rows.collect() if r["description"] != "Copy"}
    assert got["e1"]["description"] == "Visit, short"
    assert got["e2"]["reasoncode"] == "55822004"  # a code column with blanks stays as written
    assert got["e3"]["code"] == "702927004000000001" and got["e3"]["description"] is None
    assert got["e3"]["stop"] is None
    assert got["e5"]["description"] == "Short line" and got["e5"]["cost"] is None
    assert "e4" not in got


def test_shifted_line_is_rejected(spark, tmp_path):
    path = write(tmp_path, ENCOUNTERS)
    rejects = scan_csv(spark, path).rejects
    assert [r["line"] for r in rejects.collect()] == [
        "e4,2012-05-01T08:00:00Z,2012-05-02T08:00:00Z,p2,1,Main St, Apt 4,7,true,"]
    assert rejects.count() == 1


def test_extra_field_that_is_empty_is_rejected_too(spark, tmp_path):
    table = scan_csv(spark, write(tmp_path, "a,b\n1,2\n3,4,\n5\n"))
    assert rows(table.rows) == [("1", "2"), ("5", None)] or rows(table.rows) == [("5", None), ("1", "2")]
    assert rows(table.rejects, "line") == [("3,4,",)]


def test_infer_types(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "True", None, "55822004D", "1", "12345678901234567890123"),
         ("-2", "2", "false", None, "1", "x", "1")],
        "a string, b string, c string, d string, e string, f string, g string",
    )
    assert infer_types(df, df.columns) == {
        "a": "bigint", "b": "double", "c": "boolean", "d": "double", "e": "string", "f": "string",
        "g": "string"}


def test_pinned_types_skip_inference(spark, tmp_path):
    path = write(tmp_path, "ID,N\nx,1\n", "t.csv")
    spec = TableSpec("t", types=(("n", "double"),))
    assert dict(read_table(spark, path, spec).rows.dtypes) == {"id": "string", "n": "double"}


def test_load_trims_before_removing_duplicates(spark, tmp_path):
    text = "ID,START,STOP\nx,2001-01-01,2001-01-02\nx,2011-01-01,2011-01-02\nx,2012-01-01,2012-01-02\n"
    table = load_table(spark, write(tmp_path, text), SPEC, dt.date(2010, 1, 1))
    assert rows(table.rows, "id", "start") == [("x", ts("2011-01-01"))]


def test_load_open_ends(spark, tmp_path):
    path = write(tmp_path, ENCOUNTERS)
    drop = load_table(spark, path, SPEC, dt.date(2010, 1, 1))
    keep = load_table(spark, path, SPEC, dt.date(2010, 1, 1), open_ended="keep")
    assert rows(drop.rows, "id", "description") == [("e1", "Visit, short"), ("e5", "Short line")]
    assert rows(keep.rows, "id") == [("e1",), ("e3",), ("e5",)]


def test_first_in_file_order_over_many_splits(spark, tmp_path):
    lines = ["ID,N"] + [f"{i % 97},{i}" for i in range(20_000)]
    path = write(tmp_path, "\n".join(lines) + "\n", "many.csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        table = read_table(spark, path, TableSpec("many"), with_position=True)
        assert table.rows.rdd.getNumPartitions() > 4
        got = dedup_table(table.rows, POSITION)
        assert sorted((int(r["id"]), r["n"]) for r in got.collect()) == [(i, i) for i in range(97)]
        assert table.rows.drop(*POSITION).columns == ["id", "n"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3), ("a", 3)], "id string, n int")
    assert rows(first_per_key(df, ["id"], ["n"])) == [(None, 1), ("a", 3)]
    assert rows(distinct_rows(df)) == [(None, 1), (None, 2), ("a", 3)]
    again = first_per_key(first_per_key(df, ["id"], ["n"]), ["id"], ["n"])
    assert rows(again) == [(None, 1), ("a", 3)]


def test_sinks(spark, staging):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    replace_table(df.limit(1), staging.path("r"))
    replace_table(df, staging.path("r"))
    assert spark.read.parquet(staging.path("r")).count() == 2
    append_table(df, staging.path("a"), run_id="one")
    append_table(df, staging.path("a"), run_id="two")
    assert rows(spark.read.parquet(staging.path("a")), "run_id").count(("one",)) == 2
    append_table(df, staging.path("b"))
    append_table(df, staging.path("b"))
    assert spark.read.parquet(staging.path("b")).count() == 4


def test_clustered_write_spreads_copies_of_one_row(spark, staging):
    df = staging.table(spark.range(40_000).selectExpr("if(id % 3 = 0, 7, id) as k"), "source")
    cluster_table(spark, staging.path("source"), staging.path("c"), ["k"], partitions=8)
    back = spark.read.parquet(staging.path("c"))
    assert back.columns == ["k"]
    assert rows(back.selectExpr("count(*)", "sum(k)")) == rows(df.selectExpr("count(*)", "sum(k)"))
    per_file = back.where("k = 7").groupBy("_metadata.file_name").count().collect()
    assert len(per_file) >= 2 and max(r["count"] for r in per_file) < 10_000


def test_catalog_tables_and_buckets(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as id", "id as n")
    replace_table(df.limit(1), table="plain_table")
    replace_table(df, table="plain_table")
    append_table(df, table="plain_table")
    assert spark.table("plain_table").count() == 2000
    write_bucketed(df, "left_table", "id", 4)
    write_bucketed(df, "right_table", "id", 4)
    joined = spark.table("left_table").hint("merge").join(spark.table("right_table"), "id")
    assert joined.count() == 1000
    assert "Exchange" not in plan(joined)
    for name in ("plain_table", "left_table", "right_table"):
        spark.sql(f"DROP TABLE {name}")


def test_csv_round_trip_with_quotes(spark, staging):
    df = spark.createDataFrame([('say "hi", x', None), ("plain", "y")], "a string, b string")
    write_csv(df, staging.path("q.csv"))
    assert rows(scan_csv(spark, staging.path("q.csv")).rows) == rows(df)


def test_open_quotes_and_differing_headers(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b,c\n1,"two\nlines",3\n4,"five, ""six""",7\n8,9\n1,2,3,4\n')
    table = scan_csv(spark, str(tmp_path / "q.csv"))
    assert rows(table.rows) == [("4", 'five, "six"', "7"), ("8", "9", None)]
    assert rows(table.rejects, "line", "reason") == [
        ('1,"two', "open quote"), ("1,2,3,4", "too many fields"), ('lines",3', "open quote")]
    whole = scan_csv(spark, str(tmp_path / "q.csv"), multi_line=True)
    assert ("1", "two\nlines", "3") in rows(whole.rows)
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "h" / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path / "h")).rows.collect()


def test_bad_vocabulary_lines_are_no_null_keys(spark, tmp_path):
    (tmp_path / "CONCEPT_SYNONYM.csv").write_text(
        "concept_id\tconcept_synonym_name\tlanguage_concept_id\n1\tone\t5\nx\ttwo\t5\n3\tthree\t\n")
    found = scan_vocabulary(spark, str(tmp_path), ["concept_synonym"])["concept_synonym"]
    assert rows(found.rows) == [(1, "one", 5), (3, "three", None)]
    assert rows(found.rejects, "line") == [("x\ttwo\t5",)]


def test_types_are_learnt_where_ids_are_stored(spark, tmp_path):
    """One job reads the file for both; tables without an id, empty ones and those without a stage are as before."""
    from clinspark.staging import Staging
    from helpers import plan

    plans = []

    class Watched(Staging):
        def table(self, df, name=None):
            plans.append(plan(df))
            return super().table(df, name)

        __call__ = table

    many = [f"C{i}" for i in range(60)]
    texts = {
        "rows.csv": "ID,START,STOP,N,F,B,T,E,L\nx,2011-01-01,2011-01-02,1,1,True,a,,123456789012345678901\n"
                    "x,2011-01-01,2011-01-02,,2.5,false,1,NA,1\n,2011-01-01,2011-01-02,3,4,TRUE,2,,1\n,2011-01-01,2011-01-02,3,4,TRUE,2,,1\n"
                    "z,2001-01-01,2001-01-02,text,4,true,2,,1\n\"broken\n",
        "plain.csv": "START,STOP,N\n2011-01-01,2011-01-02,1\n2011-01-01,2011-01-02,1\n",
        "none.csv": "ID,START,STOP,N\n",
        "wide.csv": ",".join(["ID", "START", "STOP", *many]) + "\n" + "".join(
            f"k{i % 7},2011-01-01,2011-01-02," + ",".join(str(i + j) if j % 3 else f"{j}.{i}" for j in range(60)) + "\n" for i in range(50)),
        "typed.csv": "ID,START,STOP,DESCRIPTION\nx,2011-01-01,2011-01-02,a\nx,2011-01-01,2011-01-02,b\n",
    }
    learnt = {}
    for name, text in texts.items():
        path, spec = write(tmp_path, text, name), SPEC
        if name == "typed.csv":
            spec = TableSpec("t", SPEC.date_columns, trimmed=True, types=(("description", "string"),))
        plans.clear()
        at_once = load_table(spark, path, spec, dt.date(2010, 1, 1), stage=Watched(spark))
        learnt[name] = ["kinds_0" in p for p in plans]
        apart = load_table(spark, path, spec, dt.date(2010, 1, 1))
        assert at_once.rows.dtypes == apart.rows.dtypes
        assert rows(at_once.rows) == rows(apart.rows) and rows(at_once.rejects) == rows(apart.rejects)
    assert learnt == {
        "rows.csv": [True, False], "plain.csv": [], "none.csv": [True, False], "wide.csv": [True, False], "typed.csv": [False, False]}
    assert dict(load_table(spark, str(tmp_path / "rows.csv"), SPEC, dt.date(2010, 1, 1), stage=Staging(spark)).rows.dtypes) == {
        "id": "string", "start": "timestamp_ntz", "stop": "timestamp_ntz", "n": "string", "f": "double", "b": "boolean",
        "t": "string", "e": "double", "l": "string"}
