from __future__ import annotations

import random

import pytest
from helpers import plan, rows

from clinspark.plans.load import load_dataset
from clinspark.sources.csv_records import csv_records, scan_quoted_csv
from clinspark.sources.csv_tables import POSITION, read_table, scan_csv
from clinspark.spec import LoadConfig, TableSpec


@pytest.fixture
def small_blocks(spark):
    """Blocks of as many bytes as asked for."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name, None) for name in names}

    def blocks(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield blocks
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def written(value, end):
    if value is None:
        return ""
    quoted = '"' + value.replace('"', '""') + '"'
    return quoted if any(c in value for c in ',"\n\r') or not value else value


def csv_text(records, end="\n"):
    return "".join(",".join(written(v, end) for v in r) + end for r in records)


@pytest.mark.parametrize("seed, size", [(0, 9), (1, 40), (2, 64), (3, 200), (4, 100_000)])
def test_equals_a_parse_in_one_task(spark, tmp_path, small_blocks, seed, size):
    source = random.Random(seed)
    parts = ["a", "b c", '"', '""', ",", "\n", "\n\n", 'x"y', "end", "\n,", '",', "5' 3\" pipe"]
    records = [["id", "one", "two"]]
    for i in range(60):
        values = ["".join(source.choice(parts) for _ in range(source.randrange(5))) or None for _ in range(2)]
        records.append([f"k{i}", *values])
    path = tmp_path / "t.csv"
    path.write_bytes(csv_text(records).encode())
    want = rows(scan_csv(spark, str(path), multi_line=True, missing=()).rows)
    assert want == sorted([tuple(r) for r in records[1:]], key=lambda r: tuple((v is not None, str(v)) for v in r))
    small_blocks(size)
    found = scan_quoted_csv(spark, str(path), missing=())
    assert rows(found.rows) == want and found.rejects.count() == 0


@pytest.mark.parametrize("size", [5, 11, 100_000])
def test_stray_quotes_change_nothing_behind_them(spark, tmp_path, small_blocks, size):
    """A quote inside of an unquoted value, text behind a closing quote, an empty quoted value."""
    path = tmp_path / "t.csv"
    path.write_text('a,b\n5" pipe,1\n"two\nlines",2\n"x"y,3\n"",4\nz,"5"\n6" "7,"8\n\n9"\n')
    want = rows(scan_csv(spark, str(path), multi_line=True, missing=()).rows)
    small_blocks(size)
    found = scan_quoted_csv(spark, str(path), missing=())
    assert rows(found.rows) == want and len(want) == 6 and found.rejects.count() == 0


def test_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i}, of one value" for i in range(400))
    path = tmp_path / "t.csv"
    path.write_text(csv_text([["a", "b"], ["1", long], ["2", "x"], ["3", f"{long}\n"], ["4", long]]))
    small_blocks(256)
    found = scan_quoted_csv(spark, str(path))
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 50
    assert rows(found.rows) == [("1", long), ("2", "x"), ("3", f"{long}\n"), ("4", long)]


def test_rejects(spark, tmp_path, small_blocks):
    (tmp_path / "t.csv").write_text('a,b\n1,"two\nlines"\n3,4,5\n6\n7,8,\n9,"never\nclosed\n10,11\n')
    for size in (6, 100_000):
        small_blocks(size)
        found = scan_quoted_csv(spark, str(tmp_path / "t.csv"))
        assert rows(found.rows) == [("1", "two\nlines"), ("6", None)]
        assert rows(found.rejects, "line", "reason") == [
            ("10,11", "open quote"), ("3,4,5", "too many fields"), ("7,8,", "too many fields"),
            ('9,"never', "open quote"), ("closed", "open quote")]


def test_line_ends_blank_lines_and_separators(spark, tmp_path, small_blocks):
    (tmp_path / "t.csv").write_bytes(b'\r\n"a\r\n1"|b\r\n\r\n1|"x\r\n\r\ny"\r\n"p|q"|2')
    small_blocks(4)
    found = scan_quoted_csv(spark, str(tmp_path / "t.csv"), sep="|")
    assert found.rows.columns == ["a\n1", "b"]
    assert rows(found.rows) == [("1", "x\r\n\r\ny"), ("p|q", "2")]


def test_folder_headers_and_empty_files(spark, tmp_path):
    folder = tmp_path / "h"
    folder.mkdir()
    (folder / "1.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "2.csv").write_text("a,b\n3,4\n")
    (folder / "3.csv").write_text("")
    (folder / "4.csv").write_text("a,b\n")
    assert rows(scan_quoted_csv(spark, str(folder)).rows) == [("1", "x\ny"), ("3", "4")]
    (folder / "5.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_quoted_csv(spark, str(folder)).rows.collect()


def test_typed_read_with_positions(spark, tmp_path, small_blocks):
    path = tmp_path / "t.csv"
    path.write_text('ID,NOTE,START\n2,"a\nb",2011-01-01\n1,NA,2012-01-01\n2,"c\nd",2013-01-01\n')
    small_blocks(10)
    found = read_table(spark, str(path), TableSpec("t", ("start",)), with_position=True, quoted_breaks=True).rows
    assert dict(found.dtypes)["start"] == "timestamp_ntz" and dict(found.dtypes)["id"] == "string"
    assert [r["note"] for r in found.orderBy(*POSITION).collect()] == ["a\nb", None, "c\nd"]


def test_no_python_and_many_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "t.csv"
    path.write_text(csv_text([["a", "b"], *([str(i), "x\ny"] for i in range(2000))]))
    small_blocks(1000)
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
    records = csv_records(spark, str(path))
    assert "Python" not in plan(records) and "CartesianProduct" not in plan(records)
    assert records.where("not header").count() == 2000


def test_load_with_quoted_breaks(spark, tmp_path):
    folder = tmp_path / "in" / "csv"
    folder.mkdir(parents=True)
    (folder / "patients.csv").write_text('ID,BIRTHDATE,ADDRESS\np1,1950-01-01,"12 Main St\nFlat 4"\np1,1950-01-01,again\n')
    config = LoadConfig(str(tmp_path / "in"), str(tmp_path / "out"), tables=(TableSpec("patients", ("birthdate",)),), quoted_breaks=True)
    assert rows(load_dataset(spark, config)["patients"], "id", "address") == [("p1", "12 Main St\nFlat 4")]


@pytest.mark.parametrize("with_position", [False, True])
def test_lines_are_read_once_for_states_and_once_for_records(spark, tmp_path, small_blocks, with_position):
    folder = tmp_path / "f"
    folder.mkdir()
    texts = ["a,b\n" + 'k,"x\ny"\n\nz,1\n' * 30 + "q\n", 'a,b\n1,"\n\n2"\n3,\n4,"open\n5\n', "a,b\n", ""]
    for i, text in enumerate(texts):
        (folder / f"part {i}.csv").write_text(text)
    small_blocks(50)
    found = scan_quoted_csv(spark, str(folder), with_position=with_position).rows
    values = found.collect()
    final = found._jdf.queryExecution().executedPlan().toString()
    final = final[:final.index("== Initial Plan ==")]
    assert final.count("FileScan text") == 2 and "ReusedExchange" in final
    assert sorted((r["a"], r["b"] or "") for r in values) == sorted([("k", "x\ny"), ("z", "1")] * 30 + [("q", ""), ("1", "\n\n2"), ("3", "")])
    if with_position:
        assert {r[POSITION[0]] for r in values} == {"part%200.csv", "part%201.csv"} and len({tuple(r)[2:] for r in values}) == len(values)
