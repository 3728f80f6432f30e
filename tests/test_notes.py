from __future__ import annotations

import datetime as dt
import gzip
from pathlib import Path
import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from clinspark.sources.notes import PATIENT_FOLDER_PATTERN, note_chunks, patient_of_file, read_notes, segment_notes, write_notes

END = "\n\n\n\n"
ONE = "2010-01-01\n\nfirst line\n\nsecond paragraph" + END
TWO = "2011-02-03\n\n# Chief complaint\nnone" + END


def folder(tmp_path, files):
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


def test_notes_of_files(spark, tmp_path):
    notes = read_notes(spark, folder(tmp_path, {
        "Ann_Lee_p1.txt": "\n" + ONE + TWO,
        "Bob_p2.txt": (ONE + TWO).replace("\n", "\r\n"),
        "Cat_p3.txt": "2012-01-01\n\na\u0085b" + END,
        "Dan_p4.txt": ONE + "2013-01-01\n\nnot ended\n",
        "Eve_p5.txt": "2010-01-01 late entry\n\nbody" + END + TWO,
        "noname.txt": TWO,
    }))
    first, second = dt.date(2010, 1, 1), dt.date(2011, 2, 3)
    body = "first line\n\nsecond paragraph"
    assert rows(notes.rows, "patient", "date", "note_text") == [
        ("p1", first, body), ("p1", second, "# Chief complaint\nnone"),
        ("p2", first, body), ("p2", second, "# Chief complaint\nnone"),
        ("p3", dt.date(2012, 1, 1), "a\u0085b"),
        ("p4", first, body),
        ("p5", second, "# Chief complaint\nnone"),
    ]
    assert rows(notes.rejects, "reason", "header") == [
        ("header is not a date", "2010-01-01 late entry"), ("no patient id in the file name", None)]


def test_unterminated_note_can_be_kept(spark, tmp_path):
    path = folder(tmp_path, {"a_p.txt": ONE + "2013-01-01\n\nlast one"})
    assert read_notes(spark, path).rows.count() == 1
    assert rows(read_notes(spark, path, keep_unterminated=True).rows, "note_text")[1] == ("last one",)


def test_body_rules(spark):
    docs = spark.createDataFrame([
        (1, "2010-01-01\n\n" + END),                       # empty body
        (2, "2010-01-01\n\nx" + END + "\n" + ONE),         # five line ends
        (3, "2010-01-01" + END + "2011-01-01\n\ny" + END),  # body begins with line ends
        (4, "see 2010-01-01 there\n\nz" + END),            # date inside a line
        (5, "2010-01-01\nnot blank\n\nz" + END),           # no blank line behind the date line
    ], "id int, text string")
    assert rows(segment_notes(docs)) == [
        (1, "2010-01-01", ""),
        (2, "2010-01-01", "first line\n\nsecond paragraph"), (2, "2010-01-01", "x"),
        (3, "2010-01-01", "\n\n2011-01-01\n\ny"),
        (4, "2010-01-01 there", "z"),
    ]


def test_large_body(spark):
    body = "word " * 2_000_000
    docs = spark.createDataFrame([(1, "2010-01-01\n\n" + body + END)], "id int, text string")
    got = segment_notes(docs).selectExpr("length(note_text) as n").collect()
    assert [r["n"] for r in got] == [len(body)]


def test_patient_of_file(spark):
    df = spark.createDataFrame([("a_b_77.txt",), ("x_1.txt_old",), ("none.txt",)], "f string")
    assert rows(df.select(patient_of_file("f"))) == [(None,), ("1",), ("77",)]


def test_written_notes_come_back(spark, staging):
    df = spark.createDataFrame(
        [("p1", dt.date(2010, 1, i % 28 + 1), f"note {i}") for i in range(50)] + [("p2", dt.date(2011, 1, 1), "a\n\nb")],
        "patient string, date date, note_text string",
    )
    write_notes(df, staging.path("n"), max_notes_per_file=7)
    back = read_notes(spark, staging.path("n"), pattern=PATIENT_FOLDER_PATTERN, group=1, match_path=True)
    assert rows(back.rows, *df.columns) == rows(df)
    assert back.rejects.count() == 0


def test_patients_lie_in_a_bounded_number_of_folders(spark, staging):
    """Else Spark lists each patient's folder in a task of its own; and small files are written by few tasks."""
    df = spark.range(600).selectExpr("'p' || id AS patient", "DATE '2020-01-01' AS date", "'note ' || id AS note_text").union(
        spark.range(40).selectExpr("'many'", "DATE '2020-01-01'", "'note ' || id"))
    write_notes(df, staging.path("n"), max_notes_per_file=7)
    folders = {p.name for p in Path(staging.path("n")).iterdir() if p.is_dir()}
    files = [p for p in Path(staging.path("n")).rglob("*.txt")]
    assert len(folders) <= 256 and len({p.parent for p in files}) == 601
    assert len({p.name.split("-")[1] for p in files}) > 1 and len({p.name for p in files if p.parent.name == "patient=many"}) > 5
    back = read_notes(spark, staging.path("n"), pattern=PATIENT_FOLDER_PATTERN, group=1, match_path=True).rows
    assert rows(back, *df.columns) == rows(df)
    write_notes(df.where("false"), staging.path("none"))


@pytest.fixture
def blocks(spark):
    """Sets the size of a block; the old settings come back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {n: spark.conf.get(n, None) for n in names}

    def sized(size):
        for name, value in zip(names, (size, 1, 1)):
            spark.conf.set(name, str(value))

    yield sized
    for name, value in old.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def strange_notes(seed):
    """Dates where bodies end, empty bodies, line ends in any number and of any kind, and notes that don't end."""
    rng = random.Random(seed)
    parts = ["2010-01-01", "2011-02-03", "text", "more text 1", "\n", "\n", "\n\n", "\n\n\n", END, END, "\n" * 5, "\r\n", "\r", "é", ""]
    return "".join(rng.choices(parts, k=rng.randint(0, 60)))


@pytest.mark.parametrize("keep", [False, True])
def test_any_blocks_equal_whole_documents(spark, tmp_path, blocks, keep):
    texts = {f"a_{i}.txt": strange_notes(i) for i in range(80)}
    texts["a_80.txt"] = ONE * 5 + "2012-01-01\n\nends with 2013-01-01" + END + TWO * 5 + "\n" * 9 + ONE.replace("\n", "\r\n") * 3
    path = folder(tmp_path, texts)
    docs = spark.createDataFrame([(n[2:-4], t) for n, t in texts.items()], "patient string, text string")
    want = rows(segment_notes(docs, keep_unterminated=keep).where("length(header) = 10"), "patient", "header", "note_text")
    assert len(want) > 50
    for size in (1, 2, 3, 5, 8, 13, 40, 111, 100_000):
        blocks(size)
        got = rows(read_notes(spark, path, keep_unterminated=keep).rows.selectExpr(
            "patient", "cast(date as string) as header", "note_text"), "patient", "header", "note_text")
        assert got == want, size


def test_a_file_is_many_tasks_and_few_seams(spark, tmp_path, blocks):
    path = folder(tmp_path, {"a_p.txt": (ONE + TWO) * 3000})
    blocks(10_000)
    text = plan(read_notes(spark, path).rows)
    assert "wholetext" not in text.lower()
    chunks = note_chunks(spark, path)
    # Where a border lies in the blank lines of an end, two notes stay together.
    assert 5900 < chunks.count() <= 6000 and chunks.agg(F.max(F.length("text"))).first()[0] < 120
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert read_notes(spark, path).rows.count() == 6000


def test_small_files_are_read_whole_by_few_tasks(spark, tmp_path):
    path = folder(tmp_path, {f"a_{i}.txt": ONE + TWO for i in range(200)})
    found = read_notes(spark, path).rows
    text = plan(found)
    # No lines are shuffled to their blocks, and no file is opened by the scan for the others.
    assert "Window" not in text and "Scan binaryFile" in text and "Scan text" not in text and "Coalesce" in text
    assert rows(found.groupBy("note_text").count(), "count") == [(200,), (200,)]


@pytest.mark.parametrize("keep", [False, True])
def test_files_read_whole_and_by_lines_give_the_same(spark, tmp_path, keep, monkeypatch):
    """Marks at the begin, bytes that are no text, empty files, and files without an id, with a note's end or without."""
    path = folder(tmp_path, {
        "a_1.txt": "﻿" + ONE + "2013-01-01\n\nopen", "a_2.txt": "", "a_3.txt": ONE + "2013-01-01\n\n", "a_4.txt": TWO + "2013-01-01",
        "noname.txt": ONE + "x" + END + "﻿" + TWO, "none2.txt": "﻿x", "a_5.txt": ONE.replace("\n", "\r") + TWO[:-1],
        "a_6.text": ONE, "a_7.txt_old": TWO})
    (tmp_path / "a_8.txt").write_bytes(ONE.encode().replace(b"first", b"\xff\xc3 \x80\n\xe2\x82") + b"\xc3")
    (tmp_path / "a_9.txt.gz").write_bytes(gzip.compress(ONE.encode()))

    def found():
        notes = read_notes(spark, path, keep_unterminated=keep)
        return rows(notes.rows), rows(notes.rejects)

    at_once = found()
    monkeypatch.setattr("clinspark.sources.notes.WHOLE_BYTES", -1)
    assert found() == at_once
    assert len(at_once[0]) == (10 if keep else 7) and len(at_once[1]) == 5


def test_a_folder_is_written_by_one_task(spark, staging):
    df = spark.range(1500).selectExpr(
        "if(id < 3, null, 'p' || id) AS patient", "DATE '2020-01-01' AS date", "if(id % 9 = 0, null, 'note ' || id) AS note_text")
    write_notes(df, staging.path("n"))
    tasks = {}
    for p in Path(staging.path("n")).rglob("*.txt"):
        tasks.setdefault(p.parent.parent.name, set()).add(p.name.split("-")[1])
    assert len(tasks) > 200 and all(len(t) == 1 for t in tasks.values()) and len(set.union(*tasks.values())) > 4
    back = read_notes(spark, staging.path("n"), pattern=PATIENT_FOLDER_PATTERN, group=1, match_path=True).rows
    want = df.where("note_text IS NOT NULL").selectExpr("coalesce(patient, '__HIVE_DEFAULT_PARTITION__') AS patient", "date", "note_text")
    assert rows(back, *df.columns) == rows(want)
