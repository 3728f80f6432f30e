"""CSV files with line breaks in quotes, read in as many tasks as the files have blocks.

Whether a line begins a record depends on all lines before it, but only by one bit: inside quotes or not. A line turns
that bit into another one: it keeps it, swaps it, or sets it whatever it was. So a block's lines together are such a
step, too, and the state at a block's begin is known from one small row per block before it. Only records of several
lines are put together, and only those at block borders meet across blocks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from clinspark.sources.csv_tables import MISSING_TEXTS, POSITION, CsvTable

_BAD = "_bad_line"
_BLOCK = ("file", "block")


def _ends_open(text: Column, sep: str) -> Column:
    """Whether a text without doubled quotes, begun outside of quotes, ends inside."""
    begin = f"(^|{re.escape(sep)})\""
    return F.regexp_replace(text, begin + '[^"]*+"', "$1x").rlike(begin)


def _steps(value: Column, sep: str) -> tuple[Column, Column]:
    """State behind a line (1: inside quotes) if it begins outside, and if it begins inside."""
    # A doubled quote is a quote inside of a value or an empty value: neither changes the state.
    plain = F.replace(value, F.lit('""'), F.lit(""))
    quoted = F.contains(plain, F.lit('"'))
    # Behind the closing quote a value goes on to the next separator.
    rest = F.concat(F.lit("x"), F.substr(plain, F.locate('"', plain) + 1))
    return (
        F.when(quoted, _ends_open(plain, sep).cast("int")).otherwise(0),
        F.when(quoted, _ends_open(rest, sep).cast("int")).otherwise(1),
    )


def _states(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """``if_out`` and ``if_in`` (steps) of the rows in ``order``, with the states ``from_out`` and ``from_in`` before each
    row, if the first row begins outside or inside of quotes."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum((F.col("if_out") > F.col("if_in")).cast("int")).over(before), F.lit(0))
    # The last row that sets the state, less the swaps up to it.
    known = F.last(F.when(F.col("if_out") == F.col("if_in"), (F.col("if_out") + F.col("_swaps")) % 2), True).over(before)
    return (
        df.withColumn("_swaps", swaps).withColumn("_known", known)
        .withColumn("from_out", (F.coalesce("_known", F.lit(0)) + F.col("_swaps")) % 2)
        .withColumn("from_in", (F.coalesce("_known", F.lit(1)) + F.col("_swaps")) % 2)
        .drop("_swaps", "_known")
    )


def _behind(state: Column) -> Column:
    return F.when(state == 0, F.col("if_out")).otherwise(F.col("if_in"))


def _block_states(lines: DataFrame) -> DataFrame:
    """One row per block: the state it ``begins`` in, the records ``n_begun`` in it, whether the last one is never closed."""
    blocks = lines.groupBy(*_BLOCK).agg(
        F.max_by(_behind(F.col("from_out")), "row").alias("if_out"), F.max_by(_behind(F.col("from_in")), "row").alias("if_in"),
        F.count_if((F.col("from_out") == 0) & ~F.col("blank")).alias("n_out"),
        F.count_if((F.col("from_in") == 0) & ~F.col("blank")).alias("n_in"))
    begins = F.col("from_out")  # a file begins outside
    known = _states(blocks, ["file"], "block").select(
        *_BLOCK, begins.alias("begins"), _behind(begins).alias("ends"),
        F.when(begins == 0, F.col("n_out")).otherwise(F.col("n_in")).alias("n_begun"))
    order = Window.partitionBy("file").orderBy("block")
    rest = order.rowsBetween(1, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    none_later = F.coalesce(F.sum("n_begun").over(rest), F.lit(0)) == 0
    return known.withColumn("unclosed", (F.last("ends").over(every) == 1) & none_later).drop("ends")


def csv_records(spark: SparkSession, path: str | list[str], *, sep: str = ",") -> DataFrame:
    """``file, name, block, row, header, closed, record``: the records of CSV files, with the place of their first line.

    A quote opens a value at the begin of a field only, a doubled quote stands for one. ``\\n`` and ``\\r\\n`` end a record;
    breaks inside of quotes stay as they are. Lines of white space outside of quotes are no records. ``header`` is true for
    a file's first record. A record that is open where its file ends is not put together, since one lost quote would make
    the rest of a file one value: its lines come one by one with ``closed`` false.
    """
    source = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    if_out, if_in = _steps(F.col("value"), sep)
    lines = _states(source.select(
        "*", if_out.alias("if_out"), if_in.alias("if_in"), (F.trim(F.rtrim("value", F.lit("\r"))) == "").alias("blank")), _BLOCK, "row")
    state = F.when(F.col("begins") == 0, F.col("from_out")).otherwise(F.col("from_in"))
    known = lines.join(_block_states(lines), list(_BLOCK)).withColumn("state", state).where((F.col("state") == 1) | ~F.col("blank"))
    so_far = Window.partitionBy(*_BLOCK).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    numbered = known.withColumn("number", F.sum((F.col("state") == 0).cast("int")).over(so_far))
    placed = numbered.select(
        "file", "name", "block", "row", "number", "value", (_behind(F.col("state")) == 0).alias("ends"),
        (F.col("unclosed") & (F.col("number") == F.col("n_begun"))).alias("open"),
        # A record on one line is nothing to put together.
        ((F.col("state") == 0) & (_behind(F.col("state")) == 0)).alias("single"))
    header = (F.col("block") == 0) & (F.col("number") == 1)

    # The name is no key: where nobody asks for it no branch has it, and Spark shuffles the lines once for all of them.
    name = F.first("name").alias("name")
    several = placed.where(~F.col("single") & ~F.col("open")).groupBy("file", "block", "number").agg(
        name, F.min("row").alias("row"), F.max("ends").alias("ends"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "value"))), lambda x: x["value"]), "\n").alias("value"))
    whole = F.col("ends") & (F.col("number") > 0)
    order = Window.partitionBy("file").orderBy("block", "number")
    seams = several.where(~whole).withColumn("seam", F.sum((F.col("number") > 0).cast("int")).over(order))
    piece = F.sort_array(F.collect_list(F.struct("block", "number", "row", "value")))
    joined = seams.groupBy("file", "seam").agg(name, piece.alias("pieces")).select(
        "file", "name", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["number"].alias("number"),
        F.col("pieces")[0]["row"].alias("row"),
        F.array_join(F.transform("pieces", lambda x: x["value"]), "\n").alias("value"))

    def given(df: DataFrame, closed: Column) -> DataFrame:
        return df.select("file", "name", "block", "row", header.alias("header"), closed.alias("closed"),
                         F.regexp_replace("value", r"\r\z", "").alias("record"))

    alone = placed.where(F.col("single") | F.col("open"))
    return given(alone, ~F.col("open")).unionByName(given(several.where(whole), F.lit(True))).unionByName(
        given(joined, F.lit(True)))


def scan_quoted_csv(
    spark: SparkSession, path: str | list[str], *, missing: Sequence[str] = MISSING_TEXTS, with_position: bool = False,
    sep: str = ",", observation: Observation | None = None,
) -> CsvTable:
    """``scan_csv`` for files with line breaks inside of quotes: all columns as text, named by the header.

    Rows are those of a parse in one task (``multi_line``), but a file is as many tasks as it has blocks. A short record is
    completed with nulls. To ``rejects`` go records with too many fields, and the lines of a value that its file never
    closes. Files whose headers differ raise an error. A record is one value, so the longest must fit in a task.
    """
    options = {"sep": sep, "escape": '"', "multiLine": "true"}
    names = spark.read.options(**options, header=True).csv(path).columns
    fields = [f"c{i}" for i in range(len(names))]
    records = csv_records(spark, path, sep=sep)

    def parsed(text: Column, n: int, extra: str = "") -> Column:
        return F.from_csv(text, ", ".join(f"c{i} string" for i in range(n)) + extra, {**options, "columnNameOfCorruptRecord": _BAD})

    # As in scan_csv: a letter behind the record makes an empty last field a value.
    spare = parsed(F.concat("record", F.lit("x")), len(names) + 1).getField(f"c{len(names)}").isNotNull()
    rows = records.select("*", parsed(F.col("record"), len(names), f", {_BAD} string").alias("parsed"))
    reason = (
        F.when(~F.col("closed"), "open quote")
        .when(F.col("parsed").getField(_BAD).isNotNull() & spare, "too many fields")
    )
    found = F.array(*[F.col("parsed").getField(c) for c in fields])
    # Blank names are numbered by the reader, so such a header is not compared, as in scan_csv.
    # The reader turns line ends in names into line feeds.
    expected = F.array(*[F.lit(c) for c in names])
    found = F.transform(found, lambda c: F.replace(c, F.lit("\r\n"), F.lit("\n")))
    blank = any(name == f"_c{i}" for i, name in enumerate(names))
    differs = F.lit(False) if blank else F.col("closed") & ~found.eqNullSafe(expected)
    wrong = F.raise_error(F.concat(F.lit("the header differs from that of other files: "), F.col("file"))).cast("boolean")
    body = F.when(F.col("header"), F.when(differs, wrong).otherwise(False)).otherwise(True)
    rows = rows.where(body).withColumn("reason", reason)
    watched = rows.observe(observation, F.count("reason").alias("n_rejected")) if observation else rows

    def clean(field: str, name: str) -> Column:
        column = F.col("parsed").getField(field)
        return (F.when(~column.isin(*missing), column) if missing else column).alias(name)

    place = [F.col(c).alias(p) for c, p in zip(("name", "block", "row"), POSITION)] if with_position else []
    return CsvTable(
        watched.where(F.col("reason").isNull()).select(*[clean(c, n) for c, n in zip(fields, names)], *place),
        rows.where(F.col("reason").isNotNull()).select("file", F.col("record").alias("line"), "reason"))
