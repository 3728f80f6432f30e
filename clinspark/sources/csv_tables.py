"""CSV tables: all text first, then types; malformed lines are set aside, not guessed at."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.functions.columns import is_code_column, lower_columns
from clinspark.functions.dates import parse_dates
from clinspark.spec import TableSpec

# Texts read as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

#: Order of the rows in the source: file, then block of the file, then row of the block.
POSITION = ("_source_file", "_source_block", "_source_row")

_BAD_LINE = "_bad_line"
_SHORT_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_LONG_WHOLE = r"^\s*[+-]?\d{19,}\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_TRUTH = r"^(True|TRUE|true|False|FALSE|false)$"
_WHOLE, _FRACTION, _BOOLEAN, _TEXT = 1, 2, 4, 8


@dataclass(frozen=True)
class CsvTable:
    """Rows that fit the header, and the lines that don't, with the reason: ``too many fields`` or ``open quote``."""

    rows: DataFrame
    rejects: DataFrame


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    missing: Sequence[str] = MISSING_TEXTS,
    with_position: bool = False,
    sep: str = ",",
    multi_line: bool = False,
    observation: Observation | None = None,
) -> CsvTable:
    """All columns as text, named by the header.

    A line with too few fields is completed with nulls, unless it has an odd number of quotes: then it is part of a
    value with a line break and goes to ``rejects``. A line with too many has shifted columns (an unquoted separator)
    and goes there too. ``multi_line`` allows line breaks inside quotes but makes a file unsplittable, so it is off
    unless asked for. An ``observation`` learns ``n_rejected`` from the first job that reads ``rows``. Files whose
    headers differ raise an error, unless a header has blank names.
    """
    options = {"sep": sep, "header": True, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    options["enforceSchema"] = any(name == f"_c{i}" for i, name in enumerate(names))
    texts = [T.StructField(c, T.StringType()) for c in names]
    raw = (
        # Without pruning every read sees the whole line and so flags the same lines.
        spark.read.options(
            **options, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD_LINE, columnPruning=False
        )
        .schema(T.StructType([*texts, T.StructField(_BAD_LINE, T.StringType())]))
        .csv(path)
    )
    # Parsing a bad line once more with one column to spare tells a long line from a short one; the
    # letter behind it makes an empty last field a value.
    spare = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    parsed = F.from_csv(F.concat(_BAD_LINE, F.lit("x")), spare, {"sep": sep, "escape": '"'})
    too_long = F.col(_BAD_LINE).isNotNull() & parsed.getField(f"c{len(names)}").isNotNull()
    # Spark refuses to read nothing but the bad line, so the filter also looks at a parsed column.
    too_long = too_long & (F.length(F.concat_ws("", F.col(f"`{names[0]}`"), F.col(_BAD_LINE))) > 0)

    def clean(name: str) -> Column:
        column = F.col(f"`{name}`")
        return F.when(~column.isin(*missing), column).alias(name) if missing else column

    open_quote = F.coalesce(F.length(F.regexp_replace(_BAD_LINE, '[^"]', "")) % 2 == 1, F.lit(False))
    bad = too_long if multi_line else too_long | open_quote
    watched = raw.observe(observation, F.count_if(bad).alias("n_rejected")) if observation else raw
    rows = watched.where(~bad).select(*[clean(c) for c in names], *(_position() if with_position else ()))
    rejects = raw.where(bad).select(
        F.col("_metadata.file_path").alias("file"), F.col(_BAD_LINE).alias("line"),
        F.when(too_long, "too many fields").otherwise("open quote").alias("reason"),
    )
    return CsvTable(rows, rejects)


def _position() -> list[Column]:
    return [
        F.col("_metadata.file_name").alias(POSITION[0]),
        F.col("_metadata.file_block_start").alias(POSITION[1]),
        F.monotonically_increasing_id().alias(POSITION[2]),
    ]


def _kind(value: Column) -> Column:
    # Patterns come before the cast, since a failing try_cast costs far more than a pattern. A whole
    # number too long for bigint would lose digits as a double, so it stays text.
    return (
        F.when(value.rlike(_SHORT_WHOLE), _WHOLE)
        .when(value.rlike(_LONG_WHOLE), F.when(value.try_cast("bigint").isNotNull(), _WHOLE).otherwise(_TEXT))
        .when(value.rlike(_NUMBER), _FRACTION)
        .when(value.rlike(_TRUTH), _BOOLEAN)
        .otherwise(_TEXT)
    )


def infer_types(
    df: DataFrame, columns: Iterable[str], first_pass: Callable[[DataFrame], bool] | None = None
) -> dict[str, str]:
    """Narrowest of bigint, double, boolean and string that holds every value of a text column.

    One aggregation over all rows and columns: no sample, and what is shuffled is one row per task
    and column. The columns are turned into rows first, because one aggregate per column would make
    generated code too long for the JVM to compile. A ``first_pass`` that runs a job over all rows it is given, and
    says so, saves that: the types are observed in its job.
    """
    columns = list(columns)
    if not columns:
        return {}
    if first_pass:
        seen = Observation()
        kinds = [F.bit_or(F.when(F.col(f"`{c}`").isNotNull(), _kind(F.col(f"`{c}`")))).alias(f"kinds_{i}") for i, c in enumerate(columns)]
        if first_pass(df.observe(seen, *kinds)):
            return {c: _type_of(seen.get[f"kinds_{i}"] or 0) for i, c in enumerate(columns)}
    value = F.col("value")
    values = df.select(F.posexplode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("column", "value"))
    found = values.where(value.isNotNull()).groupBy("column").agg(F.bit_or(_kind(value)).alias("kinds"))
    kinds = {row["column"]: row["kinds"] for row in found.collect()}
    return {c: _type_of(kinds.get(i, 0)) for i, c in enumerate(columns)}


def _type_of(kinds: int) -> str:
    """Type for the kinds of values seen; a column without values becomes a number."""
    if kinds == _WHOLE:
        return "bigint"
    if kinds == _BOOLEAN:
        return "boolean"
    return "double" if kinds in (0, _FRACTION, _WHOLE | _FRACTION) else "string"


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    casts = {c: F.trim(F.col(f"`{c}`")).cast(t) for c, t in types.items() if t != "string"}
    return df.withColumns(casts) if casts else df


def read_table(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    *,
    with_position: bool = False,
    quoted_breaks: bool = False,
    first_pass: Callable[[DataFrame], bool] | None = None,
    **scan_options,
) -> CsvTable:
    """Scan, lower-case the names, parse the dates, keep codes as text, type the rest.

    Columns whose type the spec pins are not inferred; with all of them pinned there is no
    inference pass over the data. ``quoted_breaks`` reads values with line breaks by blocks (see ``csv_records``).
    ``first_pass`` gets the rows while inferred columns are still text (see ``infer_types``); it isn't called if there are none.
    """
    scan = scan_csv
    if quoted_breaks:
        from clinspark.sources.csv_records import scan_quoted_csv as scan
    table = scan(spark, path, with_position=with_position, **scan_options)
    rows = lower_columns(table.rows)
    pinned = dict(spec.types)
    open_columns = [
        c for c in rows.columns
        if c not in spec.date_columns and c not in pinned and c not in POSITION and not is_code_column(c)
    ]
    present = {c: t for c, t in pinned.items() if c in rows.columns}

    def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
        return parse_dates(apply_types(df, {**types, **present}), spec.date_columns)

    types = infer_types(rows, open_columns, first_pass and (lambda df: first_pass(typed(df, {}))))
    return CsvTable(typed(rows, types), table.rejects)


def read_fixed_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, *, sep: str = "\t", quote: str = ""
) -> CsvTable:
    """A headed file (or folder of part files) with known columns, such as a vocabulary table.

    A line with a value that doesn't fit its column is no row with a null, but a reject.
    """
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    raw = spark.read.schema(T.StructType([*kinds.fields, T.StructField(_BAD_LINE, T.StringType())])).options(
        header=True, sep=sep, quote=quote, dateFormat="yyyyMMdd", columnNameOfCorruptRecord=_BAD_LINE, columnPruning=False,
    ).csv(path)
    # Spark refuses to read nothing but the bad line, so the filter also looks at a parsed column.
    first = F.col(f"`{kinds.fields[0].name}`")
    bad = F.col(_BAD_LINE).isNotNull() & (first.isNull() | first.isNotNull())
    rejects = raw.where(bad).select(
        F.col("_metadata.file_path").alias("file"), F.col(_BAD_LINE).alias("line"), F.lit("bad value").alias("reason"))
    return CsvTable(raw.where(~bad).select(*[f"`{f.name}`" for f in kinds.fields]), rejects)
