"""Provider lists: keep the wanted providers of each kind of facility."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# National provider numbers of the hospitals an option selects.
HOSPITAL_NUMBERS = {"MGUH": 1427145176, "MWHC": 1548378235}
HOSPITAL_ALIASES = {"WHC": "MWHC"}

# Fixed values: (source list, target list, provider numbers); None stands for the chosen hospitals.
CURATION_PLAN: tuple[tuple[str, str, tuple[int, ...] | None], ...] = (
    ("hospitals.csv", "hospice.csv", (1427145176,)),
    ("longterm.csv", "longterm.csv", (1285772772,)),
    ("nursing.csv", "nursing.csv", (1205923604,)),
    ("home_health_agencies.csv", "home_health_agencies.csv", (1407960248,)),
    ("ambulatory_surgical_center.csv", "ambulatory_surgical_center.csv", (1912090432,)),
    ("primary_care_facilities.csv", "primary_care_facilities.csv", (1922395581, 1285636522, 1194374710)),
    ("primary_care_facilities.csv", "primary_care_facilities_children.csv", (1922395581, 1285636522, 1194374710)),
    ("primary_care_facilities.csv", "primary_care_facilities_women.csv", (1922395581, 1285636522, 1194374710)),
    ("hospitals.csv", "dialysis.csv", None),
    ("rehab.csv", "rehab.csv", (1326496456,)),
    ("hospitals.csv", "hospitals.csv", None),
)

URGENT_CARE_TARGET = "urgent_care_facilities.csv"

# The urgent care list, as headed CSV.
URGENT_CARE_LIST = """\
,id,name,address,city,state,zip,county,phone,type,ownership,emergency,quality,LAT,LON
4810,4001,Medstar Promptcare - Adams Morgan,1805 Columbia Rd.,WASHINGTON,DC,20009,DISTRICT OF COLUMBIA,202-797-4960,"URGENT MEDICAL CARE CENTERS AND CLINICS (EXCEPT HOSPITALS), FREESTANDING",Proprietary,No,Not Available,38.922567,-77.043162
4811,4002,Medstar Promptcare - Capitol Hill ,228 7th St. SE,WASHINGTON,DC,20003,DISTRICT OF COLUMBIA,202-698-0795,"URGENT MEDICAL CARE CENTERS AND CLINICS (EXCEPT HOSPITALS), FREESTANDING",Proprietary,No,Not Available,38.886417,-76.995996
"""
URGENT_CARE_SCHEMA = (
    "_c0 bigint, id bigint, name string, address string, city string, state string, zip bigint, "
    "county string, phone string, type string, ownership string, emergency string, quality string, "
    "LAT double, LON double"
)


def hospital_numbers(option: str) -> list[int]:
    """Provider numbers for ``both``, one hospital's name, or its alias."""
    if option == "both":
        return list(HOSPITAL_NUMBERS.values())
    name = HOSPITAL_ALIASES.get(option, option)
    if name not in HOSPITAL_NUMBERS:
        raise ValueError(f"unknown hospital option: {option}")
    return [HOSPITAL_NUMBERS[name]]


def curation_plan(option: str) -> list[tuple[str, str, list[int]]]:
    chosen = hospital_numbers(option)
    return [(source, target, chosen if n is None else list(n)) for source, target, n in CURATION_PLAN]


def provider_number(column: str) -> Column:
    """A number column of any type as bigint: also text with spaces or a zero fraction; null for all else."""
    exact = F.col(f"`{column}`").try_cast("decimal(38,6)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def filter_by_number(df: DataFrame, numbers: Sequence[int | None], column: str = "npi") -> DataFrame:
    """Rows whose provider number is in the list. Null numbers match nothing.

    The list is a table whatever its length; Spark broadcasts it when it is measured small.
    """
    wanted = df.sparkSession.createDataFrame([(n,) for n in sorted({n for n in numbers if n is not None})], "_wanted bigint")
    numbered = df.withColumn("_number", provider_number(column))
    return numbered.join(wanted, F.col("_number") == F.col("_wanted"), "left_semi").select(*_names(df))


def _names(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def fan_out(df: DataFrame, targets: Mapping[str, Iterable[int]], column: str = "npi") -> DataFrame:
    """A copy of each row for every target list that wants its provider, marked with ``target``.

    One scan serves all targets of a source. The wanted lists become an array per row, looked up
    from literals, so nothing is shuffled or joined.
    """
    number = provider_number(column)
    wanted = F.array_compact(
        F.array(*[
            F.when(number.isin([n for n in numbers if n is not None]), F.lit(target))
            for target, numbers in targets.items()
        ])
    )
    every = sorted({n for numbers in targets.values() for n in numbers if n is not None})
    return df.where(number.isin(every)).select("*", F.explode(wanted).alias("target"))


def literal_csv(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """A small table from headed CSV text in the program; indentation and blank lines are ignored."""
    lines = [(line.lstrip(),) for line in text.splitlines()[1:] if line.strip()]
    options = {"quote": '"', "escape": '"'}
    return (
        spark.createDataFrame(lines, "line string")
        .select(F.from_csv("line", schema, options).alias("r"))
        .select("r.*")
    )


def urgent_care(spark: SparkSession) -> DataFrame:
    return literal_csv(spark, URGENT_CARE_LIST, URGENT_CARE_SCHEMA)
