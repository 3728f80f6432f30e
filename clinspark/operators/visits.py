"""Visits: encounters of a patient that overlap or follow each other closely."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.operators.surrogate import number_rows
from clinspark.staging import Staging

_CELL, _VISIT = "_cell", "_visit"


def _cell(start: str, gap_days: int) -> Column:
    return F.floor(F.datediff(F.col(start), F.lit("1970-01-01").cast("date")) / gap_days)


def reduce_to_cells(
    encounters: DataFrame, by: Sequence[str], *, start: str = "start", stop: str = "stop", gap_days: int = 1
) -> DataFrame:
    """One row per cell of ``gap_days`` days: first start, last end, number of encounters."""
    if gap_days < 1:
        raise ValueError("gap_days must be at least 1")
    end = F.when(F.col(start).isNotNull(), F.greatest(F.col(start), F.col(stop)))
    return encounters.groupBy(*by, _cell(start, gap_days).alias(_CELL)).agg(
        F.min(start).alias("_start"), F.max(end).alias("_end"), F.count("*").alias("_n")
    )


def chain_cells(cells: DataFrame, by: Sequence[str], *, gap_days: int) -> DataFrame:
    """Cells with the number of their visit: one that starts within the gap behind all before it goes on with their visit."""
    ordered = Window.partitionBy(*by).orderBy(F.asc_nulls_first(_CELL))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.col("_reach") + F.make_interval(days=F.lit(gap_days))
    opens = F.when(reach.isNull() | (F.col("_start") > reach), 1).otherwise(0)
    return (
        cells.withColumn("_reach", F.max("_end").over(before))
        .withColumn("_opens", opens)
        .withColumn(_VISIT, F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_reach", "_opens")
    )


def visit_cells(
    encounters: DataFrame, by: Sequence[str], *, start: str = "start", stop: str = "stop", gap_days: int = 1
) -> DataFrame:
    """Which visit each cell of ``gap_days`` days belongs to, per ``by``.

    Two encounters that start within one cell are less than the gap apart and so always share a
    visit. Each task therefore first reduces its encounters to one row per cell, exactly. The window
    that joins the cells to visits sees at most one row per ``gap_days`` of the covered time, however
    many encounters a patient has.

    An end before the start (or no end) counts as the start. Encounters without a start form one
    visit without dates.
    """
    return chain_cells(
        reduce_to_cells(encounters, by, start=start, stop=stop, gap_days=gap_days), by, gap_days=gap_days)


def visits_of_cells(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per visit: its keys, first start, last end and number of encounters."""
    return cells.groupBy(*by, _VISIT).agg(
        F.min("_start").alias("visit_start"),
        F.max("_end").alias("visit_end"),
        F.sum("_n").alias("n_encounters"),
    )


def roll_up_visits(
    encounters: DataFrame, by: Sequence[str], *, start: str = "start", stop: str = "stop", gap_days: int = 1
) -> DataFrame:
    """Merge encounters that start no later than the latest end so far plus the gap."""
    cells = visit_cells(encounters, by, start=start, stop=stop, gap_days=gap_days)
    return visits_of_cells(cells, by).drop(_VISIT)


def number_visits(
    cells: DataFrame, by: Sequence[str], staging: Staging, *, visit_id: str = "visit_occurrence_id"
) -> tuple[DataFrame, DataFrame]:
    """Visits with a dense id in the order of ``by`` and start, and the cells with that id."""
    cells = staging.table(cells)
    visits = number_rows(visits_of_cells(cells, by), [*by, "visit_start"], visit_id, staging)
    return visits.drop(_VISIT), _add(cells, visits, [*by, _VISIT], visit_id)


def visit_of_encounter(
    encounters: DataFrame, numbered_cells: DataFrame, by: Sequence[str], *, id: str = "id",
    start: str = "start", gap_days: int = 1, visit_id: str = "visit_occurrence_id", owner: str | None = None,
) -> DataFrame:
    """Every encounter's id with the id of its visit, found through the encounter's cell; with ``owner``, also that column of ``by``."""
    rows = encounters.select(
        F.col(id).alias("id"), *[F.col(c).alias(f"_by_{c}") for c in by], _cell(start, gap_days).alias(_CELL)
    )
    cells = numbered_cells.select(*[F.col(c).alias(f"_by_{c}") for c in by], _CELL, visit_id)
    found = _add(rows, cells, [*[f"_by_{c}" for c in by], _CELL], visit_id)
    return found.select("id", visit_id, *([F.col(f"_by_{owner}").alias(owner)] if owner else []))


def _add(rows: DataFrame, values: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows with a column of another table, matched on keys that may be null."""
    values = values.select(*[F.col(k).alias(f"_of_{k}") for k in keys], column)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return rows.join(values, same, "left").select(*rows.columns, column)


def assign_visits(
    events: DataFrame, encounter_visits: DataFrame, *, encounter: str = "encounter", id: str = "id",
    visit_id: str = "visit_occurrence_id",
) -> DataFrame:
    """Events with the visit of their encounter; null without encounter or visit.

    ``encounter_visits`` has one row per encounter ``id``. The events are read once; rows of one encounter, or without
    any, are the large side of the join, which Spark splits.
    """
    visits = encounter_visits.select(F.col(id).alias("_encounter_id"), visit_id)
    return events.join(visits, F.col(encounter) == F.col("_encounter_id"), "left").drop("_encounter_id")
