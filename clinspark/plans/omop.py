"""OMOP job: source tables in the older shape, then person, visit and event tables (CDM 5.4)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.functions.columns import cast_codes, rename_back, rename_columns
from clinspark.functions.dates import parse_instant
from clinspark.operators.concepts import (
    EVENT_SOURCES, event_union, events_of_rows, map_concepts, shared_rows, shared_sources,
)
from clinspark.operators.surrogate import KeyStore, number_rows
from clinspark.operators.visits import assign_visits, number_visits, visit_cells, visit_of_encounter
from clinspark.operators.vocabulary import code_entries, concept_lookup, concept_targets, route_by_domain, with_entry
from clinspark.staging import Staging

# Code columns widened to text, and the renamed columns of payer_transitions.
CODE_COLUMNS = {
    "allergies": ("code",),
    "immunizations": ("code",),
    "conditions": ("code",),
    "devices": ("code",),
    "encounters": ("code", "reasoncode"),
    "imaging_studies": ("bodysite_code", "procedure_code"),
    "medications": ("code",),
    "observations": ("code",),
    "procedures": ("code", "reasoncode"),
    "claims": ("diagnosis1",),
}
RENAMED_COLUMNS = {"payer_transitions": {"start_date": "start_year", "end_date": "end_year"}}
INSTANT_COLUMNS = {"claims": ("currentillnessdate",)}

# Public visit concepts of the encounter classes, 0 for others.
VISIT_CONCEPTS = {
    "inpatient": 9201,
    "emergency": 9203,
    "urgentcare": 9203,
    "ambulatory": 9202,
    "outpatient": 9202,
    "wellness": 9202,
}

# Column names of the event tables (key prefix, date prefix, has an end date).
EVENT_LAYOUT = {
    "condition_occurrence": ("condition", "condition_start", "condition_end"),
    "drug_exposure": ("drug", "drug_exposure_start", "drug_exposure_end"),
    "procedure_occurrence": ("procedure", "procedure", "procedure_end"),
    "measurement": ("measurement", "measurement", None),
    "device_exposure": ("device", "device_exposure_start", "device_exposure_end"),
    "observation": ("observation", "observation", None),
}


def omop_prepare(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Views with text codes, parsed instants and the older column names; sources stay as they are."""
    prepared, cast = dict(tables), {}
    for name, columns in CODE_COLUMNS.items():
        if name in prepared:
            present = tuple(c for c in columns if c in prepared[name].columns)
            # Names of one and the same DataFrame go on sharing it.
            key = id(tables[name]), present
            if present and key not in cast:
                cast[key] = cast_codes(prepared[name], present)
            prepared[name] = cast.get(key, prepared[name])
    for name, columns in INSTANT_COLUMNS.items():
        if name in prepared:
            present = [c for c in columns if c in prepared[name].columns]
            if present:
                prepared[name] = prepared[name].withColumns({c: parse_instant(F.col(c).cast("string")) for c in present})
    for name, names in RENAMED_COLUMNS.items():
        if name in prepared:
            prepared[name] = rename_columns(prepared[name], names)
    return prepared


def omop_restore(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The current column names again."""
    return {
        name: rename_back(df, RENAMED_COLUMNS[name]) if name in RENAMED_COLUMNS else df
        for name, df in tables.items()
    }


def person_table(patients: DataFrame, staging: Staging, keys: KeyStore | None = None) -> DataFrame:
    """Persons, numbered in the order of their source ids, or by ``keys``, which keep the numbers of earlier loads."""
    people = patients.select("id", "birthdate", "deathdate")
    if keys:
        numbered = keys.add(people, staging)
    else:
        numbered = number_rows(people, ["id"], "person_id", staging)
    return numbered.select(
        "person_id",
        F.year("birthdate").cast("bigint").alias("year_of_birth"),
        F.month("birthdate").cast("bigint").alias("month_of_birth"),
        F.day("birthdate").cast("bigint").alias("day_of_birth"),
        F.col("birthdate").cast("timestamp_ntz").alias("birth_datetime"),
        F.col("deathdate").alias("death_date"),
        F.col("id").alias("person_source_value"),
    )


def visit_tables(
    encounters: DataFrame, persons: DataFrame, staging: Staging, *, visit_class: str | None = "encounterclass",
    gap_days: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Visits with their ids, and the visit id and the patient of every encounter; the class is part of a visit's key."""
    by = ["patient", visit_class] if visit_class else ["patient"]
    visits, cells = number_visits(visit_cells(encounters, by, gap_days=gap_days), by, staging)
    concept = F.lit(0)
    if visit_class:
        for value, concept_id in VISIT_CONCEPTS.items():
            concept = F.when(F.lower(visit_class) == value, F.lit(concept_id)).otherwise(concept)
    people = persons.select("person_id", F.col("person_source_value").alias("patient"))
    occurrences = visits.join(people, "patient", "left").select(
        "visit_occurrence_id",
        "person_id",
        concept.cast("bigint").alias("visit_concept_id"),
        F.col("visit_start").cast("date").alias("visit_start_date"),
        F.col("visit_start").alias("visit_start_datetime"),
        F.col("visit_end").cast("date").alias("visit_end_date"),
        F.col("visit_end").alias("visit_end_datetime"),
    )
    return occurrences, visit_of_encounter(encounters, cells, by, gap_days=gap_days, owner="patient")


def event_table(events: DataFrame, target: str, staging: Staging) -> DataFrame:
    """One target's rows under the column names of its event table, numbered in the order of their columns.

    Rows that are equal in all columns may take each other's numbers; nothing else depends on chance. If ``events`` has the
    places of a stored table, these stand behind the columns, and equal rows are dealt to many ranges.
    """
    key, first, last = EVENT_LAYOUT[target]
    stored = ["person_id", "concept_id", "start_datetime", *(["end_datetime"] if last else []), "visit_occurrence_id", "code",
              *[c for c in events.columns if c == "source_concept_id"]]
    rows = events.where(F.col("target") == target).select(*stored, *[c for c in events.columns if c == PLACE])  # the last one
    # Dates follow from their times, so they are in the same order and are made at the end.
    numbered = number_rows(rows, rows.columns, f"{target}_id", staging, keep=stored)
    ends = []
    if last:
        ends = [
            F.col("end_datetime").cast("date").alias(f"{last}_date"),
            F.col("end_datetime").alias(f"{last}_datetime"),
        ]
    sources = [F.col("source_concept_id").alias(f"{key}_source_concept_id")] if "source_concept_id" in stored else []
    return numbered.select(
        f"{target}_id",
        "person_id",
        F.col("concept_id").alias(f"{key}_concept_id"),
        F.col("start_datetime").cast("date").alias(f"{first}_date"),
        F.col("start_datetime").alias(f"{first}_datetime"),
        *ends,
        "visit_occurrence_id",
        F.col("code").alias(f"{key}_source_value"),
        *sources,
    )


#: A small number from where a row lies in the stored table it was read from: equal rows are dealt by it.
PLACE = "_source_place"
_DEALT = 4096


def with_place(stored: DataFrame) -> DataFrame:
    place = F.pmod(F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")), F.lit(_DEALT))
    return stored.withColumn(PLACE, place.cast("smallint"))


#: What a code takes on the driver for each vocabulary, if ``code_entries`` are a broadcast (measured: 590 for three).
ENTRY_BYTES = 200

#: Targets that are no event table.
PLAIN_TARGETS = ("person", "death", "visit_occurrence")


def omop_convert(
    tables: Mapping[str, DataFrame], concept: DataFrame, staging: Staging, *, gap_days: int = 1,
    targets: Iterable[str] | None = None, relationship: DataFrame | None = None, person_keys: KeyStore | None = None,
) -> dict[str, DataFrame]:
    """Person, death, visit and event tables of linked clinical tables.

    Only what ``targets`` asks for is built, and what it rests on; without it, all that the tables allow. With the
    vocabulary's ``relationship`` table, codes become standard concepts along its chains, the code's own concept is kept
    beside them, and an event goes to the table of its concept's domain. Without it, a code gets its own concept and
    each source feeds one table. ``person_keys`` keep person ids over loads.
    """
    prepared = omop_prepare(tables)
    chosen = (*PLAIN_TARGETS, *EVENT_LAYOUT) if targets is None else tuple(targets)
    unknown = sorted(set(chosen) - {*PLAIN_TARGETS, *EVENT_LAYOUT})
    if unknown:
        raise ValueError(f"unknown targets: {unknown}")
    persons = staging.table(person_table(prepared["patients"], staging, person_keys))
    result = {}
    if "person" in chosen:
        result["person"] = persons.drop("death_date")
    if "death" in chosen:
        result["death"] = persons.where(F.col("death_date").isNotNull()).select("person_id", "death_date")
    people = persons.select("person_id", "person_source_value")
    present = [s for s in EVENT_SOURCES if s.source in prepared]
    fed = {t: present if relationship is not None else [s for s in present if s.target == t] for t in EVENT_LAYOUT}
    wanted = [t for t in EVENT_LAYOUT if t in chosen and fed[t]]
    if "visit_occurrence" in chosen or wanted:
        visits, encounter_visits = visit_tables(prepared["encounters"], persons, staging, gap_days=gap_days)
        if "visit_occurrence" in chosen:
            result["visit_occurrence"] = visits
    if wanted and relationship is not None:
        lookup = staging.table(concept_lookup(concept, staging.table(concept_targets(concept, relationship, staging))))
        # A table is read once and moved once for its encounters and once for its codes, whatever number of sources it
        # feeds: rows become events where they have met both, and only events of wanted targets go on.
        groups = shared_sources(prepared, present)
        rows = shared_rows(prepared, groups)
        vocabs = sorted({s.vocab for s in present})
        entries = staging.side(code_entries(rows, lookup, vocabs, staging), ENTRY_BYTES * len(vocabs))
        placed = _with_owner(rows, encounter_visits, people, staging).drop("person_source_value", "encounter")
        placed = placed.join(entries.withColumnRenamed("code", "_known"), F.col("code") == F.col("_known"), "left")
        routed = route_by_domain(with_entry(events_of_rows(placed.drop("_known"), groups)))
        routed = routed.where(F.col("target").isin(wanted)).drop("domain_id", "vocab")
        path = staging.path("events")
        routed.write.mode("overwrite").partitionBy("target").parquet(path)
        events = with_place(staging.spark.read.schema(routed.schema).parquet(path))
        return {**result, **{t: event_table(events, t, staging) for t in wanted}}
    if wanted:
        encounter_visits = staging.table(encounter_visits.drop("patient"))
    for target in wanted:
        events = map_concepts(event_union(prepared, fed[target]), concept, stage=staging)
        result[target] = event_table(_placed(events, encounter_visits, people), target, staging)
    return result


def _placed(events: DataFrame, encounter_visits: DataFrame, people: DataFrame) -> DataFrame:
    """Events with their visit and their person."""
    return assign_visits(events, encounter_visits).join(people, "person_source_value", "left")


def _with_owner(rows: DataFrame, encounter_visits: DataFrame, people: DataFrame, staging: Staging) -> DataFrame:
    """Rows with their visit and their person, as ``_placed`` gives them.

    An encounter brings its patient's person along. Only patients of rows without an encounter, or with that of another
    patient, are looked up by themselves; their list is stored, so that its size is known before it meets the rows.
    """
    people = staging.side(people)
    of_patient = people.select(F.col("person_source_value").alias("_patient"), F.col("person_id").alias("_owner_person"))
    owners = staging.table(
        encounter_visits.select(F.col("id").alias("_encounter_id"), "visit_occurrence_id", F.col("patient").alias("_owner"))
        .join(of_patient, F.col("_owner") == F.col("_patient"), "left").drop("_patient"))
    same = F.col("person_source_value").eqNullSafe(F.col("_owner"))
    found = rows.join(owners, F.col("encounter") == F.col("_encounter_id"), "left")
    others = found.where(~same).select(F.col("person_source_value").alias("_other")).distinct()
    others = staging.side(staging.table(others.join(people, F.col("_other") == F.col("person_source_value")).select(
        "_other", F.col("person_id").alias("_other_person"))))
    found = found.join(others, ~same & (F.col("person_source_value") == F.col("_other")), "left")
    person = F.when(same, F.col("_owner_person")).otherwise(F.col("_other_person"))
    return found.select(*rows.columns, "visit_occurrence_id", person.alias("person_id"))
