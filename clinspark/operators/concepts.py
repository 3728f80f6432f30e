"""Source codes to concepts, and event rows in the shape of the common data model."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.staging import Stage, lazily

# Fixed value: the concept of a code without a match.
NO_CONCEPT = 0


def map_concepts(
    df: DataFrame, concept: DataFrame, *, vocab: str = "vocab", code: str = "code",
    concept_id: str = "concept_id", stage: Stage = lazily,
) -> DataFrame:
    """Rows with the code's own concept of their (vocabulary, code); 0 when there is none. See ``map_to_standard``.

    Only the distinct codes in use meet the concept table, so the map is small however many rows use
    it, and once staged its size is known before the rows are joined.
    """
    used = df.where(F.col(code).isNotNull() & F.col(vocab).isNotNull()).select(vocab, code).distinct()
    # One concept per code, so that a repeated code cannot multiply rows: a valid one first, then the smallest.
    invalid = F.lit(False)
    if "invalid_reason" in concept.columns:
        invalid = F.coalesce(F.trim("invalid_reason"), F.lit("")) != ""
    known = concept.groupBy(F.col("vocabulary_id").alias("_vocab"), F.col("concept_code").alias("_code")).agg(
        F.min(F.struct(invalid.alias("invalid"), "concept_id"))["concept_id"].alias("_concept"))
    mapping = stage(
        used.join(known, (F.col(vocab) == F.col("_vocab")) & (F.col(code) == F.col("_code"))).select(
            F.col(vocab).alias("_m_vocab"), F.col(code).alias("_m_code"), "_concept"
        )
    )
    found = df.join(mapping, (F.col(vocab) == F.col("_m_vocab")) & (F.col(code) == F.col("_m_code")), "left")
    return found.select(*df.columns, F.coalesce("_concept", F.lit(NO_CONCEPT)).cast("bigint").alias(concept_id))


@dataclass(frozen=True)
class EventSource:
    """How the rows of a source table become events of one target."""

    target: str
    source: str
    vocab: str
    person: str = "patient"
    encounter: str | None = "encounter"
    code: str = "code"
    start: str = "start"
    stop: str | None = "stop"


# Source tables of the event tables.
EVENT_SOURCES: tuple[EventSource, ...] = (
    EventSource("condition_occurrence", "conditions", "SNOMED"),
    EventSource("drug_exposure", "medications", "RxNorm"),
    EventSource("drug_exposure", "immunizations", "CVX", start="date", stop=None),
    EventSource("procedure_occurrence", "procedures", "SNOMED"),
    EventSource("measurement", "observations", "LOINC", start="date", stop=None),
    EventSource("device_exposure", "devices", "SNOMED"),
    EventSource("observation", "allergies", "SNOMED"),
)

EVENT_COLUMNS = (
    "target", "person_source_value", "encounter", "vocab", "code", "start_datetime", "end_datetime",
)


def event_rows(df: DataFrame, source: EventSource) -> DataFrame:
    """One source's rows in the common event columns; a source without an end ends at its start."""
    kind = df.schema[source.person].dataType
    encounter = F.col(source.encounter) if source.encounter else F.lit(None).cast(kind)
    stop = F.col(source.stop) if source.stop else F.col(source.start)
    return df.select(
        F.lit(source.target).alias("target"),
        F.col(source.person).alias("person_source_value"),
        encounter.alias("encounter"),
        F.lit(source.vocab).alias("vocab"),
        F.col(source.code).cast("string").alias("code"),
        F.col(source.start).alias("start_datetime"),
        stop.alias("end_datetime"),
    )


def event_union(tables: Mapping[str, DataFrame], sources: Iterable[EventSource] = EVENT_SOURCES) -> DataFrame:
    """Events of all sources in one table; ``target`` says which event table a row belongs to."""
    return reduce(DataFrame.unionByName, [event_rows(tables[s.source], s) for s in sources])


def shared_sources(tables: Mapping[str, DataFrame], sources: Iterable[EventSource]) -> list[list[EventSource]]:
    """Sources in groups that take person, encounter and code from the same columns of one and the same DataFrame."""
    groups = {}
    for s in sources:
        groups.setdefault((id(tables[s.source]), s.person, s.encounter, s.code), []).append(s)
    return list(groups.values())


def _times(group: Sequence[EventSource]) -> list[str]:
    return list(dict.fromkeys(name for s in group for name in (s.start, s.stop or s.start)))


def shared_rows(tables: Mapping[str, DataFrame], groups: Sequence[Sequence[EventSource]]) -> DataFrame:
    """Each row of a group's table once, with all times its sources take, whatever number of sources it feeds."""
    parts = []
    for i, group in enumerate(groups):
        df, s = tables[group[0].source], group[0]
        encounter = F.col(s.encounter) if s.encounter else F.lit(None).cast(df.schema[s.person].dataType)
        parts.append(df.select(
            F.lit(i).alias("_group"), F.col(s.person).alias("person_source_value"), encounter.alias("encounter"),
            F.col(s.code).cast("string").alias("code"),
            *[F.col(name).alias(f"_time_{j}") for j, name in enumerate(_times(group))]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def events_of_rows(rows: DataFrame, groups: Sequence[Sequence[EventSource]]) -> DataFrame:
    """``shared_rows`` as events: one row for each source of its group, with ``target``, ``vocab`` and its own times."""
    each = None
    for i, group in enumerate(groups):
        at = {name: F.col(f"_time_{j}") for j, name in enumerate(_times(group))}
        found = F.array(*[
            F.struct(F.lit(s.target).alias("target"), F.lit(s.vocab).alias("vocab"), at[s.start].alias("start_datetime"),
                     at[s.stop or s.start].alias("end_datetime")) for s in group])
        each = F.when(F.col("_group") == i, found) if each is None else each.when(F.col("_group") == i, found)
    kept = [c for c in rows.columns if c != "_group" and not c.startswith("_time_")]
    return rows.select(*kept, F.inline(each))
