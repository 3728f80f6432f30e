"""Event tables of one source table: read once, with visits and persons of all kinds of rows."""

from __future__ import annotations

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from clinspark.operators.concepts import EVENT_SOURCES, event_union, events_of_rows, shared_rows, shared_sources
from clinspark.plans.omop import omop_convert, omop_prepare

EVENT = "patient string, encounter string, code string, start timestamp_ntz, stop timestamp_ntz, date timestamp_ntz"
DAY = "2010-01-0"


@pytest.fixture
def tables(spark):
    patients = spark.createDataFrame([(p, None, None) for p in "abc"], "id string, birthdate date, deathdate date")
    visits = spark.createDataFrame(
        [("e1", "a", ts(DAY + "1"), ts(DAY + "1"), "wellness"), ("e2", "b", ts(DAY + "2"), ts(DAY + "2"), "inpatient"),
         ("e3", None, ts(DAY + "3"), ts(DAY + "3"), "wellness")],
        "id string, patient string, start timestamp_ntz, stop timestamp_ntz, encounterclass string")
    events = spark.createDataFrame(
        [(patient, encounter, code, ts(DAY + str(1 + n % 3)), ts(DAY + str(2 + n % 3)), ts(DAY + str(3 + n % 3)))
         for n, (patient, encounter, code) in enumerate(
             [("a", "e1", "1"), ("b", "e2", "2"), ("a", "e2", "1"), ("c", None, "3"), ("d", "e1", "1"), (None, "e3", "2"),
              (None, None, None), ("b", "lost", "9"), ("c", "e3", "1"), ("a", "e1", "1")])], EVENT)
    shared = {name: events for name in ("conditions", "medications", "procedures", "observations")}
    return {"patients": patients, "encounters": visits, **shared}


def vocabulary(spark):
    concept = spark.createDataFrame(
        [(c * 10 + v, name, str(c), domain, "S", None) for v, name in enumerate(["SNOMED", "RxNorm", "LOINC"])
         for c, domain in ((1, "Procedure"), (2, "Drug"), (3, "Specimen"))],
        "concept_id bigint, vocabulary_id string, concept_code string, domain_id string, standard_concept string, invalid_reason string")
    links = spark.createDataFrame([], "concept_id_1 bigint, concept_id_2 bigint, relationship_id string, invalid_reason string")
    return concept, links


def test_a_shared_table_is_read_once(spark, tables):
    prepared = omop_prepare(tables)
    present = [s for s in EVENT_SOURCES if s.source in prepared]
    groups = shared_sources(prepared, present)
    assert len(groups) == 1 and len(groups[0]) == 4
    base = shared_rows(prepared, groups)
    assert base.count() == 10
    names = event_union(prepared, present).columns
    assert rows(events_of_rows(base, groups), *names) == rows(event_union(prepared, present), *names)
    apart = {**prepared, "procedures": prepared["procedures"].where(F.lit(True))}
    groups = shared_sources(apart, present)
    assert [len(g) for g in groups] == [3, 1]
    assert rows(events_of_rows(shared_rows(apart, groups), groups), *names) == rows(event_union(apart, present), *names)


@pytest.mark.parametrize("apart", [False, True])
def test_visits_and_persons(spark, staging, tables, apart):
    concept, links = vocabulary(spark)
    if apart:
        tables = {n: df.where(F.lit(True)) for n, df in tables.items()}
    targets = ["condition_occurrence", "procedure_occurrence", "drug_exposure", "measurement"]
    found = omop_convert(tables, concept, staging, targets=["person", "visit_occurrence", *targets], relationship=links)
    person = {r["person_source_value"]: r["person_id"] for r in found["person"].collect()}
    visit = {("a", "e1"): 1, ("b", "e2"): 2, (None, "e3"): 3}
    first = {r["visit_start_date"].day: r["visit_occurrence_id"] for r in found["visit_occurrence"].collect()}
    visit = {encounter: first[n] for (_, encounter), n in visit.items()}
    domain = {"1": "procedure_occurrence", "2": "drug_exposure"}
    want = {t: [] for t in targets}
    for name, own in (("conditions", "condition_occurrence"), ("medications", "drug_exposure"),
                      ("procedures", "procedure_occurrence"), ("observations", "measurement")):
        for r in tables[name].collect():
            start = r["date"] if name == "observations" else r["start"]
            want[domain.get(r["code"], own)].append((person.get(r["patient"]), visit.get(r["encounter"]), r["code"], start))
    key = lambda t: tuple((v is not None, str(v)) for v in t)
    for target, prefix, first in (
            ("condition_occurrence", "condition", "condition_start"), ("procedure_occurrence", "procedure", "procedure"),
            ("drug_exposure", "drug", "drug_exposure_start"), ("measurement", "measurement", "measurement")):
        got = found[target].select("person_id", "visit_occurrence_id", f"{prefix}_source_value", f"{first}_datetime").collect()
        assert sorted(map(tuple, got), key=key) == sorted(want[target], key=key), target
        numbers = sorted(r[0] for r in found[target].select(f"{target}_id").collect())
        assert numbers == list(range(1, len(numbers) + 1))
