"""What is known only by the size of its files is no broadcast where it may be millions of rows."""

from __future__ import annotations

import pytest
from helpers import plan, rows, ts
from pyspark.sql import functions as F

from clinspark.operators.vocabulary import concept_lookup, concept_targets, next_concepts
from clinspark.plans.omop import omop_convert
from clinspark.staging import Staging

LINK = "concept_id_1 bigint, concept_id_2 bigint, relationship_id string, invalid_reason string"


class Watched(Staging):
    """Keeps the plan of each stored table."""

    def __init__(self, spark):
        super().__init__(spark)
        self.plans = []

    def table(self, df, name=None):
        self.plans.append(plan(df))
        return super().table(df, name)

    __call__ = table


@pytest.fixture
def vocabulary(spark, staging):
    """Stored, so that Spark knows how small the files are: every third concept is standard, the others map to the next."""
    concept = spark.range(60).select(
        F.col("id").alias("concept_id"), F.lit("SNOMED").alias("vocabulary_id"), F.col("id").cast("string").alias("concept_code"),
        F.when(F.col("id") % 2 == 0, "Procedure").otherwise("Drug").alias("domain_id"),
        F.when(F.col("id") % 3 == 0, "S").alias("standard_concept"), F.lit(None).cast("string").alias("invalid_reason"))
    links = spark.range(60).where("id % 3 != 0").select(
        F.col("id").alias("concept_id_1"), (F.col("id") + 1).alias("concept_id_2"), F.lit("Maps to").alias("relationship_id"),
        F.lit(None).cast("string").alias("invalid_reason"))
    return staging.table(concept), staging.table(links)


def reached(i):
    return -(-i // 3) * 3


def test_a_vocabulary_is_no_broadcast(spark, vocabulary):
    concept, links = vocabulary
    watched = Watched(spark)
    targets = concept_targets(concept, links, watched)
    watched.plans += [plan(next_concepts(concept, links)), plan(targets)]
    lookup = concept_lookup(concept, watched.table(targets))
    watched.plans.append(plan(lookup))
    assert sum("Join" in p for p in watched.plans) >= 4
    assert not [p for p in watched.plans if "Broadcast" in p]
    want = [("SNOMED", str(i), i, reached(i), "Drug" if reached(i) % 2 else "Procedure") for i in range(58)]
    want += [("SNOMED", str(i), i, 0, None) for i in (58, 59)]  # 60 is no concept
    assert rows(lookup) == sorted(want, key=str)


def test_nodes_are_not_moved_again_for_the_aggregate(vocabulary):
    tree = plan(next_concepts(*vocabulary))
    assert tree[: tree.index("\n\n(1)")].count("Exchange") <= 5  # the links twice; the ends twice, of which one may be reused


def test_a_side_goes_by_its_rows(spark, staging):
    few, many = (staging.table(spark.range(n).select("id", (F.col("id") % 2).alias("person_id"))) for n in (1_000, 200_000))
    wide = staging.table(spark.range(10).select(F.col("id").alias("patient")))
    joined = lambda side: plan(wide.join(side, F.col("patient") == F.col("id"), "left"))
    assert "Broadcast" in joined(many) and "Broadcast" in joined(staging.side(few))
    assert "Broadcast" not in joined(staging.side(many)) and "SortMergeJoin" in joined(staging.side(many))


def test_entries_and_persons_go_by_their_rows(spark, vocabulary, monkeypatch):
    concept, links = vocabulary
    day = ts("2015-01-01")
    patients = spark.createDataFrame([(p, None, None) for p in "ab"], "id string, birthdate date, deathdate date")
    visits = spark.createDataFrame(
        [("e1", "a", day, day, "wellness")], "id string, patient string, start timestamp_ntz, stop timestamp_ntz, encounterclass string")
    events = spark.createDataFrame(
        [("a", "e1", "1", day, day), ("b", "e1", "5", day, day), ("b", None, "x", day, day)],
        "patient string, encounter string, code string, start timestamp_ntz, stop timestamp_ntz")
    asked = []
    side = Staging.side
    monkeypatch.setattr(Staging, "side", lambda self, df, n=64: asked.append((df.columns, n)) or side(self, df, n * 10_000_000))
    found = omop_convert(
        {"patients": patients, "encounters": visits, "procedures": events}, concept, Staging(spark),
        targets=["procedure_occurrence", "drug_exposure"], relationship=links)
    assert [(set(c), n) for c, n in asked] == [
        ({"code", "entries"}, 200), ({"person_id", "person_source_value"}, 64), ({"_other", "_other_person"}, 64)]
    assert rows(found["procedure_occurrence"], "person_id", "procedure_concept_id", "procedure_source_value", "visit_occurrence_id") == [
        (2, 0, "x", None), (2, 6, "5", 1)]
    assert rows(found["drug_exposure"], "person_id", "drug_concept_id", "drug_source_value", "visit_occurrence_id") == [(1, 3, "1", 1)]
