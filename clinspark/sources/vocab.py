"""Vocabulary files of the OMOP common data model (Athena layout: headed, tab-separated, unquoted)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from clinspark.sources.csv_tables import CsvTable, read_fixed_csv

# The public CDM 5.4 vocabulary tables.
VOCABULARY_SCHEMAS = {
    "concept": (
        "concept_id bigint, concept_name string, domain_id string, vocabulary_id string, "
        "concept_class_id string, standard_concept string, concept_code string, "
        "valid_start_date date, valid_end_date date, invalid_reason string"
    ),
    "vocabulary": (
        "vocabulary_id string, vocabulary_name string, vocabulary_reference string, "
        "vocabulary_version string, vocabulary_concept_id bigint"
    ),
    "domain": "domain_id string, domain_name string, domain_concept_id bigint",
    "concept_class": "concept_class_id string, concept_class_name string, concept_class_concept_id bigint",
    "concept_relationship": (
        "concept_id_1 bigint, concept_id_2 bigint, relationship_id string, "
        "valid_start_date date, valid_end_date date, invalid_reason string"
    ),
    "relationship": (
        "relationship_id string, relationship_name string, is_hierarchical string, "
        "defines_ancestry string, reverse_relationship_id string, relationship_concept_id bigint"
    ),
    "concept_synonym": "concept_id bigint, concept_synonym_name string, language_concept_id bigint",
    "concept_ancestor": (
        "ancestor_concept_id bigint, descendant_concept_id bigint, "
        "min_levels_of_separation bigint, max_levels_of_separation bigint"
    ),
    "drug_strength": (
        "drug_concept_id bigint, ingredient_concept_id bigint, amount_value double, "
        "amount_unit_concept_id bigint, numerator_value double, numerator_unit_concept_id bigint, "
        "denominator_value double, denominator_unit_concept_id bigint, box_size bigint, "
        "valid_start_date date, valid_end_date date, invalid_reason string"
    ),
}


def scan_vocabulary(
    spark: SparkSession, folder: str, tables: Iterable[str] = tuple(VOCABULARY_SCHEMAS), *, sep: str = "\t"
) -> dict[str, CsvTable]:
    """Concept tables from ``<folder>/<TABLE>.csv``: lazy rows, and the lines that don't fit the columns' types."""
    return {
        t: read_fixed_csv(spark, f"{folder}/{t.upper()}.csv", VOCABULARY_SCHEMAS[t], sep=sep) for t in tables
    }


def load_vocabulary(
    spark: SparkSession, folder: str, tables: Iterable[str] = tuple(VOCABULARY_SCHEMAS), *, sep: str = "\t"
) -> dict[str, DataFrame]:
    """The rows of ``scan_vocabulary``; look at its rejects before relying on them."""
    return {t: found.rows for t, found in scan_vocabulary(spark, folder, tables, sep=sep).items()}
