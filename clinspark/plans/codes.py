"""Code jobs: build the dictionary, replace descriptions by it, and bring them back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.functions.columns import (
    CODE_LENGTH, DESCRIPTION_LENGTH, VOCAB_LENGTH, drop_descriptions,
)
from clinspark.operators.audit import key_violations, length_report
from clinspark.operators.codes import CODE_BRANCHES, CodeBranch, build_codes
from clinspark.sources.sinks import replace_table

DICTIONARY_LENGTHS = {"vocab": VOCAB_LENGTH, "code": CODE_LENGTH, "description": DESCRIPTION_LENGTH}

# Vocabulary of the plain code column of each coded table.
TABLE_VOCABULARY = {
    "allergies": "SNOMED",
    "careplans": "SNOMED",
    "conditions": "SNOMED",
    "devices": "SNOMED",
    "encounters": "SNOMED",
    "procedures": "SNOMED",
    "supplies": "SNOMED",
    "medications": "RxNorm",
    "immunizations": "CVX",
    "observations": "LOINC",
}


def store_codes(tables: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Build and store the dictionary; read back, it is a small table of known size."""
    codes = build_codes(tables)
    replace_table(codes, path)
    return codes.sparkSession.read.schema(codes.schema).parquet(path)


def dictionary_audit(codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Violations of the key (vocab, code), and text lengths against the declared ones."""
    return key_violations(codes, ["vocab", "code"]), length_report(codes, DICTIONARY_LENGTHS)


def _coded_columns(name: str, df: DataFrame) -> list[CodeBranch]:
    """The code columns of a table whose descriptions the dictionary holds."""
    return [b for b in CODE_BRANCHES if b.table == name and b.code in df.columns]


def normalize(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Coded tables without any description the dictionary holds, everything else unchanged.

    ``vocab`` names the vocabulary of the plain code column, as the dictionary does.
    """
    found = dict(tables)
    for name, df in tables.items():
        branches = [b for b in _coded_columns(name, df) if b.description in df.columns]
        found[name] = df.drop(*[b.description for b in branches if b.code != "code"])
        if any(b.code == "code" for b in branches):
            found[name] = drop_descriptions(found[name], TABLE_VOCABULARY[name])
    return found


def denormalize(tables: Mapping[str, DataFrame], codes: DataFrame) -> dict[str, DataFrame]:
    """Normalized tables with all of the dictionary's descriptions, without the vocabulary column."""
    found = {}
    for name, df in tables.items():
        for b in _coded_columns(name, df):
            if b.description in df.columns:
                continue
            own = codes.where(F.col("vocab") == b.vocab).select(
                F.col("code").alias("_code"), F.col("description").alias(b.description))
            df = df.join(own, F.col(b.code).cast("string") == F.col("_code"), "left").drop("_code")
        found[name] = df.drop("vocab") if name in TABLE_VOCABULARY else df
    return found
