"""The code dictionary: one description per vocabulary and code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.functions.text import lowered

SMALLEST_RULE = "smallest"
LONGEST_RULE = "longest"


@dataclass(frozen=True)
class CodeBranch:
    """Where codes of a vocabulary come from, and how one of several descriptions is chosen."""

    vocab: str
    table: str
    code: str = "code"
    description: str = "description"
    rule: str = SMALLEST_RULE


# The vocabularies and their source columns.
CODE_BRANCHES: tuple[CodeBranch, ...] = (
    CodeBranch("SNOMED", "allergies"),
    CodeBranch("SNOMED", "careplans"),
    CodeBranch("SNOMED", "conditions"),
    CodeBranch("SNOMED", "devices"),
    CodeBranch("SNOMED", "encounters"),
    CodeBranch("SNOMED", "procedures"),
    CodeBranch("SNOMED", "procedures", "reasoncode", "reasondescription"),
    CodeBranch("SNOMED", "supplies"),
    CodeBranch("SNOMED", "imaging_studies", "bodysite_code", "bodysite_description"),
    CodeBranch("RxNorm", "medications"),
    CodeBranch("CVX", "immunizations"),
    CodeBranch("LOINC", "observations", rule=LONGEST_RULE),
    CodeBranch("DICOM-DCM", "imaging_studies", "modality_code", "modality_description"),
    CodeBranch("DICOM-SOP", "imaging_studies", "sop_code", "sop_description"),
)


def raw_pairs(tables: Mapping[str, DataFrame], branches: Iterable[CodeBranch]) -> DataFrame:
    """Distinct (vocab, code, description) as stored: one union and one shuffle.

    Each task reduces its rows to the distinct triples before anything is shuffled, which leaves
    very little of even the largest table. Text is only changed behind this step.
    """
    rows = [
        tables[b.table].select(
            F.lit(b.vocab).alias("vocab"),
            F.col(b.code).cast("string").alias("code"),
            # A column without any value may have been typed as a number.
            F.col(b.description).cast("string").alias("description"),
        )
        for b in branches
    ]
    return reduce(DataFrame.unionByName, rows).distinct()


def dictionary_text(pairs: DataFrame) -> DataFrame:
    """Whole codes, as the tables hold them, and descriptions in lower case."""
    return pairs.select("vocab", "code", lowered("description").alias("description"))


def code_pairs(tables: Mapping[str, DataFrame], branches: Iterable[CodeBranch]) -> DataFrame:
    """Distinct (vocab, code, description) of all branches, as they stand in the dictionary."""
    return dictionary_text(raw_pairs(tables, branches)).distinct()


def _smallest() -> Column:
    # min_by and not min: for min the optimizer drops the distinct below it and sorts every row.
    return F.min_by("description", "description")


def _longest() -> Column:
    return F.max_by("description", F.struct(F.length("description"), F.col("description")))


def one_description(pairs: DataFrame, rules: Mapping[str, str] | None = None) -> DataFrame:
    """One description per (vocab, code): the smallest, or the longest where the rule says so."""
    longest = [v for v, r in (rules or {}).items() if r == LONGEST_RULE]
    chosen = _smallest()
    if longest:
        chosen = F.when(F.col("vocab").isin(*longest), _longest()).otherwise(chosen)
    return pairs.groupBy("vocab", "code").agg(chosen.alias("description"))


def build_codes(
    tables: Mapping[str, DataFrame], branches: Iterable[CodeBranch] = CODE_BRANCHES
) -> DataFrame:
    """The whole dictionary, unique on (vocab, code) and without null codes."""
    branches = list(branches)
    pairs = dictionary_text(raw_pairs(tables, branches).where(F.col("code").isNotNull()))
    return one_description(pairs, {b.vocab: b.rule for b in branches})


def lookup_descriptions(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Re-attach the dictionary's description by (vocab, code), null where there is none.

    Pass ``codes`` as a stored table: Spark then knows its size and broadcasts it when it is below
    the threshold. Beyond that it is a sort-merge join whose frequent codes AQE splits.
    """
    return df.join(codes, ["vocab", "code"], "left").select(*df.columns, "description")
