from __future__ import annotations

import pytest
from helpers import rows

from clinspark.operators.audit import key_violations, reference_report, foreign_keys, length_report, storage_report
from clinspark.operators.codes import CODE_BRANCHES, build_codes, code_pairs
from clinspark.plans.codes import denormalize, dictionary_audit, normalize, store_codes

CODED = ("allergies", "careplans", "conditions", "devices", "encounters", "supplies", "medications",
         "immunizations", "observations")


@pytest.fixture(scope="module")
def tables(spark):
    empty = spark.createDataFrame([], "code string, description string")
    found = {t: empty for t in CODED}
    found["conditions"] = spark.createDataFrame(
        [("1", "Beta"), ("1", "ALPHA"), (None, "nothing"), ("1", "Beta")], "code string, description string")
    found["encounters"] = spark.createDataFrame([("1", "zeta"), ("2", None)], "code string, description string")
    found["procedures"] = spark.createDataFrame(
        [("3", "Cut", None, None), ("4", "Sew", "5", "Wound")],
        "code string, description string, reasoncode string, reasondescription string")
    found["medications"] = spark.createDataFrame([("m", "Pill B"), ("m", "Pill A")], "code string, description string")
    found["immunizations"] = spark.createDataFrame([("v", "Shot"), ("v", "Jab")], "code string, description string")
    found["observations"] = spark.createDataFrame(
        [("o", "aa"), ("o", "Longest"), ("o", "longesu"), ("x" * 40, "wide"), ("x" * 32 + "y", "wider")], "code string, description string")
    found["imaging_studies"] = spark.createDataFrame(
        [("b", "Chest", "CT", "Computed", "s1", "One"), ("b", "Chest", "CT", "Tomography", "s1", "Uno")],
        "bodysite_code string, bodysite_description string, modality_code string, modality_description string, "
        "sop_code string, sop_description string")
    return found


EXPECTED = [
    ("CVX", "v", "jab"), ("DICOM-DCM", "CT", "computed"), ("DICOM-SOP", "s1", "one"),
    ("LOINC", "o", "longesu"), ("LOINC", "x" * 40, "wide"), ("LOINC", "x" * 32 + "y", "wider"), ("RxNorm", "m", "pill a"),
    ("SNOMED", "1", "alpha"), ("SNOMED", "2", None), ("SNOMED", "3", "cut"), ("SNOMED", "4", "sew"),
    ("SNOMED", "5", "wound"), ("SNOMED", "b", "chest"),
]


def test_dictionary(tables):
    assert rows(build_codes(tables)) == EXPECTED


def test_all_pairs_of_a_vocabulary(tables):
    pairs = code_pairs(tables, [b for b in CODE_BRANCHES if b.vocab == "CVX"])
    assert rows(pairs) == [("CVX", "v", "jab"), ("CVX", "v", "shot")]


def test_normalize_and_back(tables, staging):
    codes = store_codes(tables, staging.path("codes"))
    assert rows(codes) == EXPECTED
    violations, lengths = dictionary_audit(codes)
    assert violations.count() == 0
    assert rows(lengths, "column_name", "too_long") == [("code", True), ("description", False), ("vocab", False)]
    plain = normalize(tables)
    assert plain["conditions"].columns == ["code", "vocab"]
    assert plain["imaging_studies"].columns == ["bodysite_code", "modality_code", "sop_code"]
    assert plain["procedures"].columns == ["code", "reasoncode", "vocab"]
    back = denormalize(plain, codes)
    assert rows(back["conditions"], "code", "description") == [(None, None), ("1", "alpha"), ("1", "alpha"), ("1", "alpha")]
    assert back["observations"].count() == tables["observations"].count()
    assert rows(back["observations"].where("code like 'x%'"), "description") == [("wide",), ("wider",)]
    assert rows(back["procedures"], "code", "description", "reasondescription") == [("3", "cut", None), ("4", "sew", "wound")]
    assert rows(back["imaging_studies"], "bodysite_description", "modality_description", "sop_description") == [
        ("chest", "computed", "one")] * 2
    assert all(set(back[t].columns) == set(tables[t].columns) for t in tables)


def test_key_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    assert rows(key_violations(df, ["id"])) == [(None, 1), ("a", 2)]


def test_references(spark):
    tables = {
        "patients": spark.createDataFrame([("p1",)], "id string"),
        "organizations": spark.createDataFrame([], "id string"),
        "encounters": spark.createDataFrame(
            [("e1", "p1", "o1"), ("e2", "p9", None), ("e3", "p9", None)], "id string, patient string, organization string"),
        "claims": spark.createDataFrame([], "id string, encounter string, payer string"),
    }
    keys = foreign_keys(tables)
    assert rows(reference_report(tables, keys)) == [
        ("claims", "encounter", 0, 0, 0), ("encounters", "organization", 3, 2, 1), ("encounters", "patient", 3, 0, 2)]


def test_lengths(spark):
    df = spark.createDataFrame([("x" * 65, "y", 5)], "id string, description string, n int")
    assert rows(length_report(df)) == [("description", 1024, 1, False), ("id", 64, 65, True)]
    assert rows(storage_report(df), "column_name", "storage_type", "n_lost") == [
        ("description", "string", 0), ("id", "string", 0), ("n", "bigint", 0)]
