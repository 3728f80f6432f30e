"""The whole job over small CSV files of every table: load, re-link, audit, dictionary, OMOP."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import rows, ts

from clinspark.operators.audit import key_violations
from clinspark.plans.codes import denormalize, normalize, store_codes
from clinspark.plans.load import KeyViolation, load_dataset
from clinspark.plans.omop import omop_convert, omop_prepare, omop_restore
from clinspark.spec import CLINICAL_TABLES, LoadConfig
from clinspark.staging import Staging

OLD, NEW, LATE = "2001-01-01T08:00:00Z", "2011-01-01T08:00:00Z", "2012-01-01T08:00:00Z"
EVENT = "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n"
DATED = "DATE,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n"

FILES = {
    "patients": "Id,BIRTHDATE,DEATHDATE,ZIP\np1,1950-02-03,,20009\np2,1960-01-01,2015-05-05,20003\np3,1970-01-01,,\n",
    "encounters": (
        "Id,START,STOP,PATIENT,ORGANIZATION,PAYER,ENCOUNTERCLASS,CODE,DESCRIPTION,REASONCODE\n"
        f"e0,{OLD},{OLD},p1,o1,y1,wellness,100,Check,\n"
        f"e1,{NEW},{NEW},p1,o1,y1,wellness,100,Check,55822004\n"
        f"e2,{LATE},{LATE},p1,o1,y1,inpatient,101,Stay,\n"
        f"e3,{LATE},{LATE},p2,o9,y1,emergency,102,Rush,\n"
        f"e3,{LATE},{LATE},p2,o9,y1,emergency,102,Rush again,\n"
        f"e4,{OLD},{OLD},p3,o1,y1,wellness,100,Check,\n"
    ),
    "allergies": EVENT + f"{OLD},,p1,e0,a1,Pollen\n",
    "careplans": EVENT + f"{OLD},{NEW},p1,e0,cp,Plan\n{OLD},,p1,e0,cp,Plan\n",
    "conditions": EVENT + f"{OLD},{NEW},p1,e0,c1,Flu\n{OLD},{NEW},p1,e0,c1,Flu\n{OLD},{NEW},p3,e4,c1,FLU\n{NEW},{LATE},p1,e1,c2,Cold\n",
    "devices": EVENT + f"{OLD},{NEW},p2,e0,d1,Stent\n",
    "medications": (
        "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION,REASONCODE,REASONDESCRIPTION\n"
        f"{NEW},{LATE},p2,e3,313782,Pill,55822004,Pain\n"
    ),
    "immunizations": DATED + f"{NEW},p1,e1,140,Shot\n{NEW},p2,gone,140,Jab\n",
    "observations": DATED + f"{NEW},p1,e1,8302-2,Height\n{NEW},p1,gone,8302-2,Body height\n{NEW},p1,,8302-2,QALY\n",
    "procedures": (
        "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION,REASONCODE,REASONDESCRIPTION\n"
        f"{NEW},{NEW},p1,e1,p10,Cut,,\n{NEW},{NEW},p1,gone,p11,Sew,,\n{NEW},{NEW},p1,,p12,Tie,,\n{OLD},{NEW},p1,e1,p13,Old,,\n"
    ),
    "imaging_studies": (
        "Id,DATE,PATIENT,ENCOUNTER,BODYSITE_CODE,BODYSITE_DESCRIPTION,MODALITY_CODE,MODALITY_DESCRIPTION,"
        "SOP_CODE,SOP_DESCRIPTION,PROCEDURE_CODE\n"
        f"i1,{NEW},p1,e1,51185008,Chest,CT,Computed,1.2.3,Image,399208008\n"
    ),
    "supplies": DATED + f"{NEW},p1,gone,s1,Mask\n",
    "claims": (
        "Id,PATIENTID,SERVICEDATE,LASTBILLEDDATE1,LASTBILLEDDATE2,LASTBILLEDDATEP,DIAGNOSIS1,CURRENTILLNESSDATE\n"
        f"c1,p1,{NEW},,,,55822004,{NEW}\nc2,p1,{OLD},,,,1,{OLD}\n"
    ),
    "claims_transactions": f"ID,CLAIMID,FROMDATE,TODATE\nt1,c1,{NEW},{NEW}\nt2,c2,{OLD},{OLD}\n",
    "payer_transitions": f"PATIENT,START_DATE,END_DATE,PAYER\np1,{OLD},{NEW},y1\n",
    "organizations": "Id,NAME,ADDRESS\no1,Clinic,1 Main St\no2,Other,1 Main St, Apt 4\n",
    "payers": "Id,NAME\ny1,Payer\n",
    "providers": "Id,ORGANIZATION,NAME\nd1,o1,Doc\n",
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    (root / "csv").mkdir()
    (root / "notes").mkdir()
    assert set(FILES) == {t.name for t in CLINICAL_TABLES}
    for name, text in FILES.items():
        (root / "csv" / f"{name}.csv").write_text(text)
    (root / "notes" / "Ann_p1.txt").write_text("2011-01-01\n\nwell" + "\n" * 4)
    config = LoadConfig(str(root), str(root / "out"), include_notes=True)
    return load_dataset(spark, config), root / "out"


def test_trim_and_duplicates(loaded):
    tables, _ = loaded
    assert rows(tables["encounters"], "id", "description") == [("e1", "Check"), ("e2", "Stay"), ("e3", "Rush")]
    assert rows(tables["claims"], "id") == [("c1",)]
    assert rows(tables["claims_transactions"], "id") == [("t1",)]
    assert tables["payer_transitions"].count() == 1
    assert rows(tables["notes"]) == [(dt.date(2011, 1, 1), "well", "p1")]
    assert dict(tables["patients"].dtypes) == {
        "id": "string", "birthdate": "date", "deathdate": "date", "zip": "bigint", "first_encounter_id": "string"}


def test_layout_and_refused_keys(spark, loaded):
    tables, out = loaded
    assert not list(out.glob("_staged*"))
    config = LoadConfig(str(out.parent), str(out.parent / "again"), layout="patient", on_violation="fail")
    with pytest.raises(KeyViolation, match="encounters.organization: 1"):
        load_dataset(spark, config)
    again = spark.read.parquet(str(out.parent / "again" / "linked" / "conditions"))
    assert rows(again) == rows(tables["conditions"])
    curved = load_dataset(spark, LoadConfig(str(out.parent), str(out.parent / "curve"), layout="curve"))
    for name in ("conditions", "claims", "patients", "organizations"):
        assert rows(curved[name]) == rows(tables[name]) and curved[name].schema == tables[name].schema
    with pytest.raises(ValueError):
        LoadConfig("x", "y", layout="encounter")


def test_clinical_columns_need_no_inference():
    pinned = dict(CLINICAL_TABLES[0].types)
    assert pinned["description"] == "string" and pinned["base_cost"] == "double"


def test_relinked(loaded):
    tables, _ = loaded
    assert rows(tables["patients"], "id", "first_encounter_id") == [("p1", "e1"), ("p2", "e3"), ("p3", None)]
    assert rows(tables["allergies"], "encounter") == [("e1",)]
    assert rows(tables["careplans"], "encounter") == [("e1",)]
    assert rows(tables["conditions"], "patient", "encounter", "code") == [("p1", "e1", "c1"), ("p1", "e1", "c2"), ("p3", None, "c1")]
    assert rows(tables["devices"], "encounter") == [("e3",)]
    assert rows(tables["immunizations"], "encounter") == [("e1",), ("e3",)]
    assert rows(tables["observations"], "description") == [("Height",)]
    assert rows(tables["procedures"], "code") == [("p10",), ("p12",)]
    assert tables["supplies"].count() == 0


def test_reports(spark, loaded):
    _, out = loaded
    rejects = spark.read.parquet(f"{out}/rejects/organizations")
    assert rows(rejects, "line") == [("o2,Other,1 Main St, Apt 4",)]
    keys = {(r[0], r[1]): tuple(r)[2:] for r in spark.read.parquet(f"{out}/audit/foreign_keys").collect()}
    assert keys["encounters", "organization"] == (3, 0, 1)
    assert keys["conditions", "encounter"] == (3, 1, 0)
    assert keys["notes", "patient"] == (1, 0, 0)
    assert all(v[2] == 0 for k, v in keys.items() if k[1] == "encounter")
    assert spark.read.parquet(f"{out}/audit/primary_key").count() == 0
    lengths = {(r[0], r[1]): tuple(r)[2:] for r in spark.read.parquet(f"{out}/audit/lengths").collect()}
    assert lengths["encounters", "code"] == (32, 3, False)


def test_dictionary(loaded):
    tables, out = loaded
    codes = store_codes(tables, f"{out}/codes")
    assert key_violations(codes, ["vocab", "code"]).count() == 0
    assert ("LOINC", "8302-2", "height") in rows(codes)
    assert ("RxNorm", "313782", "pill") in rows(codes)
    back = denormalize(normalize(tables), codes)
    assert rows(back["conditions"], "code", "description") == [("c1", "flu"), ("c1", "flu"), ("c2", "cold")]


def test_omop(spark, loaded):
    tables, _ = loaded
    prepared = omop_prepare(tables)
    assert prepared["payer_transitions"].columns[1:3] == ["start_year", "end_year"]
    assert omop_restore(prepared)["payer_transitions"].columns == tables["payer_transitions"].columns
    assert dict(prepared["claims"].dtypes)["currentillnessdate"] == "timestamp"
    assert dict(tables["claims"].dtypes)["currentillnessdate"] == "string"
    concept = spark.createDataFrame(
        [(900, "SNOMED", "c1"), (901, "RxNorm", "313782")], "concept_id bigint, vocabulary_id string, concept_code string")
    cdm = omop_convert(tables, concept, Staging(spark))
    assert rows(cdm["person"], "person_id", "person_source_value", "year_of_birth") == [(1, "p1", 1950), (2, "p2", 1960), (3, "p3", 1970)]
    assert rows(cdm["death"]) == [(2, dt.date(2015, 5, 5))]
    assert rows(cdm["visit_occurrence"], "visit_occurrence_id", "person_id", "visit_concept_id") == [(1, 1, 9201), (2, 1, 9202), (3, 2, 9203)]
    assert rows(cdm["condition_occurrence"], "person_id", "condition_concept_id", "visit_occurrence_id", "condition_source_value") == [
        (1, 0, 2, "c2"), (1, 900, 2, "c1"), (3, 900, None, "c1")]
    assert rows(cdm["drug_exposure"], "person_id", "drug_concept_id", "visit_occurrence_id", "drug_source_value") == [
        (1, 0, 2, "140"), (2, 0, 3, "140"), (2, 901, 3, "313782")]
    assert rows(cdm["measurement"], "measurement_datetime", "measurement_source_value") == [(ts("2011-01-01T08:00"), "8302-2")]
    assert cdm["procedure_occurrence"].count() == 2
