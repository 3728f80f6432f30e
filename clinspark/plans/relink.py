"""Re-link job: repair the references to encounters that the trim removed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from clinspark.operators.relink import (
    FIRST_ENCOUNTER, add_first_encounter, delete_orphans, reassign_orphans,
)
from clinspark.spec import DELETE, REASSIGN, TableSpec
from clinspark.staging import Stage, lazily

#: Policies that change a table's rows.
CHANGED = (REASSIGN, DELETE)


def relink_tables(
    tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], stage: Stage = lazily
) -> dict[str, DataFrame]:
    """Apply every table's orphan policy against the trimmed encounters.

    History tables move their orphans to the patient's first encounter, event tables lose them, and
    tables that require an encounter also lose the rows without one.
    """
    linked = dict(tables)
    if "encounters" not in tables or "patients" not in tables:
        return linked
    encounters, patients = tables["encounters"], tables["patients"]
    firsts = stage(add_first_encounter(patients.select("id"), encounters))
    linked["patients"] = patients.join(firsts, "id", "left").select(*patients.columns, FIRST_ENCOUNTER)
    firsts = firsts.withColumnRenamed("id", "patient")
    for name, df in tables.items():
        spec = specs.get(name)
        if spec is None:
            continue
        if spec.orphans == REASSIGN:
            linked[name] = reassign_orphans(df, encounters, firsts, stage=stage)
        elif spec.orphans == DELETE:
            linked[name] = delete_orphans(df, encounters, keep_null=not spec.require_encounter)
    return linked
