"""Encounters that were trimmed away: find, re-link or delete the rows that point to them.

Child tables are wide and large, so each is scanned and joined once, and a mapping is made of their distinct key
values first. What meets the whole child table is broadcast when it is measured small, else it is one sort-merge
join whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from clinspark.staging import Stage, lazily

FIRST_ENCOUNTER = "first_encounter_id"

#: Into how many parts rows with a null key are dealt.
_DEALT = 1000


def first_encounters(
    encounters: DataFrame, *, patient: str = "patient", start: str = "start", id: str = "id"
) -> DataFrame:
    """Earliest encounter of every patient: by start with nulls last, then by id.

    An aggregate and not a window: every task sends one row per patient, and no patient's encounters
    are gathered in one place.
    """
    order = F.struct(F.col(start).isNull(), F.col(start), F.col(id))
    return (
        encounters.where(F.col(patient).isNotNull())
        .groupBy(F.col(patient).alias("patient"))
        .agg(F.min_by(F.col(id), order).alias(FIRST_ENCOUNTER))
    )


def add_first_encounter(
    patients: DataFrame, encounters: DataFrame, *, id: str = "id",
    encounter_patient: str = "patient", start: str = "start", encounter_id: str = "id",
) -> DataFrame:
    """Patients with ``first_encounter_id``, null for those without a remaining encounter."""
    firsts = first_encounters(encounters, patient=encounter_patient, start=start, id=encounter_id)
    return patients.join(firsts, patients[id] == firsts["patient"], "left").drop(firsts["patient"])


def first_encounter_of_each_row(
    encounters: DataFrame, *, patient: str = "patient", start: str = "start", id: str = "id",
) -> DataFrame:
    """Every encounter with its patient's first one, as a first-value window would give it.

    Encounters without a patient are one more group. The group's first row comes from an aggregate, so only the
    join sees all rows of one patient, and Spark splits those.
    """
    order = F.struct(F.col(start).isNull(), F.col(start), F.col(id))
    firsts = encounters.groupBy(F.col(patient).alias("_patient")).agg(F.min_by(F.col(id), order).alias(FIRST_ENCOUNTER))
    return encounters.join(firsts, F.col(patient).eqNullSafe(F.col("_patient")), "left").drop("_patient")


def orphans(
    child: DataFrame, parents: DataFrame, *, key: str = "encounter", parent_id: str = "id",
) -> DataFrame:
    """Child rows whose non-null key no parent has."""
    ids = parents.select(F.col(parent_id).alias("_parent_id"))
    return child.where(F.col(key).isNotNull()).join(ids, F.col(key) == F.col("_parent_id"), "left_anti")


def delete_orphans(
    child: DataFrame, parents: DataFrame, *, key: str = "encounter", parent_id: str = "id",
    keep_null: bool = True,
) -> DataFrame:
    """Child rows without the orphans. A null key is not an orphan; ``keep_null=False`` drops it too.

    One scan of the child and one join, whose frequent keys Spark splits on the child's side. Rows with a null key are
    dealt to many partitions by a hash of their other columns, so they are no hot task below Spark's threshold, either.
    """
    ids = parents.select(F.col(parent_id).alias("_parent_id"))
    if not keep_null:
        return child.join(ids, F.col(key) == F.col("_parent_id"), "left_semi")
    others = [F.col(f"`{f.name}`") for f in child.schema.fields if f.name != key and _hashed(f.dataType)]
    deal = F.pmod(F.xxhash64(*others), F.lit(_DEALT)) if others else F.lit(0).cast("bigint")
    kind = ids.schema["_parent_id"].dataType
    none = child.sparkSession.range(_DEALT).select(F.lit(None).cast(kind).alias("_parent_id"), F.col("id").alias("_deal"))
    ids = ids.where(F.col("_parent_id").isNotNull()).withColumn("_deal", F.lit(-1).cast("bigint"))
    dealt = F.when(F.col(key).isNull(), deal).otherwise(F.lit(-1).cast("bigint"))
    return child.join(
        ids.union(none), F.col(key).eqNullSafe(F.col("_parent_id")) & (dealt == F.col("_deal")), "left_semi")


def _hashed(kind: DataType) -> bool:
    """Whether a column is taken into the hash: plain values only."""
    return isinstance(kind, (NumericType, StringType, BinaryType, BooleanType, DateType, TimestampType, TimestampNTZType))


def drop_null_encounter(child: DataFrame, *, key: str = "encounter") -> DataFrame:
    return child.dropna(subset=[key])


def reassign_orphans(
    child: DataFrame, encounters: DataFrame, firsts: DataFrame, *,
    key: str = "encounter", patient: str = "patient", encounter_id: str = "id",
    stage: Stage = lazily,
) -> DataFrame:
    """Point orphans to their own patient's first encounter (null if the patient has none left).

    Rows with an existing encounter and rows without any are unchanged. ``firsts`` has one row per
    ``patient`` with ``first_encounter_id``.
    """
    pairs = child.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_encounter"), F.col(patient).alias("_patient")
    ).distinct()
    ids = encounters.select(F.col(encounter_id).alias("_id"))
    lost = pairs.join(ids, F.col("_encounter") == F.col("_id"), "left_anti")
    firsts = firsts.select(F.col("patient").alias("_first_of"), FIRST_ENCOUNTER)
    mapping = stage(
        lost.join(firsts, F.col("_patient") == F.col("_first_of"), "left").select(
            "_encounter", "_patient", F.col(FIRST_ENCOUNTER).alias("_first"), F.lit(True).alias("_orphan")
        )
    )
    # The patient in the key also spreads the rows without an encounter over all partitions.
    linked = child.join(
        mapping,
        (F.col(key) == F.col("_encounter")) & F.col(patient).eqNullSafe(F.col("_patient")),
        "left",
    )
    linked = linked.withColumn(key, F.when(F.col("_orphan"), F.col("_first")).otherwise(F.col(key)))
    return linked.select(*child.columns)
