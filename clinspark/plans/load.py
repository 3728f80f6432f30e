"""Load job: CSV tables and notes to Parquet, trimmed and free of duplicates, then re-linked."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clinspark.functions.columns import to_storage
from clinspark.operators.dedup import dedup_table
from clinspark.operators.trim import launch_trim
from clinspark.plans.audit import audit_dataset
from clinspark.plans.relink import CHANGED, relink_tables
from clinspark.sources.csv_tables import POSITION, CsvTable, read_table
from clinspark.sources.curve import cluster_by_curve
from clinspark.sources.notes import Notes, read_notes
from clinspark.sources.sinks import replace_table
from clinspark.spec import LAYOUT_DATES, LoadConfig, TableSpec, columns_present
from clinspark.staging import Stage, Staging, lazily


def load_table(
    spark: SparkSession, path: str, spec: TableSpec, launch_date: dt.date, *, open_ended: str = "drop",
    stage: Stage = lazily, **scan_options,
) -> CsvTable:
    """Read, trim, remove duplicates, cast to storage types.

    The trim comes before the duplicate removal: with copies of different dates the order shows. What runs at once is the
    type inference and, with a ``stage``, the search for duplicate ids, whose ids and positions it stores. With ``Staging``
    one job does both, and the files are read once for them.
    """

    def trimmed(rows: DataFrame) -> DataFrame:
        if not spec.trim_column:
            return rows
        return launch_trim(rows, spec.trim_column, launch_date, open_ended=open_ended)

    stored: list[DataFrame] = []

    def store_ids(rows: DataFrame) -> bool:
        if "id" in rows.columns:
            stored.append(stage(trimmed(rows).select("id", *POSITION)))
        return bool(stored)

    # Other stages may store later, or nothing.
    first_pass = store_ids if isinstance(stage, Staging) else None
    table = read_table(spark, path, spec, with_position=True, first_pass=first_pass, **scan_options)
    return CsvTable(to_storage(dedup_table(trimmed(table.rows), POSITION, stage, *stored)), table.rejects)


def load_tables(spark: SparkSession, config: LoadConfig, stage: Stage = lazily) -> dict[str, DataFrame]:
    """Load every selected table (and the notes) and return them as scans of what was written."""
    loaded = {}
    for spec in config.selected():
        seen = Observation()
        table = load_table(
            spark, f"{config.source_dir}/csv/{spec.name}.csv", spec, config.launch_date,
            open_ended=config.open_ended, stage=stage, observation=seen, quoted_breaks=config.quoted_breaks,
        )
        loaded[spec.name] = _stored_with_rejects(table, seen, spec.name, config)
    if config.include_notes:
        seen = Observation()
        notes = read_notes(
            spark, f"{config.source_dir}/notes", keep_unterminated=config.keep_unterminated_notes,
            observation=seen,
        )
        loaded["notes"] = _stored_with_rejects(notes, seen, "notes", config)
    return loaded


def _stored_with_rejects(table: CsvTable | Notes, seen: Observation, name: str, config: LoadConfig) -> DataFrame:
    """Store rows and rejects; the source is parsed again only if there is something to set aside."""
    rows = _stored(table.rows, f"{config.target_dir}/loaded/{name}")
    rejects = table.rejects if seen.get["n_rejected"] else table.rejects.limit(0)
    replace_table(rejects, f"{config.target_dir}/rejects/{name}")
    return rows


def _stored(df: DataFrame, path: str) -> DataFrame:
    replace_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def laid_out(df: DataFrame, layout: str | None) -> DataFrame:
    """Rows in ranges of their first date or their patient, with a hash of the row behind it for frequent values."""
    wanted = {"date": LAYOUT_DATES, "patient": ("patient",)}.get(layout, ())
    column = next((c for c in wanted if c in df.columns), None)
    if column is None:
        return df
    return df.repartitionByRange(column, F.xxhash64(*df.columns)).sortWithinPartitions(column)


def _on_curve(df: DataFrame, staged: str, target: str) -> DataFrame:
    """Rows stored once, and then along the curve through their first date, patient and encounter."""
    spark = df.sparkSession
    first_date = columns_present(LAYOUT_DATES, df.columns)[:1]
    columns = first_date + columns_present(("patient", "encounter"), df.columns)
    if not columns:
        return _stored(df, target)
    replace_table(df, staged)
    cluster_by_curve(spark, staged, target, columns)
    return spark.read.schema(df.schema).parquet(target)


class KeyViolation(ValueError):
    """The loaded tables break a key that must hold."""


def refuse_violations(reports: Mapping[str, DataFrame]) -> None:
    """Raise if a report names a null or repeated id or a dangling reference."""
    found = []
    if "primary_key" in reports:
        found += [f"{r['table_name']}.id" for r in reports["primary_key"].select("table_name").distinct().collect()]
    if "foreign_keys" in reports:
        broken = reports["foreign_keys"].where("n_orphan > 0").collect()  # one row for each reference
        found += [f"{r['table_name']}.{r['column_name']}: {r['n_orphan']}" for r in broken]
    if found:
        raise KeyViolation("; ".join(sorted(found)))


def load_dataset(spark: SparkSession, config: LoadConfig) -> dict[str, DataFrame]:
    """The whole job: load, re-link, store the changed tables and the audit reports.

    What it stages lies below the target folder and goes at the end.
    """
    staging = Staging(spark, f"{config.target_dir}/_staged-{uuid.uuid4().hex}")
    specs = {t.name: t for t in config.selected()}
    try:
        loaded = load_tables(spark, config, staging)
        linked = relink_tables(loaded, specs, staging)
        result = {}
        for name, df in linked.items():
            changed = name == "patients" or (name in specs and specs[name].orphans in CHANGED)
            if config.layout == "curve":
                df = _on_curve(df, staging.path(f"wide-{name}"), f"{config.target_dir}/linked/{name}")
            elif changed or config.layout:
                df = _stored(laid_out(df, config.layout), f"{config.target_dir}/linked/{name}")
            result[name] = df
        reports = {}
        for name, report in audit_dataset(result).items():
            reports[name] = _stored(report, f"{config.target_dir}/audit/{name}")
    finally:
        staging.remove()
    if config.on_violation == "fail":
        refuse_violations(reports)
    return result
