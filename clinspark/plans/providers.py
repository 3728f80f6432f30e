"""Provider job: curated lists for every kind of facility."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

from clinspark.operators.providers import URGENT_CARE_TARGET, curation_plan, fan_out, urgent_care
from clinspark.sources.csv_tables import scan_csv
from clinspark.sources.sinks import replace_table, write_csv


def curate_lists(
    spark: SparkSession, source_dir: str, target_dir: str, plan: Iterable[tuple[str, str, Sequence[int]]],
    *, column: str = "npi",
) -> list[str]:
    """Filter lists by a plan of (source, target, provider numbers); returns the folders written.

    A source is read once for all targets it feeds. The leading index column keeps its blank header. Targets are
    folders of CSV files below ``<target_dir>/<source>/target=<list>``; lines that don't fit the header go to
    ``<target_dir>/rejects/<source>``, with the reason.
    """
    wanted: dict[str, dict[str, Sequence[int]]] = {}
    for source, target, numbers in plan:
        wanted.setdefault(source, {})[target] = numbers
    for source, targets in wanted.items():
        scan = scan_csv(spark, f"{source_dir}/{source}")
        kept = fan_out(scan.rows, targets, column).withColumnRenamed("_c0", "")
        write_csv(kept, f"{target_dir}/{source}", partition_by=["target"])
        replace_table(scan.rejects, f"{target_dir}/rejects/{source}")
    return [f"{target_dir}/{source}/target={t}" for source, targets in wanted.items() for t in targets]


def curate_providers(spark: SparkSession, source_dir: str, target_dir: str, hospitals: str = "MGUH") -> list[str]:
    """The curated lists for the chosen hospitals, and the urgent care list.

    Lists of another format are not touched.
    """
    written = curate_lists(spark, source_dir, target_dir, curation_plan(hospitals))
    write_csv(urgent_care(spark), f"{target_dir}/{URGENT_CARE_TARGET}")
    return [*written, f"{target_dir}/{URGENT_CARE_TARGET}"]
