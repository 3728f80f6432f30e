"""Audit job: what constraints would refuse, as reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.operators.audit import foreign_keys, key_violations, length_report, reference_report


def audit_dataset(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Primary-key violations, foreign-key counts and text lengths over all tables, lazily.

    Each report is one job whatever the number of tables; a report nothing applies to is left out.
    """
    keyed = {n: df for n, df in tables.items() if "id" in df.columns}
    texts = {n: df for n, df in tables.items() if any(isinstance(f.dataType, T.StringType) for f in df.schema)}
    links = foreign_keys(tables)
    reports = {}
    if keyed:
        reports["primary_key"] = _named({n: key_violations(df, ["id"]) for n, df in keyed.items()})
    if links:
        reports["foreign_keys"] = reference_report(tables, links)
    if texts:
        reports["lengths"] = _named({n: length_report(df) for n, df in texts.items()})
    return reports


def _named(reports: Mapping[str, DataFrame]) -> DataFrame:
    named = [df.select(F.lit(name).alias("table_name"), "*") for name, df in reports.items()]
    return reduce(DataFrame.unionByName, named)
