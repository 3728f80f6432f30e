"""Linked clinical records on Spark: load, trim, re-link, code dictionary, OMOP shape."""

from clinspark.spec import CLINICAL_TABLES, LoadConfig, TableSpec, select_tables
from clinspark.staging import Staging

__all__ = ["CLINICAL_TABLES", "LoadConfig", "Staging", "TableSpec", "select_tables"]
