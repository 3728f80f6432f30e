"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lowered(column: Column | str) -> Column:
    return F.lower(column)
