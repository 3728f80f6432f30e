"""Date trims."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.functions.dates import date_literal


def launch_trim(df: DataFrame, column: str, launch_date: dt.date, *, open_ended: str = "drop") -> DataFrame:
    """Rows on or after the launch date; a null date does not pass unless ``open_ended="keep"``."""
    late_enough = F.col(column) >= date_literal(df, column, launch_date)
    if open_ended == "keep":
        late_enough = late_enough | F.col(column).isNull()
    return df.where(late_enough)


def history_window(df: DataFrame, column: str, years: int) -> DataFrame:
    """The last ``years`` years up to the newest date in the data; 0 keeps everything.

    The newest date is a scalar subquery, so the comparison is pushed into the scan. The interval
    keeps the time of day, which month arithmetic on dates would lose.
    """
    if years == 0:
        return df
    span = F.make_ym_interval(F.lit(years), F.lit(0))
    oldest = df.select((F.max(column) - span).alias("oldest"))
    return df.where(F.col(column) >= oldest.scalar())
