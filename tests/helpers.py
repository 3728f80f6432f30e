from __future__ import annotations

import datetime as dt
import io
from contextlib import redirect_stdout


def ts(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text) if text else None


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
