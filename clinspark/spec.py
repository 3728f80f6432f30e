"""What is known about the clinical tables: dates, trimming, keys and orphan handling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

PARENT = "parent"
REASSIGN = "reassign"
DELETE = "delete"
KEEP = "keep"


#: Types of the public tables' columns that are neither dates nor codes; others are inferred.
COLUMN_TYPES: dict[str, str] = {
    **dict.fromkeys((
        "description", "reasondescription", "bodysite_description", "modality_description", "sop_description",
        "name", "address", "city", "state", "state_headquartered", "county", "phone", "type", "category", "units",
        "value", "system", "reaction1", "reaction2", "severity1", "severity2", "description1", "description2",
        "encounterclass", "first", "middle", "last", "prefix", "suffix", "maiden", "marital", "race", "ethnicity",
        "gender", "birthplace", "ssn", "drivers", "passport", "udi", "speciality", "plan_ownership", "owner_name",
    ), "string"),
    **dict.fromkeys((
        "base_cost", "payer_coverage", "totalcost", "base_encounter_cost", "total_claim_cost", "lat", "lon", "revenue",
        "healthcare_expenses", "healthcare_coverage", "amount_covered", "amount_uncovered", "qols_avg", "amount",
        "payments", "adjustments", "transfers", "outstanding", "unitamount",
    ), "double"),
    **dict.fromkeys(("dispenses", "utilization", "quantity"), "bigint"),
}


@dataclass(frozen=True)
class TableSpec:
    """Policy of one table.

    ``date_columns`` are parsed when the table is read, and the first one decides the launch-date
    trim of a ``trimmed`` table. ``orphans`` says what happens to a row whose encounter was trimmed
    away. ``types`` pins column types (Spark DDL names) and saves the inference pass for them.
    """

    name: str
    date_columns: tuple[str, ...] = ()
    trimmed: bool = False
    orphans: str = KEEP
    require_encounter: bool = False
    types: tuple[tuple[str, str], ...] = ()

    @property
    def trim_column(self) -> str | None:
        return self.date_columns[0] if self.trimmed and self.date_columns else None


# Tables, their date columns in order, and their policies.
_POLICIES: tuple[TableSpec, ...] = (
    TableSpec("allergies", ("stop", "start"), orphans=REASSIGN),
    TableSpec("careplans", ("stop", "start"), trimmed=True, orphans=REASSIGN),
    TableSpec("claims_transactions", ("fromdate", "todate"), trimmed=True),
    TableSpec(
        "claims",
        ("servicedate", "lastbilleddate1", "lastbilleddate2", "lastbilleddatep"),
        trimmed=True,
    ),
    TableSpec("conditions", ("stop", "start"), trimmed=True, orphans=REASSIGN),
    TableSpec("devices", ("stop", "start"), trimmed=True, orphans=REASSIGN),
    TableSpec("encounters", ("stop", "start"), trimmed=True, orphans=PARENT),
    TableSpec("imaging_studies", ("date",), trimmed=True, orphans=DELETE),
    TableSpec("immunizations", ("date",), trimmed=True, orphans=REASSIGN),
    TableSpec("medications", ("stop", "start"), trimmed=True, orphans=REASSIGN),
    TableSpec("observations", ("date",), trimmed=True, orphans=DELETE, require_encounter=True),
    TableSpec("organizations"),
    TableSpec("patients", ("birthdate", "deathdate")),
    TableSpec("payers"),
    TableSpec("payer_transitions", ("start_date", "end_date")),
    TableSpec("procedures", ("start", "stop"), trimmed=True, orphans=DELETE),
    TableSpec("providers"),
    TableSpec("supplies", ("date",), trimmed=True, orphans=DELETE),
)

CLINICAL_TABLES = tuple(replace(table, types=tuple(COLUMN_TYPES.items())) for table in _POLICIES)

# Columns of a table's date, the first it has, and those that point to another table.
LAYOUT_DATES = ("date", "start", "servicedate", "fromdate", "start_date", "birthdate")
FOREIGN_KEYS = ("patient", "encounter", "provider", "payer", "organization")


def parent_table(foreign_key: str) -> str:
    """Table whose ``id`` a foreign-key column points to."""
    return f"{foreign_key}s"


def columns_present(wanted: Sequence[str], columns: Iterable[str]) -> list[str]:
    """The wanted columns a table really has, in the wanted order."""
    have = set(columns)
    return [c for c in wanted if c in have]


def select_tables(
    names: Iterable[str], include: Iterable[str] = (), exclude: Iterable[str] = ()
) -> list[str]:
    """Choose tables by an include or an exclude list of file or table names.

    Only one of the lists may be given: with both set, both are ignored; with none, all are kept.
    """
    names = list(names)
    included = {n.strip().removesuffix(".csv") for n in include}
    excluded = {n.strip().removesuffix(".csv") for n in exclude}
    if included and excluded:
        return names
    if included:
        return [n for n in names if n in included]
    return [n for n in names if n not in excluded]


@dataclass(frozen=True)
class LoadConfig:
    """Parameters of a load run.

    ``open_ended`` decides about rows whose trim date is null: ``drop`` (a null never passes the
    comparison) or ``keep``. ``layout`` orders the tables that a run ends with by ``date`` (the first date column) or
    by ``patient``, or by date, patient and encounter at once (``curve``), so that scans skip files; a table without such
    a column keeps its order. ``quoted_breaks`` reads CSV values with line breaks in quotes. ``on_violation`` decides
    about null or repeated ids and dangling references in the result: ``report`` or ``fail``, after the reports are
    written.
    """

    source_dir: str
    target_dir: str
    launch_date: dt.date = dt.date(2010, 1, 1)
    include_notes: bool = False
    open_ended: str = "drop"
    keep_unterminated_notes: bool = False
    tables: tuple[TableSpec, ...] = CLINICAL_TABLES
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ("patient_expenses.csv",)
    layout: str | None = None
    on_violation: str = "report"
    quoted_breaks: bool = False

    def __post_init__(self) -> None:
        if self.layout not in (None, "date", "patient", "curve"):
            raise ValueError("layout must be None, 'date', 'patient' or 'curve'")
        if self.on_violation not in ("report", "fail"):
            raise ValueError("on_violation must be 'report' or 'fail'")
        if self.open_ended not in ("drop", "keep"):
            raise ValueError("open_ended must be 'drop' or 'keep'")

    def selected(self) -> list[TableSpec]:
        chosen = set(select_tables([t.name for t in self.tables], self.include, self.exclude))
        return [t for t in self.tables if t.name in chosen]
