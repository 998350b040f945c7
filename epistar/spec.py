"""Declared table contracts (H1) for the 13 warehouse tables.

The reference reads keys and columns from the database catalog; here they are
declared once. Types follow the DDL: INT keys, INT measures as long in the
pipeline and int at the table boundary, NUMERIC(20,10) and NUMERIC(10,5)
rates, DATE and BOOLEAN calendar attributes.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


# The columns that hold the day of each date key.
DATE_ROLES = {"dim_date_key": "date", "dim_week_start_date_key": "week_start_date", "dim_week_end_date_key": "week_end_date"}


# The longest text of a column, and of every other text column.
TEXT_LENGTHS = {"country_code": 10, "territory_code": 10, "region_code": 10, "vaccine_code": 20, "month_name": 10, "day_name": 10}
TEXT_LENGTH = 255


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: str  # "dimension" or "fact"
    unique_keys: tuple[str, ...]
    columns: dict[str, str]  # non-key, non-audit columns -> Spark SQL type
    surrogate_key: str | None = None
    foreign_keys: tuple[tuple[str, str], ...] = ()  # (fk column, dimension table)
    unknown_member: dict | None = None
    date_roles: dict[str, str] = field(default_factory=lambda: dict(DATE_ROLES))  # date key -> column with its day
    key_types: dict[str, str] = field(default_factory=dict)

    @property
    def all_columns(self) -> list[str]:
        lead = [self.surrogate_key] if self.surrogate_key else []
        return lead + list(self.unique_keys) + [c for c in self.columns if c not in self.unique_keys]

    @property
    def required(self) -> list[str]:
        """Columns that hold no null: the keys, and a fact's numbers (the load fills those)."""
        numbers = [c for c, kind in self.columns.items() if kind != "string"] if self.kind == "fact" else []
        return list(self.unique_keys) + numbers

    def length_of(self, col: str) -> int | None:
        """The longest text that ``col`` holds, in characters; ``None`` if it is no text."""
        return TEXT_LENGTHS.get(col, TEXT_LENGTH) if self.type_of(col) == "string" else None

    def type_of(self, col: str) -> str:
        if col == self.surrogate_key or col.endswith("_key"):
            return "int"
        return self.columns.get(col) or self.key_types.get(col, "string")


AUDIT_COLUMNS = ("created_ts", "updated_ts")
UNKNOWN_KEY = -1

# The unknown-member rows (key -1) of each dimension.
_UNKNOWN_DATE = _dt.date(1900, 1, 1)

DIM_DATE = TableSpec(
    "dim_date",
    "dimension",
    ("date",),
    {
        "year": "int",
        "month": "int",
        "month_name": "string",
        "day": "int",
        "day_name": "string",
        "week": "int",
        "start_of_week": "boolean",
        "end_of_week": "boolean",
    },
    surrogate_key="dim_date_key",
    unknown_member={
        "date": _UNKNOWN_DATE,
        "year": 0,
        "month": 0,
        "month_name": "-unknown-",
        "day": 0,
        "day_name": "-unknown-",
        "week": 0,
        "start_of_week": False,
        "end_of_week": False,
    },
    key_types={"date": "date"},
)

DIM_COUNTRY = TableSpec(
    "dim_country",
    "dimension",
    ("country_code",),
    {"country_name": "string", "territory_code": "string", "continent": "string"},
    surrogate_key="dim_country_key",
    unknown_member={"country_code": "--", "country_name": "-unknown-", "territory_code": "---", "continent": "-unknown-"},
)

DIM_REGION = TableSpec(
    "dim_region",
    "dimension",
    ("region_code",),
    {"region_name": "string"},
    surrogate_key="dim_region_key",
    unknown_member={"region_code": "--", "region_name": "-unknown-"},
)

DIM_VACCINE = TableSpec(
    "dim_vaccine",
    "dimension",
    ("vaccine_code",),
    {"vaccine_name": "string"},
    surrogate_key="dim_vaccine_key",
    unknown_member={"vaccine_code": "--", "vaccine_name": "-unknown-"},
)

DIM_SOURCE = TableSpec(
    "dim_source",
    "dimension",
    ("source_name",),
    {},
    surrogate_key="dim_source_key",
    unknown_member={"source_name": "-unknown-"},
)

DIM_STATUS = TableSpec(
    "dim_status",
    "dimension",
    ("colour_name",),
    {"colour_description": "string"},
    surrogate_key="dim_status_key",
    unknown_member={"colour_name": "-unknown-", "colour_description": "-unknown-"},
)

DIM_TARGET_GROUP = TableSpec(
    "dim_target_group",
    "dimension",
    ("target_group",),
    {"target_description": "string", "age_lower_limit": "int", "age_upper_limit": "int"},
    surrogate_key="dim_target_group_key",
    unknown_member={"target_group": "-unknown-", "target_description": "-unknown-", "age_lower_limit": 0, "age_upper_limit": 0},
)

_WEEK_FKS = (("dim_week_start_date_key", "dim_date"), ("dim_week_end_date_key", "dim_date"))

_VACCINE_MEASURES = {
    "first_dose": "int",
    "first_dose_refused": "string",
    "second_dose": "int",
    "additional_dose_1": "int",
    "additional_dose_2": "int",
    "additional_dose_3": "int",
    "additional_dose_4": "int",
    "additional_dose_5": "int",
    "unknown_dose": "int",
    "doses_received": "int",
    "doses_exported": "int",
    "population": "int",
    "denominator": "int",
}

FACT_VACCINE_COUNTRY = TableSpec(
    "fact_vaccine_tracker_country",
    "fact",
    ("dim_week_start_date_key", "dim_week_end_date_key", "dim_country_key", "dim_vaccine_key", "dim_target_group_key"),
    dict(_VACCINE_MEASURES),
    foreign_keys=_WEEK_FKS
    + (("dim_country_key", "dim_country"), ("dim_vaccine_key", "dim_vaccine"), ("dim_target_group_key", "dim_target_group")),
)

FACT_VACCINE_REGION = TableSpec(
    "fact_vaccine_tracker_region",
    "fact",
    (
        "dim_week_start_date_key",
        "dim_week_end_date_key",
        "dim_country_key",
        "dim_region_key",
        "dim_vaccine_key",
        "dim_target_group_key",
    ),
    dict(_VACCINE_MEASURES),
    foreign_keys=_WEEK_FKS
    + (
        ("dim_country_key", "dim_country"),
        ("dim_region_key", "dim_region"),
        ("dim_vaccine_key", "dim_vaccine"),
        ("dim_target_group_key", "dim_target_group"),
    ),
)

_MI_MEASURES = {
    "population": "int",
    "new_cases_last_7days": "int",
    "new_cases_last_14days": "int",
    "notification_rate": "decimal(20,10)",
    "testing_rate": "decimal(20,10)",
    "positivity_rate": "decimal(20,10)",
    "vaccination_rate": "decimal(20,10)",
}

FACT_MI_COUNTRY = TableSpec(
    "fact_movement_indicators_country",
    "fact",
    ("dim_week_start_date_key", "dim_week_end_date_key", "dim_country_key", "dim_status_key"),
    dict(_MI_MEASURES),
    foreign_keys=_WEEK_FKS + (("dim_country_key", "dim_country"), ("dim_status_key", "dim_status")),
)

FACT_MI_REGION = TableSpec(
    "fact_movement_indicators_region",
    "fact",
    ("dim_week_start_date_key", "dim_week_end_date_key", "dim_country_key", "dim_region_key", "dim_status_key"),
    {**_MI_MEASURES, "positivity_rate_combined": "decimal(20,10)", "testing_rate_combined": "decimal(20,10)"},
    foreign_keys=_WEEK_FKS
    + (("dim_country_key", "dim_country"), ("dim_region_key", "dim_region"), ("dim_status_key", "dim_status")),
)

_CD_MEASURES = {
    "cases": "int",
    "cases_cumulative": "int",
    "cases_notification_rate": "decimal(10,5)",
    "deaths": "int",
    "deaths_cumulative": "int",
    "deaths_notification_rate": "decimal(10,5)",
}

FACT_CD_DAILY = TableSpec(
    "fact_cases_deaths_country_daily",
    "fact",
    ("dim_date_key", "dim_country_key", "dim_source_key"),
    {**_CD_MEASURES, "population": "int"},
    foreign_keys=(("dim_date_key", "dim_date"), ("dim_country_key", "dim_country"), ("dim_source_key", "dim_source")),
)

FACT_CD_WEEKLY = TableSpec(
    "fact_cases_deaths_country_weekly",
    "fact",
    ("dim_week_start_date_key", "dim_week_end_date_key", "dim_country_key", "dim_source_key"),
    dict(_CD_MEASURES),
    foreign_keys=_WEEK_FKS + (("dim_country_key", "dim_country"), ("dim_source_key", "dim_source")),
)

DIMENSIONS = {
    s.name: s
    for s in (DIM_DATE, DIM_COUNTRY, DIM_REGION, DIM_VACCINE, DIM_SOURCE, DIM_STATUS, DIM_TARGET_GROUP)
}
FACTS = {
    s.name: s
    for s in (
        FACT_CD_DAILY,
        FACT_CD_WEEKLY,
        FACT_MI_COUNTRY,
        FACT_MI_REGION,
        FACT_VACCINE_COUNTRY,
        FACT_VACCINE_REGION,
    )
}
TABLES = {**DIMENSIONS, **FACTS}


def natural_columns(spec: TableSpec) -> list[str]:
    """The columns a fact is loaded from: the business keys behind its foreign keys (a date's day for a date key), then its numbers."""
    keys: list[str] = []
    for key, dim in spec.foreign_keys:
        keys += [spec.date_roles[key]] if dim == DIM_DATE.name else list(DIMENSIONS[dim].unique_keys)
    return [*dict.fromkeys(keys), *spec.columns]
