"""Report frames with faults, so that the rules of every check have something to find.

A fault is a copy of some rows in which columns are replaced. Conditions and values are
texts that both engines read the same way; each frame is the union of its copies, the
first of which is mostly the sound frame itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachscope.operators import risk as R

Fault = tuple[str, dict[str, str]]

_ORDER = "CAST(substr(number, 4) AS BIGINT) % 50"
_EVEN = "ascii(substr(assignment_group, length(assignment_group), 1)) % 2 = 0"
_ALL = "TRUE"


def _each(columns: list[str], value: str) -> dict[str, str]:
    return dict.fromkeys(columns, value)


_STATS = [f"{s}_sla_risk_score" for s in ("mean", "median", "min", "max")]
_SHARES = ["elevated_risk_share_pct", "critical_risk_share_pct"]
_INTERVAL: list[Fault] = [
    (_ALL, {}),
    (_ALL, {"breach_rate": "breach_rate_ci_upper + 5e0"}),
    (_ALL, {"breach_rate_ci_lower": "-5e0"}),
]
_FEW: Fault = (_ALL, {"incident_count": "1"})
_COVERAGE: Fault = (_ALL, {"resolution_coverage": "150e0"})
_HOURS = ["median_resolution_hours", "p90_resolution_hours"]
_NOT_CATEGORY = "dimension <> 'Category'"
_NOT_PRIORITY = "factor_type <> 'Priority'"

# By check: the name of the frame in the SQL, and its faults.
FAULTS: dict[str, tuple[str, list[Fault]]] = {
    "v02_risk_scores": (
        "sco",
        [
            (f"{_ORDER} <> 9", {}),
            (f"{_ORDER} = 0", {"risk_factor_count": "5"}),
            (f"{_ORDER} = 1", _each(R.RATE_COLUMNS, "101e0")),
            (f"{_ORDER} = 2", _each(R.CONTRIBUTION_COLUMNS, "2e0")),
            (f"{_ORDER} = 3", {"sla_risk_score": "NULL"}),
            (f"{_ORDER} = 4", {"sla_risk_score": "101e0"}),
            (f"{_ORDER} = 5", {"sla_risk_band": "NULL"}),
            (f"{_ORDER} = 6", {"sla_risk_band": "'Severe'"}),
            (f"{_ORDER} = 7", {R.CONTRIBUTION_COLUMNS[0]: "NULL"}),
        ],
    ),
    "v03_portfolio": (
        "por",
        [
            (_ALL, {}),
            (_ALL, {"sla_risk_band": "'Severe'", "incident_count": "-1", "incident_share_pct": "150e0"}),
            (_ALL, _each([*_STATS, "mean_risk_factor_count"], "NULL")),
            (_ALL, _each(_STATS, "101e0") | {"mean_risk_factor_count": "-1e0"}),
        ],
    ),
    "v04_concentration": (
        "con",
        [
            (_NOT_CATEGORY, {}),
            (_NOT_CATEGORY, {"dimension": "'Region'"}),
            (
                _NOT_CATEGORY,
                {"incident_count": "-3", "elevated_risk_incident_count": "-2", "critical_risk_incident_count": "-1"},
            ),
            (_NOT_CATEGORY, _each(_SHARES, "101e0") | {"mean_risk_factor_count": "-1e0"}),
            (_NOT_CATEGORY, _each([*_STATS[:2], "mean_risk_factor_count"], "NULL")),
            (_NOT_CATEGORY, _each(_STATS[:2], "-1e0") | {"comparison_eligible": "NOT comparison_eligible"}),
        ],
    ),
    "v05_monthly": (
        "mon",
        [
            (_ALL, {}),
            (_ALL, {"opened_month": "NULL"}),
            (
                _ALL,
                {"incident_count": "-1", "sla_breaches": "-2", "breach_rate": "-1e0", "reassignment_rate": "101e0"},
            ),
            (_ALL, {"sla_breaches": "incident_count + 1"}),
            (_ALL, {"mean_reassignment_count": "NULL"}),
            (_ALL, _each([*_HOURS, "mean_reassignment_count"], "-1e0")),
            _FEW,
        ],
    ),
    "v06_drivers": (
        "drv",
        [
            (_EVEN, {"bottleneck_class": "'Lower Priority'"}),
            (_EVEN, {"bottleneck_class": "'Lower Priority'", "driver_segment": "'Critical Bottleneck'"}),
            (_EVEN, {"bottleneck_class": "'Lower Priority'", "median_resolution_hours": "NULL"}),
            (_EVEN, {"bottleneck_class": "'Lower Priority'", "incident_count": "incident_count + 1"}),
        ],
    ),
    "v07_bottlenecks": (
        "bot",
        [
            (_ALL, {}),
            (_ALL, {"volume_class": "'High Volume'", "breach_risk_class": "'High Breach Risk'"}),
            (_ALL, {"bottleneck_class": "'Unknown'"}),
            (_ALL, {"volume_class": "NULL"}),
            (_ALL, {"volume_threshold": "volume_threshold + 1"}),
        ],
    ),
    "v08_risk_reference": (
        "ref",
        [
            (_NOT_PRIORITY, {}),
            (_NOT_PRIORITY, {"factor_type": "'Region'"}),
            (_NOT_PRIORITY, {"incident_count": "-1", "sla_breaches": "-2"}),
            (_NOT_PRIORITY, {"sla_breaches": "incident_count + 1"}),
            (_NOT_PRIORITY, {"breach_rate": "150e0"}),
            (_NOT_PRIORITY, {"breach_rate_ci_lower": "-1e0", "breach_rate_ci_upper": "101e0"}),
            (_NOT_PRIORITY, {"breach_rate_ci_upper": "NULL"}),
        ],
    ),
    "v09_category": ("cat", [*_INTERVAL, _FEW, (_ALL, {"category": "'none'"})]),
    "v10_priority": ("pri", [*_INTERVAL, (_ALL, {"priority": "'none'"})]),
    "v12_reassignment_resolution": (
        "bkt",
        [(_ALL, {}), _COVERAGE, (_ALL, _each([*_HOURS, "mean_resolution_hours"], "-1e0"))],
    ),
    "v13_assignment_group": (
        "grp",
        [*_INTERVAL, _FEW, _COVERAGE, (_ALL, _each(_HOURS, "-1e0")), (_ALL, {"assignment_group": "'none'"})],
    ),
}


def query_name(check: str) -> str:
    return f"{check.partition('_')[0]}_faults"


def planted(frame: DataFrame, check: str) -> DataFrame:
    """``frame`` with the faults of ``check``; columns keep their types."""
    copies = [
        frame.where(F.expr(where)).withColumns(
            {c: F.expr(value).cast(frame.schema[c].dataType) for c, value in changes.items()}
        )
        if changes
        else frame.where(F.expr(where))
        for where, changes in FAULTS[check][1]
    ]
    return reduce(DataFrame.unionByName, copies)


def planted_sql(check: str) -> str:
    """The same union in SQL."""
    table, faults = FAULTS[check]
    copies = []
    for where, changes in faults:
        replaced = ", ".join(f"{value} AS {column}" for column, value in changes.items())
        copies.append(f"SELECT *{f' REPLACE ({replaced})' if changes else ''} FROM {table} WHERE {where}")
    return " UNION ALL BY NAME ".join(copies)
