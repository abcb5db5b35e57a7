"""Each registered query in plain SQL, for a second engine to confirm.

The texts read the order tables, build the incidents with window functions and
compute every report on their own.
"""

from __future__ import annotations

import re

from breachscope.plans import faults

_EVENTS = """
WITH base AS (
 SELECT l.*, o.*,
  CAST(floor((((l_partkey*31+l_suppkey*17)%1000)*((l_partkey*31+l_suppkey*17)%1000))/5000.0) AS INT) AS g,
  CAST(floor((((l_partkey*53+l_suppkey*29)%1000)*((l_partkey*53+l_suppkey*29)%1000))/12000.0) AS INT) AS k,
  CASE WHEN l_returnflag='R' THEN l_linenumber-1 ELSE 0 END AS r,
  CASE o_orderpriority WHEN '1-URGENT' THEN 80 WHEN '2-HIGH' THEN 60 WHEN '3-MEDIUM' THEN 5
   WHEN '4-NOT SPECIFIED' THEN 5 ELSE 0 END AS w,
  o_orderdate + INTERVAL '1' MINUTE * CAST(l_linenumber*l_quantity*60 + CAST(floor(l_extendedprice) AS BIGINT)%60 AS INT) AS t
 FROM lineitem l JOIN orders o ON l_orderkey=o_orderkey
), ev AS (
 SELECT concat('INC', lpad(CAST(o_orderkey AS VARCHAR(20)),10,'0')) AS number,
  l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  o_orderdate AS opened_at, t AS sys_updated_at,
  CASE WHEN NOT (l_linestatus='O' AND l_discount<0.015) THEN t END AS resolved_at,
  CASE WHEN NOT (l_linestatus='O' AND l_discount<0.015) AND l_tax<0.075
   THEN t + INTERVAL '1' MINUTE * CAST(l_quantity*37+l_linenumber AS INT) END AS closed_at,
  NOT (l_quantity + w + 8*r + (g*37)%120 + (k*23)%120 > 160) AS made_sla,
  l_linestatus='O' AS active,
  r AS reassignment_count,
  CASE WHEN l_linestatus='O' AND l_discount>=0.09 THEN 1 ELSE 0 END AS reopen_count,
  l_linenumber AS sys_mod_count,
  CASE WHEN l_linestatus='O' THEN 'Active' ELSE 'Closed' END AS incident_state,
  CASE WHEN l_tax>=0.08 THEN NULL ELSE concat('Group ',CAST(g AS VARCHAR(20))) END AS assignment_group,
  CASE WHEN l_discount<0.005 AND l_linestatus='F' THEN NULL ELSE concat('Category ',CAST(k AS VARCHAR(20))) END AS category,
  CASE o_orderpriority WHEN '1-URGENT' THEN '1 - Critical' WHEN '2-HIGH' THEN '2 - High'
   WHEN '3-MEDIUM' THEN '3 - Moderate' WHEN '5-LOW' THEN '4 - Low' END AS priority,
  concat('Caller ',CAST(o_custkey AS VARCHAR(20))) AS caller_id,
  concat('Resolver ',CAST(l_suppkey AS VARCHAR(20))) AS resolved_by
 FROM base
)"""

_INCIDENTS = (
    _EVENTS
    + """, rk AS (
 SELECT *, row_number() OVER (PARTITION BY number ORDER BY sys_updated_at DESC, l_linenumber DESC,
   l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn,
  max(reassignment_count) OVER (PARTITION BY number) AS mr,
  max(reopen_count) OVER (PARTITION BY number) AS mo,
  max(sys_mod_count) OVER (PARTITION BY number) AS mm
 FROM ev
), inc AS (
 SELECT number, opened_at, resolved_at, closed_at,
  (epoch_us(resolved_at)-epoch_us(opened_at))/3.6e9 AS resolution_time_hours,
  (epoch_us(closed_at)-epoch_us(opened_at))/3.6e9 AS closure_time_hours,
  made_sla, NOT made_sla AS sla_breached, mr AS reassignment_count,
  CASE WHEN mr<=0 THEN '0' WHEN mr<=2 THEN '1-2' WHEN mr<=5 THEN '3-5' ELSE '6+' END AS reassignment_bucket,
  mo AS reopen_count, mo>0 AS reopened, mm AS sys_mod_count, incident_state, active, category,
  priority, assignment_group, caller_id, resolved_by, sys_updated_at, l_linenumber AS line,
  CAST(opened_at AS DATE) AS opened_date,
  substr(CAST(opened_at AS VARCHAR),1,7) AS opened_month,
  CAST(year(opened_at) AS INT) AS opened_year
 FROM rk WHERE rn=1
)"""
)

_LEVEL = """CASE priority WHEN '1 - Critical' THEN 'Critical' WHEN '2 - High' THEN 'High'
 WHEN '3 - Moderate' THEN 'Moderate' WHEN '4 - Low' THEN 'Low' ELSE 'Unknown' END"""
_BUCKET_LEVEL = (
    "CASE WHEN reassignment_bucket IN ('0','1-2','3-5','6+') THEN reassignment_bucket ELSE 'Unknown' END"
)
_MET = "count(*) FILTER (WHERE made_sla)"
_BREACHED = "count(*) FILTER (WHERE sla_breached)"
_RESOLVED = "count(*) FILTER (WHERE resolution_time_hours IS NOT NULL)"


def _pct2(part: str, whole: str = "count(*)") -> str:
    return f"((20000*({part}) + ({whole})) // (2*({whole}))) / 100e0"


def _two(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,9)),2) AS DOUBLE)"


def _six(value: str) -> str:
    return f"round({value}, 6)"


def _q(p: float, column: str = "resolution_time_hours") -> str:
    return f"quantile_cont({column}, {p})"


def _pct(part: str, whole: str) -> str:
    return f"({part}) / CAST(({whole}) AS DOUBLE) * 100.0"


def _all(table: str, columns: dict[str, str] | list[str], tail: str = "") -> str:
    if isinstance(columns, list):
        columns = {c: c for c in columns}
    items = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f" SELECT {items} FROM {table} {tail}"


def _inc(columns: dict[str, str] | list[str], tail: str = "") -> str:
    return _INCIDENTS + _all("inc", columns, tail)


# --------------------------------------------------------- segment tables (CTE)

_Z = 1.96


def _wilson(sign: str) -> str:
    n, p = "CAST(incident_count AS DOUBLE)", "(sla_breaches/CAST(incident_count AS DOUBLE))"
    z2 = f"{_Z**2!r}"
    center = f"({p} + {z2}/(2*{n})) / (1 + {z2}/{n})"
    margin = f"{_Z} * sqrt({p}*(1-{p})/{n} + {z2}/(4*{n}*{n})) / (1 + {z2}/{n})"
    if sign == "-":
        return f"greatest(0.0, {center} - {margin})"
    return f"least(1.0, {center} + {margin})"


def _segment_cte(name: str, key: str) -> str:
    """A full-precision segment table with every measure any report uses."""
    return f""", {name}_raw AS (
 SELECT {key}, count(DISTINCT number) AS incident_count,
  {_BREACHED} AS sla_breaches, count(resolved_at) AS resolved_incidents,
  count(*) FILTER (WHERE resolved_at IS NULL) AS missing_resolution,
  {_q(0.5)} AS median_resolution_hours, {_q(0.9)} AS p90_resolution_hours,
  avg(resolution_time_hours) AS mean_resolution_hours,
  count(*) FILTER (WHERE reassignment_count>0) AS reassigned_incidents,
  avg(reassignment_count) AS mean_reassignment_count
 FROM inc WHERE {key} IS NOT NULL GROUP BY {key}
), {name} AS (
 SELECT *, sla_breaches/CAST(incident_count AS DOUBLE)*100 AS breach_rate,
  (1-sla_breaches/CAST(incident_count AS DOUBLE))*100 AS sla_compliance,
  resolved_incidents/CAST(incident_count AS DOUBLE)*100 AS resolution_coverage,
  reassigned_incidents/CAST(incident_count AS DOUBLE)*100 AS reassignment_rate,
  {_wilson('-')}*100 AS breach_rate_ci_lower, {_wilson('+')}*100 AS breach_rate_ci_upper,
  incident_count>=100 AS eligible_for_comparison
 FROM {name}_raw
)"""


_CAT = _segment_cte("cat", "category")
_PRI = _segment_cte("pri", "priority")
_BKT = _segment_cte("bkt", "reassignment_bucket")
_GRP = _segment_cte("grp", "assignment_group")
_MON = _segment_cte("mon", "opened_month")

_WORST = "eligible_for_comparison DESC, breach_rate DESC NULLS LAST, incident_count DESC"

_DOUBLES = {
    "median_resolution_hours", "p90_resolution_hours", "mean_resolution_hours",
    "mean_reassignment_count", "breach_rate", "sla_compliance", "resolution_coverage",
    "reassignment_rate", "breach_rate_ci_lower", "breach_rate_ci_upper", "volume_threshold",
    "breach_rate_threshold", "incident_share_pct", "elevated_risk_share_pct",
    "critical_risk_share_pct", "mean_sla_risk_score", "median_sla_risk_score",
    "min_sla_risk_score", "max_sla_risk_score", "mean_risk_factor_count", "sla_risk_score",
    "resolution_time_hours", "closure_time_hours",
}


def _pick(*names: str) -> dict[str, str]:
    rounded = lambda n: n in _DOUBLES or n.endswith(("_contribution", "_historical_breach_rate"))
    return {n: _six(n) if rounded(n) else n for n in names}


_MEASURES = ["incident_count", "sla_breaches", "median_resolution_hours", "p90_resolution_hours"]
_REASSIGNED = ["reassigned_incidents", "mean_reassignment_count"]
_CI = ["breach_rate_ci_lower", "breach_rate_ci_upper"]

# ---------------------------------------------------------------- bottlenecks

_BOT = (
    _GRP
    + """, thr AS (
 SELECT quantile_cont(incident_count,0.5) AS volume_threshold,
  quantile_cont(breach_rate,0.5) AS breach_rate_threshold
 FROM grp WHERE eligible_for_comparison
), bot AS (
 SELECT grp.*, thr.*,
  CASE WHEN incident_count>=volume_threshold THEN 'High Volume' ELSE 'Lower Volume' END AS volume_class,
  CASE WHEN breach_rate>=breach_rate_threshold THEN 'High Breach Risk' ELSE 'Lower Breach Risk' END AS breach_risk_class,
  CASE WHEN incident_count>=volume_threshold AND breach_rate>=breach_rate_threshold THEN 'Critical Bottleneck'
   WHEN incident_count>=volume_threshold THEN 'Volume Bottleneck'
   WHEN breach_rate>=breach_rate_threshold THEN 'SLA Risk' ELSE 'Lower Priority' END AS bottleneck_class
 FROM grp, thr WHERE eligible_for_comparison
), drv AS (
 SELECT *, CASE WHEN bottleneck_class='Critical Bottleneck' THEN bottleneck_class
  ELSE 'Other Eligible Groups' END AS driver_segment FROM bot
)"""
)


def _compared(label: str, column: str) -> str:
    c = f"quantile_cont({column},0.5) FILTER (WHERE driver_segment='Critical Bottleneck')"
    o = f"quantile_cont({column},0.5) FILTER (WHERE driver_segment<>'Critical Bottleneck')"
    return (
        f"SELECT '{label}' AS metric, {_six(c)} AS critical_bottlenecks,"
        f" {_six(o)} AS other_eligible_groups, {_six(f'{c} - {o}')} AS difference"
        " FROM drv HAVING count(DISTINCT driver_segment)=2"
    )


# ----------------------------------------------------------------------- risk


def _reference_part(label: str, table: str, key: str, where: str = "") -> str:
    return (
        f"SELECT '{label}' AS factor_type, {key} AS factor_value, incident_count, sla_breaches,"
        f" breach_rate, breach_rate_ci_lower, breach_rate_ci_upper FROM {table} {where}"
    )


_FACTORS = [
    ("priority", "Priority", "priority"),
    ("reassignment_bucket", "Reassignment Bucket", "reassignment"),
    ("category", "Category", "category"),
    ("assignment_group", "Assignment Group", "assignment_group"),
]
_REF = (
    _CAT + _PRI + _BKT + _GRP + ", ref AS ("
    + " UNION ALL ".join(
        [
            _reference_part("Priority", "pri", "priority"),
            _reference_part("Reassignment Bucket", "bkt", "reassignment_bucket"),
            _reference_part("Category", "cat", "category", "WHERE eligible_for_comparison"),
            _reference_part("Assignment Group", "grp", "assignment_group", "WHERE eligible_for_comparison"),
        ]
    )
    + ")"
)
_CONTRIBUTIONS = [f"{p}_risk_contribution" for _, _, p in _FACTORS]
_RATES = [f"{p}_historical_breach_rate" for _, _, p in _FACTORS]
_SCORES = (
    _REF
    + ", rated AS (SELECT inc.number, inc.priority, inc.reassignment_bucket, inc.category, inc.assignment_group, "
    + ", ".join(f"r{i}.breach_rate AS {rate}" for i, rate in enumerate(_RATES))
    + " FROM inc "
    + " ".join(
        f"LEFT JOIN ref r{i} ON r{i}.factor_type='{label}' AND r{i}.factor_value=inc.{column}"
        for i, (column, label, _) in enumerate(_FACTORS)
    )
    + "), contributed AS (SELECT *, "
    + ", ".join(
        f"CASE WHEN {r} IS NULL THEN NULL WHEN {r}<=36.58e0 THEN 0e0 WHEN {r}>=100 THEN 1e0"
        f" ELSE ({r}-36.58e0)/(100e0-36.58e0) END AS {c}"
        for r, c in zip(_RATES, _CONTRIBUTIONS)
    )
    + " FROM rated), counted AS (SELECT *, CAST("
    + " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in _CONTRIBUTIONS)
    + " AS INT) AS risk_factor_count FROM contributed), measured AS (SELECT *, ("
    + " + ".join(f"coalesce({c},0e0)" for c in _CONTRIBUTIONS)
    + ") / nullif(risk_factor_count,0) * 100e0 AS sla_risk_score FROM counted)"
    + ", sco AS (SELECT *, CASE WHEN sla_risk_score<25 THEN 'Low' WHEN sla_risk_score<50 THEN 'Moderate'"
    + " WHEN sla_risk_score<75 THEN 'High' WHEN sla_risk_score>=75 THEN 'Critical' END AS sla_risk_band FROM measured)"
)
_PORTFOLIO = (
    _SCORES
    + """, por AS (SELECT b.band AS sla_risk_band, count(s.number) AS incident_count,
 count(s.number)/CAST((SELECT count(*) FROM sco) AS DOUBLE)*100 AS incident_share_pct,
 avg(sla_risk_score) AS mean_sla_risk_score, quantile_cont(sla_risk_score,0.5) AS median_sla_risk_score,
 min(sla_risk_score) AS min_sla_risk_score, max(sla_risk_score) AS max_sla_risk_score,
 avg(risk_factor_count) AS mean_risk_factor_count
 FROM (VALUES ('Low'),('Moderate'),('High'),('Critical')) b(band) LEFT JOIN sco s ON s.sla_risk_band=b.band
 GROUP BY b.band)"""
)


def _dimension(label: str, column: str) -> str:
    flag = "count(*)>=100" if label in ("Category", "Assignment Group") else "TRUE"
    elevated = "count(*) FILTER (WHERE sla_risk_band IN ('High','Critical'))"
    critical = "count(*) FILTER (WHERE sla_risk_band='Critical')"
    return (
        f"SELECT '{label}' AS dimension, {column} AS dimension_value, count(*) AS incident_count,"
        f" {elevated} AS elevated_risk_incident_count, {_pct(elevated, 'count(*)')} AS elevated_risk_share_pct,"
        f" {critical} AS critical_risk_incident_count, {_pct(critical, 'count(*)')} AS critical_risk_share_pct,"
        " avg(sla_risk_score) AS mean_sla_risk_score,"
        " quantile_cont(sla_risk_score,0.5) AS median_sla_risk_score,"
        f" avg(risk_factor_count) AS mean_risk_factor_count, {flag} AS comparison_eligible"
        f" FROM sco WHERE {column} IS NOT NULL GROUP BY {column}"
    )


_CONCENTRATION = (
    _SCORES
    + ", con AS ("
    + " UNION ALL ".join(_dimension(label, column) for column, label, _ in _FACTORS)
    + ")"
)
_CON_COLUMNS = [
    "dimension", "dimension_value", "incident_count", "elevated_risk_incident_count",
    "elevated_risk_share_pct", "critical_risk_incident_count", "critical_risk_share_pct",
    "mean_sla_risk_score", "median_sla_risk_score", "mean_risk_factor_count", "comparison_eligible",
]

# --------------------------------------------------------------------- checks


# The order behind an incident; the faulty frames are made by its last digits.
_KEY = "CAST(substr(number, 4) AS BIGINT)"


def _checks(ctes: str, *parts: tuple[str, list[tuple[str, str]]]) -> str:
    """Rows of rule names with a count. Each part is (table, [(rule, SQL)]): a
    SQL text with an aggregate is used as it stands, a condition is counted."""
    rows = []
    for table, rules in parts:
        for name, sql in rules:
            name, _, severity = name.partition("!")
            aggregate = sql if sql.startswith("=") else f"=count(*) FILTER (WHERE {sql})"
            rows.append(
                f"SELECT '{name}' AS check_name, '{severity or 'error'}' AS severity,"
                f" CAST({aggregate[1:]} AS BIGINT) AS violations FROM {table}"
            )
    return _INCIDENTS + ctes + " " + " UNION ALL ".join(rows)


_INTERVAL = [
    ("rate_in_interval", "breach_rate < breach_rate_ci_lower-1e-9 OR breach_rate > breach_rate_ci_upper+1e-9"),
    ("interval_in_bounds", "breach_rate_ci_lower<0 OR breach_rate_ci_upper>100"),
]
_SAMPLE = [("eligibility", "eligible_for_comparison <> (incident_count>=100)")]
_COVERAGE = [
    ("coverage_definition", "abs(resolution_coverage - 100e0*resolved_incidents/incident_count) > 1e-6"),
    ("coverage_range", "resolution_coverage<0 OR resolution_coverage>100"),
]


def _total(name: str, column: str, key: str, source: str) -> tuple[str, str]:
    return (
        name,
        f"=abs(coalesce(sum({column}),0) - (SELECT {source} FROM inc WHERE {key} IS NOT NULL))",
    )


def _reconciled(table: str, key: str, rules: list, *totals: str, distinct: bool = True):
    columns = {
        "incident_total": ("incident_count", "count(*)"),
        "breach_total": ("sla_breaches", _BREACHED),
        "resolved_total": ("resolved_incidents", "count(resolved_at)"),
        "missing_total": ("missing_resolution", "count(*) FILTER (WHERE resolved_at IS NULL)"),
    }
    found = [_total(name, columns[name][0], key, columns[name][1]) for name in totals]
    if distinct:
        found.append(
            ("segment_count", f"=abs(count(DISTINCT {key}) - (SELECT count(DISTINCT {key}) FROM inc))")
        )
    return (table, [*rules, *found])


def _hours(*names: str) -> list[tuple[str, str]]:
    return [(f"{n}_negative", f"{n}<0") for n in names]


def _missing(*names: str) -> str:
    return " OR ".join(f"{n} IS NULL" for n in names)


_STATS = [f"{s}_sla_risk_score" for s in ("mean", "median", "min", "max")]
_STATS_RULES = [
    *[(f"{c}_missing", f"{c} IS NULL") for c in _STATS],
    *[(f"{c}_range", f"{c}<0 OR {c}>100") for c in _STATS],
    ("factor_count_missing", "mean_risk_factor_count IS NULL"),
    ("factor_count_negative", "mean_risk_factor_count<0"),
]
_DRIVER_METRICS = [*_MEASURES, "breach_rate", "reassignment_rate", "mean_reassignment_count"]
_ROUND_TRIP = [
    "number", "opened_at", "resolved_at", "closed_at", "resolution_time_hours",
    "closure_time_hours", "made_sla", "sla_breached", "reassignment_count",
    "reassignment_bucket", "reopen_count", "reopened", "category", "priority",
    "assignment_group", "opened_date", "opened_month", "opened_year",
]


def _with_faults(check: str, text: str) -> str:
    """The SQL of a check with its frame replaced by the one with faults."""
    table = faults.FAULTS[check][0]
    at = re.search(r"SELECT '\w+' AS check_name", text).start()
    body = re.sub(rf"\b{table}\b", f"{table}_faulty", text[at:])
    return f"{text[:at].rstrip()}, {table}_faulty AS ({faults.planted_sql(check)}) {body}"


def _check_texts() -> dict[str, str]:
    found = _sound_check_texts()
    for check in faults.FAULTS:
        found[faults.query_name(check)] = _with_faults(check, found[check])
    return found


def _sound_check_texts() -> dict[str, str]:
    expected = "(SELECT count(DISTINCT l_orderkey) FROM lineitem)"
    distinct = "count(*) - count(DISTINCT {})"
    return {
        "v01_incidents": _checks(
            "",
            (
                "inc",
                [
                    ("opened_at_missing", "opened_at IS NULL"),
                    ("resolved_at_missing!info", "resolved_at IS NULL"),
                    ("negative_resolution!warning", "resolution_time_hours<0"),
                    ("negative_closure!warning", "closure_time_hours<0"),
                    ("duplicate_numbers", "=" + distinct.format("number")),
                    ("row_count", f"=abs(count(*) - {expected})"),
                    ("number_count", f"=abs(count(DISTINCT number) - {expected})"),
                ],
            ),
        ),
        "v01_faults": _checks(
            f", faulty AS (SELECT number, resolved_at, CASE WHEN {_KEY}%50<>1 THEN opened_at END AS opened_at,"
            f" CASE WHEN {_KEY}%50=2 THEN -1.0 ELSE resolution_time_hours END AS resolution_time_hours,"
            f" CASE WHEN {_KEY}%50=3 THEN -1.0 ELSE closure_time_hours END AS closure_time_hours FROM inc"
            f" UNION ALL SELECT number, resolved_at, opened_at, resolution_time_hours, closure_time_hours FROM inc WHERE {_KEY}%50=0)",
            (
                "faulty",
                [
                    ("opened_at_missing", "opened_at IS NULL"),
                    ("resolved_at_missing!info", "resolved_at IS NULL"),
                    ("negative_resolution!warning", "resolution_time_hours<0"),
                    ("negative_closure!warning", "closure_time_hours<0"),
                    ("duplicate_numbers", "=" + distinct.format("number")),
                    ("row_count", f"=abs(count(*) - {expected})"),
                    ("number_count", f"=abs(count(DISTINCT number) - {expected})"),
                ],
            ),
        ),
        "v11_faults": _checks(
            f", faulty AS (SELECT CASE WHEN {_KEY}%50=4 THEN '6+' ELSE reassignment_bucket END AS b,"
            " reassignment_count AS c FROM inc)",
            (
                "faulty",
                [("bucket_definition", "b <> CASE WHEN c=0 THEN '0' WHEN c<=2 THEN '1-2' WHEN c<=5 THEN '3-5' ELSE '6+' END")],
            ),
        ),
        "v14_faults": _checks(
            f", faulty AS (SELECT CASE WHEN {_KEY}%50<>5 THEN number END AS number FROM inc"
            f" UNION ALL SELECT number FROM inc WHERE {_KEY}%50=0)",
            (
                "faulty",
                [
                    ("header", "=2 + 0*count(*)"),
                    ("types", "=1 + 0*count(*)"),
                    ("row_count", f"=abs(count(*) - {expected})"),
                    ("duplicate_numbers", "=count(number) - count(DISTINCT number)"),
                    ("missing_numbers", "=count(*) - count(number)"),
                ],
            ),
        ),
        "v02_risk_scores": _checks(
            _SCORES,
            (
                "sco",
                [
                    ("factor_count", "risk_factor_count <> " + " + ".join(
                        f"(CASE WHEN {r} IS NULL THEN 0 ELSE 1 END)" for r in _RATES)),
                    ("factor_count_range", "risk_factor_count<2 OR risk_factor_count>4"),
                    *[(f"{c}_range", f"{c}<0 OR {c}>100") for c in _RATES],
                    *[(f"{c}_range", f"{c}<0 OR {c}>1") for c in _CONTRIBUTIONS],
                    ("missing_pattern", " OR ".join(
                        f"(({r} IS NULL) <> ({c} IS NULL))" for r, c in zip(_RATES, _CONTRIBUTIONS))),
                    ("score_missing", "sla_risk_score IS NULL"),
                    ("score_range", "sla_risk_score<0 OR sla_risk_score>100"),
                    ("score_definition", "abs(sla_risk_score - 100e0*list_avg(["
                     + ",".join(_CONTRIBUTIONS) + "])) > 1e-9"),
                    ("band_missing", "sla_risk_band IS NULL"),
                    ("band_unknown", "sla_risk_band NOT IN ('Low','Moderate','High','Critical')"),
                    ("band_definition", "sla_risk_score IS NOT NULL AND sla_risk_band <> (CASE WHEN sla_risk_score>=75 THEN 'Critical'"
                     " WHEN sla_risk_score>=50 THEN 'High' WHEN sla_risk_score>=25 THEN 'Moderate' ELSE 'Low' END)"),
                    ("row_count", "=abs(count(*) - (SELECT count(*) FROM inc))"),
                    ("number_count", "=abs(count(DISTINCT number) - (SELECT count(DISTINCT number) FROM inc))"),
                    ("duplicate_numbers", "=" + distinct.format("number")),
                ],
            ),
            *[
                (
                    f"(SELECT DISTINCT {column} AS v, {rate} AS a FROM sco) u LEFT JOIN ref"
                    f" ON ref.factor_type='{label}' AND ref.factor_value=u.v",
                    [(f"{prefix}_reference_mapping",
                      "(ref.factor_value IS NULL AND a IS NOT NULL) OR (ref.factor_value IS NOT NULL"
                      " AND (a IS NULL OR abs(a-ref.breach_rate)>1e-10))")],
                )
                for (column, label, prefix), rate in zip(_FACTORS, _RATES)
            ],
        ),
        "v03_portfolio": _checks(
            _PORTFOLIO,
            (
                "por",
                [
                    ("band_set", "=abs(count(*)-4) + 4 - count(DISTINCT sla_risk_band) FILTER (WHERE sla_risk_band IN ('Low','Moderate','High','Critical'))"),
                    ("negative_counts", "incident_count<0"),
                    ("share_range", "incident_share_pct<0 OR incident_share_pct>100"),
                    ("share_total", "=CASE WHEN abs(sum(incident_share_pct)-100)>1e-6 THEN 1 ELSE 0 END"),
                    *_STATS_RULES,
                    ("incident_total", "=abs(sum(incident_count) - (SELECT count(*) FROM inc))"),
                ],
            ),
        ),
        "v04_concentration": _checks(
            _CONCENTRATION,
            (
                "con",
                [
                    ("unknown_dimensions", "dimension NOT IN ('Priority','Reassignment Bucket','Category','Assignment Group')"),
                    ("missing_dimensions", "=4 - count(DISTINCT dimension) FILTER (WHERE dimension IN ('Priority','Reassignment Bucket','Category','Assignment Group'))"),
                    ("duplicate_values", "=count(*) - count(DISTINCT (dimension, dimension_value))"),
                    *[(f"{c}_negative", f"{c}<0") for c in
                      ("incident_count", "elevated_risk_incident_count", "critical_risk_incident_count")],
                    ("elevated_within_incidents", "elevated_risk_incident_count>incident_count"),
                    ("critical_within_elevated", "critical_risk_incident_count>elevated_risk_incident_count"),
                    *[(f"{c}_range", f"{c}<0 OR {c}>100") for c in
                      ("elevated_risk_share_pct", "critical_risk_share_pct")],
                    *[rule for rule in _STATS_RULES if not rule[0].startswith(("min_", "max_"))],
                    ("eligibility", "dimension IN ('Category','Assignment Group') AND comparison_eligible <> (incident_count>=100)"),
                    ("always_eligible", "dimension NOT IN ('Category','Assignment Group') AND NOT comparison_eligible"),
                    *[
                        (f"{prefix}_coverage",
                         f"=abs(count(*) FILTER (WHERE dimension='{label}') - (SELECT count(DISTINCT {column}) FROM inc))")
                        for column, label, prefix in _FACTORS
                    ],
                ],
            ),
        ),
        "v05_monthly": _checks(
            _MON,
            (
                "mon",
                [
                    ("not_empty", "=CASE WHEN count(*)=0 THEN 1 ELSE 0 END"),
                    ("month_missing", "opened_month IS NULL"),
                    ("duplicate_months", "=" + distinct.format("row(opened_month)")),
                    ("count_positive", "incident_count<=0"),
                    ("breaches_negative", "sla_breaches<0"),
                    ("breaches_within_count", "sla_breaches>incident_count"),
                    ("breach_rate_range", "breach_rate<0 OR breach_rate>100"),
                    ("reassignment_rate_range", "reassignment_rate<0 OR reassignment_rate>100"),
                    ("mean_missing", "mean_reassignment_count IS NULL"),
                    ("mean_negative", "mean_reassignment_count<0"),
                    ("median_negative", "median_resolution_hours<0"),
                    ("p90_negative", "p90_resolution_hours<0"),
                    *_SAMPLE,
                    ("incident_total", "=abs(sum(incident_count) - (SELECT count(*) FROM inc))"),
                ],
            ),
        ),
        "v06_drivers": _checks(
            _BOT,
            (
                "drv",
                [
                    ("duplicate_groups", "=" + distinct.format("assignment_group")),
                    ("no_missing_values", _missing(
                        "assignment_group", "bottleneck_class", "driver_segment", *_DRIVER_METRICS)),
                    ("segment_rule", "(driver_segment='Critical Bottleneck') <> (bottleneck_class='Critical Bottleneck')"),
                    ("class_set", "=max((SELECT count(*) FROM (SELECT bottleneck_class FROM drv EXCEPT SELECT bottleneck_class FROM bot))"
                     " + (SELECT count(*) FROM (SELECT bottleneck_class FROM bot EXCEPT SELECT bottleneck_class FROM drv)))"),
                    ("critical_count", "=abs(count(*) FILTER (WHERE driver_segment='Critical Bottleneck')"
                     " - (SELECT count(*) FROM bot WHERE bottleneck_class='Critical Bottleneck'))"),
                    ("eligible_groups", "=max((SELECT count(*) FROM (SELECT DISTINCT assignment_group FROM grp WHERE eligible_for_comparison) g"
                     " ANTI JOIN drv USING (assignment_group))"
                     " + (SELECT count(*) FROM drv ANTI JOIN (SELECT * FROM grp WHERE eligible_for_comparison) g USING (assignment_group)))"),
                ],
            ),
            (
                "drv JOIN grp USING (assignment_group)",
                [("metric_match", " OR ".join(
                    f"drv.{m} IS DISTINCT FROM grp.{m}" for m in _DRIVER_METRICS))],
            ),
        ),
        "v07_bottlenecks": _checks(
            _BOT,
            (
                "bot",
                [
                    ("duplicate_groups", "=" + distinct.format("assignment_group")),
                    ("no_missing_values", _missing(
                        "assignment_group", "incident_count", "breach_rate", "volume_class",
                        "breach_risk_class", "bottleneck_class", "volume_threshold", "breach_rate_threshold")),
                    ("volume_class", "(volume_class='High Volume') <> (incident_count>=volume_threshold)"),
                    ("breach_risk_class", "(breach_risk_class='High Breach Risk') <> (breach_rate>=breach_rate_threshold)"),
                    ("bottleneck_class", "bottleneck_class <> (CASE WHEN incident_count>=volume_threshold AND breach_rate>=breach_rate_threshold"
                     " THEN 'Critical Bottleneck' WHEN incident_count>=volume_threshold THEN 'Volume Bottleneck'"
                     " WHEN breach_rate>=breach_rate_threshold THEN 'SLA Risk' ELSE 'Lower Priority' END)"),
                    ("unknown_classes", "bottleneck_class NOT IN ('Critical Bottleneck','Volume Bottleneck','SLA Risk','Lower Priority')"),
                    ("single_thresholds", "=greatest(count(DISTINCT (volume_threshold, breach_rate_threshold))-1,0)"),
                    ("eligible_groups", "=abs(count(*) - (SELECT count(*) FROM grp WHERE incident_count>=100))"),
                ],
            ),
        ),
        "v08_risk_reference": _checks(
            _REF,
            (
                "ref",
                [
                    ("no_missing_values", _missing(
                        "factor_type", "factor_value", "incident_count", "sla_breaches", "breach_rate", *_CI)),
                    ("unknown_types", "factor_type NOT IN ('Priority','Reassignment Bucket','Category','Assignment Group')"),
                    ("missing_types", "=4 - count(DISTINCT factor_type) FILTER (WHERE factor_type IN ('Priority','Reassignment Bucket','Category','Assignment Group'))"),
                    ("duplicate_factors", "=count(*) - count(DISTINCT (factor_type, factor_value))"),
                    ("count_positive", "incident_count<=0"),
                    ("breaches_negative", "sla_breaches<0"),
                    ("breaches_within_count", "sla_breaches>incident_count"),
                    ("rate_definition", "abs(breach_rate - 100e0*sla_breaches/incident_count) > 1e-6"),
                    *_INTERVAL,
                    ("priority_rows", "=abs(count(*) FILTER (WHERE factor_type='Priority') - (SELECT count(*) FROM pri))"),
                    ("reassignment_rows", "=abs(count(*) FILTER (WHERE factor_type='Reassignment Bucket') - (SELECT count(*) FROM bkt))"),
                    ("category_rows", "=abs(count(*) FILTER (WHERE factor_type='Category')"
                     " - (SELECT count(*) FROM cat WHERE incident_count>=100))"),
                    ("assignment_group_rows", "=abs(count(*) FILTER (WHERE factor_type='Assignment Group')"
                     " - (SELECT count(*) FROM grp WHERE incident_count>=100))"),
                ],
            ),
        ),
        "v09_category": _checks(
            _CAT, _reconciled("cat", "category", [*_INTERVAL, *_SAMPLE], "incident_total")
        ),
        "v10_priority": _checks(
            _PRI, _reconciled("pri", "priority", _INTERVAL, "incident_total", "breach_total")
        ),
        "v11_reassignment": _checks(
            _BKT,
            _reconciled("bkt", "reassignment_bucket", _INTERVAL, "incident_total", "breach_total"),
            (
                "inc",
                [("bucket_definition", "reassignment_bucket <> (CASE WHEN reassignment_count=0 THEN '0'"
                  " WHEN reassignment_count BETWEEN 1 AND 2 THEN '1-2' WHEN reassignment_count BETWEEN 3 AND 5 THEN '3-5'"
                  " WHEN reassignment_count>=6 THEN '6+' ELSE 'INVALID' END)")],
            ),
        ),
        "v12_reassignment_resolution": _checks(
            _BKT,
            _reconciled(
                "bkt",
                "reassignment_bucket",
                [*_COVERAGE, *_hours("median_resolution_hours", "p90_resolution_hours", "mean_resolution_hours")],
                "incident_total", "resolved_total", "missing_total",
                distinct=False,
            ),
        ),
        "v13_assignment_group": _checks(
            _GRP,
            _reconciled(
                "grp",
                "assignment_group",
                [*_INTERVAL, *_SAMPLE, *_COVERAGE, *_hours("median_resolution_hours", "p90_resolution_hours")],
                "incident_total", "breach_total", "resolved_total", "missing_total",
            ),
            (
                "inc",
                [("missing_group_count", "=abs(count(*) FILTER (WHERE assignment_group IS NULL)"
                  " - (count(*) - count(assignment_group)))")],
            ),
        ),
        "v14_load": _checks(
            "",
            (
                "inc",
                [
                    ("header", "=0*count(*)"),
                    ("types", "=0*count(*)"),
                    ("row_count", f"=abs(count(*) - {expected})"),
                    ("duplicate_numbers", "=count(number) - count(DISTINCT number)"),
                    ("missing_numbers", "=count(*) - count(number)"),
                ],
            ),
        ),
    }


def texts() -> dict[str, str]:
    clock = ["opened_at", "sys_updated_at", "resolved_at", "closed_at"]
    counters = ["reassignment_count", "reopen_count", "sys_mod_count"]
    events = lambda *names: _EVENTS + _all("ev", ["number", *names])
    rows = lambda *names: _inc(_pick("number", *names))
    sla_counts = {"incident_count": "count(*)", "sla_met_incidents": _MET, "sla_breached_incidents": _BREACHED}
    sla_rates = {"sla_compliance_rate_pct": _pct2(_MET), "sla_breach_rate_pct": _pct2(_BREACHED)}
    mean2 = {"mean_resolution_hours": _two("avg(resolution_time_hours)")}
    by_level = {"priority_level": _LEVEL, **sla_counts, **sla_rates}
    by_bucket = {
        "reassignment_level": "reassignment_bucket", "incident_count": "count(*)",
        "sla_breached_incidents": _BREACHED, **sla_rates,
    }
    monthly = {
        "opened_month": "opened_month", "incident_count": "count(*)",
        "sla_breached_incidents": _BREACHED, **sla_rates, "resolved_incidents": _RESOLVED, **mean2,
    }
    without = lambda columns, *names: {k: v for k, v in columns.items() if k not in names}
    exposure = {
        "incident_count": "count(*)", "sla_breached_incidents": _BREACHED,
        "sla_breach_rate_pct": _pct2(_BREACHED), **mean2,
    }
    kpi_rate = lambda part: _six(_pct(part, "count(*)"))
    reassigned = "count(*) FILTER (WHERE reassignment_count>0)"
    kpi_group = lambda key, reopen: {
        key: key, "incident_count": "count(number)", "sla_breached": _BREACHED,
        "median_resolution_hours": _six(_q(0.5)), "p90_resolution_hours": _six(_q(0.9)),
        "reassignment_rate": kpi_rate(reassigned),
        **({"reopen_rate": kpi_rate("count(*) FILTER (WHERE reopened)")} if reopen else {}),
        "sla_breach_rate": kpi_rate(_BREACHED),
    }
    top_kpi = lambda key: f"GROUP BY {key} ORDER BY count(number) DESC, {key} NULLS LAST LIMIT 10"
    rate_list = ["incident_count", "sla_breaches", "breach_rate", *_CI]
    breach_list = ["incident_count", "sla_breaches", "breach_rate"]
    top = lambda cte, table, key, columns, by: (
        _INCIDENTS + cte + _all(
            table, _pick(key, *columns),
            f"WHERE eligible_for_comparison ORDER BY {table}.{by} DESC NULLS LAST, {table}.breach_rate DESC,"
            f" incident_count DESC, {key} LIMIT 10",
        )
    )
    table = lambda cte, name, columns, tail="": _INCIDENTS + cte + _all(name, _pick(*columns), tail)
    category_columns = ["category", *_MEASURES, *_REASSIGNED, "breach_rate", "sla_compliance",
                        "reassignment_rate", *_CI, "eligible_for_comparison"]
    priority_columns = ["priority", *_MEASURES, *_REASSIGNED, "breach_rate", "sla_compliance",
                        "reassignment_rate", *_CI]
    group_columns = ["assignment_group", "incident_count", "resolved_incidents", "missing_resolution",
                     "sla_breaches", "median_resolution_hours", "p90_resolution_hours", *_REASSIGNED,
                     "breach_rate", "sla_compliance", "resolution_coverage", "reassignment_rate", *_CI,
                     "eligible_for_comparison"]
    reference_columns = ["factor_type", "factor_value", "incident_count", "sla_breaches", "breach_rate", *_CI]
    figures = ["incident_count", "sla_breaches", "breach_rate", "median_resolution_hours", "p90_resolution_hours"]
    class_list = lambda label: table(
        _BOT, "bot", ["assignment_group", *breach_list], f"WHERE bottleneck_class='{label}'"
    )
    score_columns = ["number", "priority", "reassignment_bucket", "category", "assignment_group",
                     *[x for pair in zip(_RATES, _CONTRIBUTIONS) for x in pair],
                     "risk_factor_count", "sla_risk_score", "sla_risk_band"]
    scored = lambda *names: table(_SCORES, "sco", ["number", *names])
    priority_rank = "CASE priority WHEN '1 - Critical' THEN 1 WHEN '2 - High' THEN 2 WHEN '3 - Moderate' THEN 3 WHEN '4 - Low' THEN 4 ELSE 5 END"
    bucket_rank = "CASE reassignment_bucket WHEN '0' THEN 1 WHEN '1-2' THEN 2 WHEN '3-5' THEN 3 WHEN '6+' THEN 4 ELSE 5 END"
    cat_counts = ", cc AS (SELECT category, count(*) AS incident_count, " + _BREACHED + \
        " AS sla_breaches FROM inc WHERE category IS NOT NULL GROUP BY category)"
    return {
        "read_event_log": _EVENTS + _all(
            "ev", {**{c: c for c in ["number", *clock, "made_sla", "active", *counters, "priority", "category",
                                     "assignment_group"]}, "location": "CAST(NULL AS VARCHAR)"}),
        **{
            query: _INCIDENTS + cte + f"SELECT {key}, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS position FROM {name}"
            for query, cte, name, key, order in (
                ("order_category", _CAT, "cat", "category", _WORST + ", category"),
                ("order_group", _GRP, "grp", "assignment_group", _WORST + ", assignment_group"),
                ("order_priority", _PRI, "pri", "priority", "priority"),
                ("order_monthly", _MON, "mon", "opened_month", "opened_month"),
                ("order_bottlenecks", _BOT, "bot", "assignment_group",
                 "bottleneck_class, breach_rate DESC NULLS LAST, incident_count DESC, assignment_group"),
                ("order_drivers", _BOT, "drv", "assignment_group",
                 "driver_segment, breach_rate DESC NULLS LAST, incident_count DESC, assignment_group"),
                ("order_risk_reference", _REF, "ref", "factor_type, factor_value",
                 "factor_type, breach_rate DESC NULLS LAST, incident_count DESC, factor_value"),
            )
        },
        "guards": _INCIDENTS + """
SELECT case_name, error_raised, (SELECT count(*) FROM inc) AS incidents FROM (VALUES
 ('sound input', FALSE), ('missing column', TRUE), ('empty reference', TRUE), ('repeated factor', TRUE),
 ('missing rate', TRUE), ('rate beyond 100', TRUE), ('baseline of 100', TRUE), ('no scores', TRUE),
 ('no eligible group', TRUE), ('no row order', TRUE), ('several headers', TRUE)) AS v(case_name, error_raised)
""",
        "several_log_files": _INCIDENTS + """
SELECT number, sys_updated_at, made_sla, reassignment_count,
 CASE WHEN line=1 THEN nullif(d.text, '') END AS u_symptom
FROM inc LEFT JOIN documents d
 ON d.doc_id = CAST(substr(number, 4) AS BIGINT) % (SELECT count(*) FROM documents)
""",
        "load_free_text": """
SELECT concat('DOC', CAST(doc_id AS VARCHAR)) AS number, nullif(text, '') AS u_symptom FROM documents
""",
        "report_free_text": """
SELECT concat('DOC', CAST(doc_id AS VARCHAR)) AS number, text AS u_symptom FROM documents
""",
        "write_incidents": _inc(_pick(*_ROUND_TRIP)),
        "load_incidents_table": _inc(_pick(*_ROUND_TRIP)),
        "read_incidents_csv": _inc(_pick(*_ROUND_TRIP)),
        "write_reports": table(_PRI, "pri", priority_columns),
        "parse_timestamps": events(*clock),
        "normalize_boolean": events("made_sla", "active"),
        "coerce_counters": events(*counters),
        "event_order": _inc(["number", "sys_updated_at", "line"]),
        "latest_event": rows("made_sla", "active", "resolved_at", "closed_at", "incident_state", "category",
                             "priority", "assignment_group", "caller_id", "resolved_by", "sys_updated_at"),
        "first_opened_at": rows("opened_at"),
        "cumulative_max": rows(*counters),
        "sla_breached": rows("sla_breached"),
        "reopened": rows("reopened"),
        "reassignment_bucket": rows("reassignment_bucket"),
        "resolution_time_hours": rows("resolution_time_hours"),
        "closure_time_hours": rows("closure_time_hours"),
        "calendar_dims": rows("opened_date", "opened_month", "opened_year"),
        "clean_incidents": _inc({**_pick(*_ROUND_TRIP), **{c: c for c in [
            "active", "sys_mod_count", "incident_state", "caller_id", "resolved_by", "sys_updated_at"]},
            "location": "CAST(NULL AS VARCHAR)"}),
        "priority_level": _inc({"number": "number", "priority_level": _LEVEL}),
        "priority_rank": _inc({"number": "number", "priority_rank": priority_rank}),
        "reassignment_level": _inc({"number": "number", "reassignment_level": _BUCKET_LEVEL}),
        "bucket_rank": _inc({"number": "number", "bucket_rank": bucket_rank}),
        "coalesce_unknown": _inc({"number": "number", "assignment_group_label": "coalesce(assignment_group,'Unknown')"}),
        "rate_pct": _inc({"opened_year": "opened_year", "incidents": "count(*)",
                          "breach_rate_pct": _pct2(_BREACHED), "breach_rate": kpi_rate(_BREACHED)},
                         "GROUP BY opened_year"),
        "filter_count": _inc({"met": _MET, "reassigned": reassigned,
                              "in_category": "count(*) FILTER (WHERE category='Category 0')"}),
        "null_predicates": _inc({
            "category_missing": "count(*) FILTER (WHERE category IS NULL)",
            "priority_missing": "count(*) FILTER (WHERE priority IS NULL)",
            "resolved_known": "count(*) FILTER (WHERE resolved_at IS NOT NULL)",
            "both_known": "count(*) FILTER (WHERE resolved_at IS NOT NULL AND closed_at IS NOT NULL)"}),
        "wilson_interval": _INCIDENTS + cat_counts + _all(
            "cc", {"category": "category", "lower": _six(_wilson("-")), "upper": _six(_wilson("+"))}),
        "eligible_flag": _INCIDENTS + cat_counts + _all(
            "cc", {"category": "category", "eligible": "incident_count>=100"}),
        "closure_lag_hours": _inc({"number": "number",
                                   "closure_lag_hours": _six("(epoch_us(closed_at)-epoch_us(resolved_at))/3.6e9")}),
        "risk_contribution": scored(*_CONTRIBUTIONS),
        "risk_factor_count": scored("risk_factor_count"),
        "risk_score": scored("sla_risk_score"),
        "risk_band": scored("sla_risk_band"),
        "kpi_overall": _inc({
            "total_incidents": "count(*)", "sla_met": _MET, "sla_breached": _BREACHED,
            "sla_compliance_rate": kpi_rate(_MET), "sla_breach_rate": kpi_rate(_BREACHED),
            "resolved_incidents": "count(resolved_at)",
            "missing_resolution_timestamp": "count(*)-count(resolved_at)",
            "resolution_coverage_rate": kpi_rate("count(resolved_at)"),
            "reassigned_incidents": reassigned, "reassignment_rate": kpi_rate(reassigned),
            "reopened_incidents": "count(*) FILTER (WHERE reopened)",
            "reopen_rate": kpi_rate("count(*) FILTER (WHERE reopened)")}),
        "kpi_resolution": _inc({
            "mean_resolution_hours": _six("avg(resolution_time_hours)"),
            **{f"{n}_resolution_hours": _six(_q(p)) for n, p in
               [("median", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)]}}),
        "kpi_closure": _inc({
            "mean_closure_hours": _six("avg(closure_time_hours)"),
            **{f"{n}_closure_hours": _six(_q(p, "closure_time_hours")) for n, p in
               [("median", 0.5), ("p90", 0.9), ("p95", 0.95)]},
            **{f"{n}_closure_lag_hours": _six(_q(p, "(epoch_us(closed_at)-epoch_us(resolved_at))/3.6e9"))
               for n, p in [("median", 0.5), ("p90", 0.9)]}}),
        "kpi_reassignment": _inc({
            "mean_reassignments": _six("avg(reassignment_count)"), "max_reassignments": "max(reassignment_count)",
            **{f"{n}_reassignments": _six(_q(p, "reassignment_count")) for n, p in
               [("median", 0.5), ("p90", 0.9), ("p95", 0.95)]}}),
        "kpi_reopen": _inc({
            "mean_reopens": _six("avg(reopen_count)"), "max_reopens": "max(reopen_count)",
            **{f"{n}_reopens": _six(_q(p, "reopen_count")) for n, p in [("median", 0.5), ("p90", 0.9)]}}),
        "kpi_monthly": _inc({
            "opened_month": "opened_month", "incident_count": "count(number)", "sla_breached": _BREACHED,
            "sla_met": _MET, "median_resolution_hours": _six(_q(0.5)), "p90_resolution_hours": _six(_q(0.9)),
            "sla_compliance_rate": kpi_rate(_MET), "sla_breach_rate": kpi_rate(_BREACHED)},
            "WHERE opened_month IS NOT NULL GROUP BY opened_month"),
        "kpi_category": _inc(kpi_group("category", True), "GROUP BY category"),
        "kpi_assignment_group": _inc(kpi_group("assignment_group", False), "GROUP BY assignment_group"),
        "kpi_top10_category": _inc(kpi_group("category", True), top_kpi("category")),
        "kpi_top10_assignment_group": _inc(kpi_group("assignment_group", False), top_kpi("assignment_group")),
        "q01_kpi_summary": _inc({
            "total_incidents": "count(*)", "resolved_incidents": "count(resolved_at)",
            "sla_met_incidents": _MET, "sla_breached_incidents": _BREACHED, **sla_rates,
            "reassigned_incidents": reassigned, "reassignment_rate_pct": _pct2(reassigned),
            "reopened_incidents": "count(*) FILTER (WHERE reopened)",
            "reopen_rate_pct": _pct2("count(*) FILTER (WHERE reopened)")}),
        "q02_priority_sla": _inc(by_level, "GROUP BY 1"),
        "q03_reassignment_sla": _inc(
            {"reassignment_level": _BUCKET_LEVEL, **sla_counts, **sla_rates}, "GROUP BY 1"),
        "q04_resolution_distribution": _inc({
            "resolved_incidents": "count(*)", **mean2,
            **{f"{n}_resolution_hours": _two(_q(p)) for n, p in
               [("median", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)]}},
            "WHERE resolution_time_hours IS NOT NULL"),
        "q05_resolution_by_priority": _inc({
            "priority_level": _LEVEL, "incident_count": "count(*)", "resolved_incidents": _RESOLVED,
            "unresolved_incidents": "count(*) FILTER (WHERE resolution_time_hours IS NULL)",
            "unresolved_rate_pct": _pct2("count(*) FILTER (WHERE resolution_time_hours IS NULL)"),
            "median_resolution_hours": _two(_q(0.5)), "p90_resolution_hours": _two(_q(0.9))}, "GROUP BY 1"),
        "q06_category_sla": _inc({"category": "category", **exposure}, "GROUP BY category HAVING count(*)>=100"),
        "q07_assignment_group": _inc({"assignment_group": "coalesce(assignment_group,'Unknown')", **exposure},
                                     "GROUP BY coalesce(assignment_group,'Unknown') HAVING count(*)>=100"),
        "q08_monthly": _inc(monthly, "GROUP BY opened_month"),
        "q09_breach_concentration": _inc({
            "priority": "priority", "reassignment_bucket": "reassignment_bucket", "incident_count": "count(*)",
            "sla_breached_incidents": _BREACHED, "sla_breach_rate_pct": _pct2(_BREACHED),
            "share_of_all_breaches_pct": _pct2(_BREACHED, f"CAST(sum({_BREACHED}) OVER () AS BIGINT)")},
            "GROUP BY priority, reassignment_bucket HAVING count(*)>=50"),
        "dash_priority_sla": _inc(without(by_level, "sla_met_incidents", "sla_breached_incidents"), "GROUP BY 1"),
        "dash_reassignment_sla": _inc(by_bucket, "GROUP BY 1"),
        "dash_monthly": _inc(without(monthly, "sla_breached_incidents"), "GROUP BY opened_month"),
        "dash_highest_priority_risk": _inc(
            without(by_level, "sla_met_incidents", "sla_breached_incidents"),
            "GROUP BY 1 ORDER BY sla_breach_rate_pct DESC, CASE priority_level WHEN 'Critical' THEN 1"
            " WHEN 'High' THEN 2 WHEN 'Moderate' THEN 3 WHEN 'Low' THEN 4 ELSE 5 END LIMIT 1"),
        "dash_highest_reassignment_risk": _inc(
            by_bucket, "GROUP BY 1 ORDER BY sla_breach_rate_pct DESC, reassignment_level LIMIT 1"),
        "sla_monthly": _INCIDENTS + _MON + _all("mon", {
            **_pick("opened_month", "incident_count", "sla_breaches", "breach_rate", "median_resolution_hours",
                    "p90_resolution_hours", "reassignment_rate", "mean_reassignment_count"),
            "comparison_eligible": "eligible_for_comparison"}),
        "sla_category": table(_CAT, "cat", category_columns),
        "sla_priority": table(_PRI, "pri", priority_columns),
        "sla_reassignment": table(_BKT, "bkt", ["reassignment_bucket", *_MEASURES, "mean_reassignment_count",
                                                "breach_rate", "sla_compliance", *_CI]),
        "reassignment_resolution": table(_BKT, "bkt", [
            "reassignment_bucket", "incident_count", "resolved_incidents", "missing_resolution",
            "median_resolution_hours", "p90_resolution_hours", "mean_resolution_hours", "resolution_coverage"]),
        "sla_assignment_group": table(_GRP, "grp", group_columns),
        "category_top10_rate": top(_CAT, "cat", "category", rate_list, "breach_rate"),
        "category_top10_breaches": top(_CAT, "cat", "category", breach_list, "sla_breaches"),
        "category_top10_median": top(_CAT, "cat", "category", [
            "incident_count", "median_resolution_hours", "p90_resolution_hours"], "median_resolution_hours"),
        "group_top10_rate": top(_GRP, "grp", "assignment_group", rate_list, "breach_rate"),
        "group_top10_breaches": top(_GRP, "grp", "assignment_group", breach_list, "sla_breaches"),
        "group_top10_median": top(_GRP, "grp", "assignment_group", [
            "incident_count", "median_resolution_hours", "p90_resolution_hours", "resolution_coverage"],
            "median_resolution_hours"),
        "segment_counts_category": _INCIDENTS + _CAT + _all("cat", {
            "segments": "count(*)", "eligible_segments": "count(*) FILTER (WHERE eligible_for_comparison)"}),
        "segment_counts_group": _INCIDENTS + _GRP + _all("grp", {
            "segments": "count(*)", "eligible_segments": "count(*) FILTER (WHERE eligible_for_comparison)"}),
        "missing_group_share": _inc({
            "missing_assignment_groups": "count(*) FILTER (WHERE assignment_group IS NULL)",
            "missing_assignment_group_pct": kpi_rate("count(*) FILTER (WHERE assignment_group IS NULL)")}),
        "bottlenecks": table(_BOT, "bot", ["assignment_group", *figures, "volume_class", "breach_risk_class",
                                           "bottleneck_class", "volume_threshold", "breach_rate_threshold"]),
        "volume_class": table(_BOT, "bot", ["assignment_group", "volume_class", "breach_risk_class", "bottleneck_class"]),
        "scalar_broadcast": table(_BOT, "thr", ["volume_threshold", "breach_rate_threshold"]),
        "drivers": table(_BOT, "drv", ["assignment_group", "bottleneck_class", "driver_segment", *figures,
                                       "reassignment_rate", "mean_reassignment_count"]),
        "class_lookup_join": table(_BOT, "drv", ["assignment_group", "bottleneck_class"]),
        "driver_segment": table(_BOT, "drv", ["assignment_group", "driver_segment"]),
        "driver_comparison": _INCIDENTS + _BOT + " " + " UNION ALL ".join([
            _compared("Median breach rate (%)", "breach_rate"),
            _compared("Median resolution time (hours)", "median_resolution_hours"),
            _compared("Median P90 resolution time (hours)", "p90_resolution_hours"),
            _compared("Median reassignment rate (%)", "reassignment_rate"),
            _compared("Median mean reassignment count", "mean_reassignment_count")]),
        "bottleneck_class_counts": _INCIDENTS + _BOT +
            " SELECT c.label AS bottleneck_class, count(bot.assignment_group) AS groups FROM (VALUES"
            " ('Critical Bottleneck'),('Volume Bottleneck'),('SLA Risk'),('Lower Priority')) c(label)"
            " LEFT JOIN bot ON bot.bottleneck_class=c.label GROUP BY c.label",
        "critical_bottleneck_list": class_list("Critical Bottleneck"),
        "sla_risk_list": class_list("SLA Risk"),
        "driver_segment_counts": _INCIDENTS + _BOT + _all(
            "drv", {"driver_segment": "driver_segment", "groups": "count(*)"}, "GROUP BY driver_segment"),
        "risk_reference": table(_REF, "ref", reference_columns),
        "union_all": table(_REF, "ref", reference_columns),
        "factor_lookup_join": scored(*_RATES),
        "risk_scores": table(_SCORES, "sco", score_columns),
        "risk_score_mean": _INCIDENTS + _SCORES + _all(
            "sco", {"mean_sla_risk_score": _six("avg(sla_risk_score)")}),
        "risk_portfolio": table(_PORTFOLIO, "por", [
            "sla_risk_band", "incident_count", "incident_share_pct", *_STATS, "mean_risk_factor_count"]),
        "risk_concentration": table(_CONCENTRATION, "con", _CON_COLUMNS),
        "concentration_top15": table(
            _CONCENTRATION, "con", _CON_COLUMNS,
            "ORDER BY con.elevated_risk_share_pct DESC, elevated_risk_incident_count DESC, dimension,"
            " dimension_value LIMIT 15"),
        "value_counts": _INCIDENTS + " " + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS incidents FROM inc GROUP BY {c}"
            for c in ["made_sla", "sla_breached", "reassignment_bucket", "reopened"]),
        **_check_texts(),
    }
