"""One registered query per operator, on the incidents of the order tables.

Reports that read their input once run straight off the collapse. Those that
need several passes over the incidents store the columns they use first
(``settled``), as a full run does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from breachscope import schema as S
from breachscope.functions import expressions as E
from breachscope.operators import bottlenecks as B
from breachscope.operators import checks as C
from breachscope.operators import cleaning as L
from breachscope.operators import kpis as K
from breachscope.operators import risk as R
from breachscope.operators import segments as G
from breachscope.operators import sql_reports as Q
from breachscope.plans import faults
from breachscope.session import settle, work_path
from breachscope.sources import incidents as I
from breachscope.sources import mapping as M
from breachscope.sources.csv_format import STORED_OPTIONS
from breachscope.sources.events import read_event_log
from breachscope.sources.reports import write_report

Query = Callable[[SparkSession, str], DataFrame]

_HOURS = "resolution_time_hours"
_SLA = ["sla_breached", _HOURS, "reassignment_count"]
_GROUP = [*_SLA, "resolved_at", "assignment_group"]
_FACTORS = [*S.FACTOR_COLUMNS, "sla_breached"]
_ONCE = {"unique_numbers": True}


def shown(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that engines can be compared."""
    return df.select(
        *[
            F.round(F.col(f.name), 6).alias(f.name) if f.dataType.typeName() == "double" else f.name
            for f in df.schema
        ]
    )


def _on(columns: list[str], report: Callable[[DataFrame], DataFrame], settled=False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(report(M.incidents(spark, sf_dir, columns, settled)))

    return run


def _columns(*names: str, inputs: list[str] | None = None, **computed) -> Query:
    """Row-level query: the incident number, stored columns and expressions.

    Expressions are built when the query runs; before that there may be no session.
    """
    needed = list(names) + (inputs or [])
    return _on(
        needed,
        lambda i: i.select("number", *names, *[make().alias(n) for n, make in computed.items()]),
    )


def _events(pick: Callable[[DataFrame], DataFrame], *names: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return pick(L.null_tokens(M.raw_event_log(spark, sf_dir))).select("number", *names)

    return run


def _last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = M.event_log(spark, sf_dir)
    last = events.groupBy("number").agg(F.max(L.event_order(events)).alias("_last"))
    return last.select(
        "number", "_last.sys_updated_at", F.col(f"_last.{L.ROW_ORDER}.l_linenumber").alias("line")
    )


# ------------------------------------------------------------- shared pieces


def _groups(incidents: DataFrame, percentiles: bool = True) -> DataFrame:
    return G.sla_assignment_group(incidents, **_ONCE, percentiles=percentiles)


def _categories(incidents: DataFrame, percentiles: bool = True) -> DataFrame:
    return G.sla_category(incidents, **_ONCE, percentiles=percentiles)


def _on_groups(report: Callable[[DataFrame], DataFrame]) -> Query:
    """On the assignment-group table, stored because its readers take several passes."""
    return _on(_GROUP, lambda i: report(settle(_groups(i))), settled=True)


def _classified(groups: DataFrame) -> DataFrame:
    return B.bottlenecks(groups)


def _driver_table(groups: DataFrame) -> DataFrame:
    return B.drivers(groups, _classified(groups))


def _on_scores(report: Callable[[DataFrame], DataFrame]) -> Query:
    """On the scores of all incidents."""

    def run(incidents: DataFrame) -> DataFrame:
        reference = settle(R.reference_from_profile(R.factor_profile(incidents)))
        return report(R.risk_scores(incidents, reference))

    return _on(_FACTORS, run, settled=True)


def _on_profile(report: Callable[[DataFrame], DataFrame]) -> Query:
    """On the scores of factor combinations: incidents are read once."""

    def run(incidents: DataFrame) -> DataFrame:
        profile = settle(R.factor_profile(incidents))
        reference = settle(R.reference_from_profile(profile))
        return report(R.profile_scores(profile, reference))

    return _on(_FACTORS, run)


def _portfolio(scores: DataFrame) -> DataFrame:
    return R.risk_portfolio(settle(scores), weight="incident_count")


def _concentration(scores: DataFrame) -> DataFrame:
    return R.risk_concentration(settle(scores), weight="incident_count")


def _positions(
    report: Callable[[DataFrame], DataFrame], keys: int = 1
) -> Callable[[DataFrame], DataFrame]:
    """The place of each row in the order that the report shows its groups in; the first
    ``keys`` columns name a group."""

    def number(incidents: DataFrame) -> DataFrame:
        rows = report(incidents)
        names = rows.columns[:keys]
        # Ids grow along the partitions of a sorted frame. There is a row a group.
        placed = rows.select(*names, F.monotonically_increasing_id().alias("_place"))
        return placed.select(*names, F.row_number().over(Window.orderBy("_place")).alias("position"))

    return number


def _segment_tables(incidents: DataFrame) -> dict[str, DataFrame]:
    return {
        "category": settle(_categories(incidents, False)),
        "priority": settle(G.sla_priority(incidents, **_ONCE, percentiles=False)),
        "reassignment": settle(G.sla_reassignment(incidents, **_ONCE, percentiles=False)),
        "group": settle(_groups(incidents, False)),
    }


_ALL = [*_GROUP, *S.FACTOR_COLUMNS]


def _merged_reference(incidents: DataFrame) -> DataFrame:
    return R.risk_reference(**_segment_tables(incidents))


# -------------------------------------------------------------------- sources


def _csv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark)
    M.raw_event_log(spark, sf_dir).drop(L.ROW_ORDER).write.options(**STORED_OPTIONS).csv(path)
    log = read_event_log(spark, path)
    return L.type_events(log).select(
        "number", *S.EVENT_TIMES, *S.EVENT_FLAGS, *S.EVENT_COUNTERS, *S.FACTOR_COLUMNS[:1],
        "category", "assignment_group", "location",
    )


def _several_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as several files in two column orders, with free text in a column, read
    and collapsed. The text of a first event is that of a document.

    Events are shuffled without the texts, to the documents: the joined rows, which hold
    a text for each incident, are sorted and written where they are made."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    count = documents.agg(F.count("*").alias("n")).scalar()
    order = F.substring("number", 4, 20).cast("bigint")
    first = F.col(f"{L.ROW_ORDER}.l_linenumber") == 1
    texts = documents.select(F.col("doc_id").alias("_of"), F.col("text").alias("u_symptom"))
    path = work_path(spark)
    even = F.pmod(order, F.lit(2)) == 0
    names = S.RAW_COLUMNS
    for half, columns in ((even, names), (~even, [*reversed(names)])):
        events = M.event_log(spark, sf_dir).where(half).withColumn("_doc", F.pmod(order, count))
        # Told to partition by document, Spark does not split a partition for its size: all
        # events of an incident come into one file.
        log = events.repartition("_doc").join(texts, (F.col("_doc") == F.col("_of")) & first, "left")
        log = M.as_texts(log.sortWithinPartitions("_doc", L.ROW_ORDER))
        log.select(columns).write.mode("append").options(**STORED_OPTIONS).csv(path)
    collapsed = L.clean_incidents(
        read_event_log(spark, path), ["sys_updated_at", "made_sla", "reassignment_count", "u_symptom"]
    )
    return collapsed.select("number", "sys_updated_at", "made_sla", "reassignment_count", "u_symptom")


def _document_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incident table that holds the documents as free text."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {"number": F.concat(F.lit("DOC"), F.col("doc_id").cast("string")), "u_symptom": F.col("text")}
    return documents.select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.INCIDENT_SCHEMA
        ]
    )


def _loaded_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv_path, table_path = work_path(spark), work_path(spark)
    rows = I.write_incidents(_document_incidents(spark, sf_dir), csv_path, "csv")
    I.load_incidents_table(spark, csv_path, table_path, expected_rows=rows)
    return I.read_incidents(spark, table_path).select("number", "u_symptom")


def _report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _document_incidents(spark, sf_dir).select("number", "u_symptom")
    return write_report(table, work_path(spark), "priority_sla_performance", "csv")


_ROUND_TRIP = [
    "opened_at", "resolved_at", "closed_at", _HOURS, "closure_time_hours", "made_sla",
    "sla_breached", "reassignment_count", "reassignment_bucket", "reopen_count", "reopened",
    "category", "priority", "assignment_group", "opened_date", "opened_month", "opened_year",
]


def _full_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with all fixed columns, those the log lacks as nulls."""
    incidents = M.incidents(spark, sf_dir)
    return incidents.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in incidents.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in S.INCIDENT_SCHEMA
        ]
    )


def _stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark)
    I.write_incidents(_full_width(spark, sf_dir), path, partition_by=("opened_year",))
    return shown(I.read_incidents(spark, path, ordered=True).select("number", *_ROUND_TRIP))


def _loaded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv_path, table_path = work_path(spark), work_path(spark)
    rows = I.write_incidents(_full_width(spark, sf_dir), csv_path, "csv")
    I.load_incidents_table(spark, csv_path, table_path, expected_rows=rows)
    return shown(I.read_incidents(spark, table_path).select("number", *_ROUND_TRIP))


def _loaded_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark)
    I.write_incidents(_full_width(spark, sf_dir), path, "csv")
    return shown(I.read_incidents_csv(spark, path).select("number", *_ROUND_TRIP))


def _load_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv_path, table_path = work_path(spark), work_path(spark)
    I.write_incidents(_full_width(spark, sf_dir), csv_path, "csv")
    header = I.check_header(spark, csv_path)
    I.load_incidents_table(spark, csv_path, table_path)
    return _verdict(
        C.v14_load(I.read_incidents(spark, table_path), header, _expected(spark, sf_dir))
    )


def _report_round_trip(incidents: DataFrame) -> DataFrame:
    spark = incidents.sparkSession
    table = G.sla_priority(incidents, **_ONCE)
    return write_report(table, work_path(spark), "priority_sla_performance", "csv")


# --------------------------------------------------------------------- checks


def _expected(spark: SparkSession, sf_dir: str):
    """Orders that have lines: what the number of incidents must be."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.agg(F.count_distinct("l_orderkey").alias("n")).scalar()


def _verdict(checks: DataFrame) -> DataFrame:
    return checks.select("check_name", "severity", "violations")


def _check(columns: list[str], report: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(columns, lambda i: _verdict(report(i)), settled=True)


def _check_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["opened_at", "resolved_at", _HOURS, "closure_time_hours"]
    incidents = M.incidents(spark, sf_dir, columns)
    return _verdict(C.v01_incidents(incidents, _expected(spark, sf_dir)))


def _order(frame: DataFrame) -> Column:
    return F.substring("number", 4, 20).cast("bigint") % 50


def _planted(incidents: DataFrame, number: bool = False) -> DataFrame:
    """Incidents with faults at known orders: repeated rows, and missing openings and
    negative hours, or missing numbers."""
    last = _order(incidents)
    if number:
        changed = {"number": F.when(last != 5, F.col("number"))}
    else:
        changed = {
            "opened_at": F.when(last != 1, F.col("opened_at")),
            _HOURS: F.when(last == 2, -1.0).otherwise(F.col(_HOURS)),
            "closure_time_hours": F.when(last == 3, -1.0).otherwise(F.col("closure_time_hours")),
        }
    return incidents.withColumns(changed).unionByName(incidents.where(last == 0))


def _faulty_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["opened_at", "resolved_at", _HOURS, "closure_time_hours"]
    faulty = settle(_planted(M.incidents(spark, sf_dir, columns, True)))
    return _verdict(C.v01_incidents(faulty, _expected(spark, sf_dir)))


def _faulty_buckets(incidents: DataFrame) -> DataFrame:
    bucket = F.when(_order(incidents) == 4, "6+").otherwise(F.col("reassignment_bucket"))
    faulty = incidents.withColumn("reassignment_bucket", bucket)
    checks = C.v11_reassignment(settle(G.sla_reassignment(faulty, **_ONCE)), faulty)
    return _verdict(checks).where("check_name = 'bucket_definition'")


def _faulty_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    faulty = settle(_planted(_full_width(spark, sf_dir), number=True)).withColumn(
        "active", F.col("active").cast("string")
    )
    swapped = [S.INCIDENT_COLUMNS[1], S.INCIDENT_COLUMNS[0], *S.INCIDENT_COLUMNS[2:]]
    return _verdict(C.v14_load(faulty, swapped, _expected(spark, sf_dir)))


def _guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each kind of unusable input is refused, and sound input is not."""
    incidents = M.incidents(spark, sf_dir, _ALL, True)
    reference = settle(R.reference_from_profile(R.factor_profile(incidents)))
    scores = R.risk_scores(incidents, reference)
    groups = settle(_groups(incidents, False))
    rate = lambda value: reference.withColumn("breach_rate", value)
    path = work_path(spark)
    for names in (S.RAW_COLUMNS, S.RAW_COLUMNS[::-1]):
        log = M.raw_event_log(spark, sf_dir).select(names)
        log.write.mode("append").options(**STORED_OPTIONS).csv(path)
    cases = {
        "sound input": lambda: R.risk_portfolio(scores, strict=True),
        "missing column": lambda: G.sla_category(incidents.drop("category")),
        "empty reference": lambda: R.risk_scores(incidents, reference.limit(0)),
        "repeated factor": lambda: R.risk_scores(incidents, reference.unionAll(reference)),
        "missing rate": lambda: R.risk_scores(incidents, rate(F.lit(None).cast("double"))),
        "rate beyond 100": lambda: R.risk_scores(incidents, rate(F.col("breach_rate") + 101)),
        "baseline of 100": lambda: R.risk_scores(incidents, reference, 100.0),
        "no scores": lambda: R.risk_portfolio(scores.limit(0), strict=True),
        "no eligible group": lambda: B.bottlenecks(
            groups.withColumn("eligible_for_comparison", F.lit(False)), strict=True
        ),
        "no row order": lambda: L.collapse_events(M.event_log(spark, sf_dir).drop(L.ROW_ORDER)),
        "several headers": lambda: I.check_header(spark, path),
    }
    raised = []
    for name, build in cases.items():
        try:
            build()
            raised.append((name, False))
        except ValueError:
            raised.append((name, True))
    made = spark.createDataFrame(raised, "case_name string, error_raised boolean")
    return made.withColumn("incidents", incidents.agg(F.count("*").alias("n")).scalar())


def _check_scores(incidents: DataFrame) -> DataFrame:
    reference = settle(R.reference_from_profile(R.factor_profile(incidents)))
    scores = settle(R.risk_scores(incidents, reference))
    return C.v02_risk_scores(scores, incidents, reference)


def _check_profile(report: Callable[[DataFrame], DataFrame]) -> Query:
    query = _on_profile(lambda scores: report(settle(scores)))
    return lambda spark, sf_dir: _verdict(query(spark, sf_dir))


def _check_groups(report: Callable[[DataFrame], DataFrame]) -> Query:
    query = _on_groups(report)
    return lambda spark, sf_dir: _verdict(query(spark, sf_dir))


def _check_reference(incidents: DataFrame) -> DataFrame:
    tables = _segment_tables(incidents)
    return C.v08_risk_reference(settle(R.risk_reference(**tables)), **tables)


def _check_concentration(scores: DataFrame) -> DataFrame:
    return C.v04_concentration(
        settle(R.risk_concentration(scores, weight="incident_count")), scores
    )


def _check_portfolio(scores: DataFrame) -> DataFrame:
    portfolio = settle(R.risk_portfolio(scores, weight="incident_count"))
    return C.v03_portfolio(portfolio, scores, weight="incident_count")


def _fault_queries() -> dict[str, Query]:
    """The checks on frames with faults (``faults.FAULTS``); what a frame is checked
    against stays sound."""

    def on(columns: list[str], check: str, table: Callable[[DataFrame], DataFrame], verify) -> Query:
        def report(incidents: DataFrame) -> DataFrame:
            return verify(settle(faults.planted(table(incidents), check)), incidents)

        return _check(columns, report)

    def scores(incidents: DataFrame) -> DataFrame:
        reference = settle(R.reference_from_profile(R.factor_profile(incidents)))
        faulty = settle(faults.planted(settle(R.risk_scores(incidents, reference)), "v02_risk_scores"))
        return C.v02_risk_scores(faulty, incidents, reference)

    def reference(incidents: DataFrame) -> DataFrame:
        tables = _segment_tables(incidents)
        faulty = settle(faults.planted(settle(R.risk_reference(**tables)), "v08_risk_reference"))
        return C.v08_risk_reference(faulty, **tables)

    def portfolio(scores: DataFrame) -> DataFrame:
        table = settle(R.risk_portfolio(scores, weight="incident_count"))
        faulty = settle(faults.planted(table, "v03_portfolio"))
        return C.v03_portfolio(faulty, scores, weight="incident_count")

    def concentration(scores: DataFrame) -> DataFrame:
        table = settle(R.risk_concentration(scores, weight="incident_count"))
        return C.v04_concentration(settle(faults.planted(table, "v04_concentration")), scores)

    def drivers(groups: DataFrame) -> DataFrame:
        faulty = settle(faults.planted(settle(_driver_table(groups)), "v06_drivers"))
        return C.v06_drivers(faulty, groups, settle(_classified(groups)))

    def bottlenecks(groups: DataFrame) -> DataFrame:
        faulty = settle(faults.planted(settle(_classified(groups)), "v07_bottlenecks"))
        return C.v07_bottlenecks(faulty, groups)

    return {
        "v02_faults": _check(_FACTORS, scores),
        "v03_faults": _check_profile(portfolio),
        "v04_faults": _check_profile(concentration),
        "v05_faults": on(
            [*_SLA, "opened_month"], "v05_monthly", lambda i: G.sla_monthly(i, **_ONCE), C.v05_monthly
        ),
        "v06_faults": _check_groups(drivers),
        "v07_faults": _check_groups(bottlenecks),
        "v08_faults": _check(_ALL, reference),
        "v09_faults": on([*_SLA, "category"], "v09_category", _categories, C.v09_category),
        "v10_faults": on(
            [*_SLA, "priority"], "v10_priority", lambda i: G.sla_priority(i, **_ONCE), C.v10_priority
        ),
        "v12_faults": on(
            [_HOURS, "resolved_at", "reassignment_bucket"],
            "v12_reassignment_resolution",
            lambda i: G.reassignment_resolution(i, **_ONCE),
            C.v12_reassignment_resolution,
        ),
        "v13_faults": on(_GROUP, "v13_assignment_group", _groups, C.v13_assignment_group),
    }


# ---------------------------------------------------------- small expressions


def _factor_part(*names: str) -> Query:
    return _on_scores(lambda s: s.select("number", *names))


def _counted_by_year(incidents: DataFrame) -> DataFrame:
    total = F.count("*")
    return incidents.groupBy("opened_year").agg(
        total.alias("incidents"),
        E.percent_2dp(F.count_if("sla_breached"), total).alias("breach_rate_pct"),
        E.percent(F.count_if("sla_breached"), total).alias("breach_rate"),
    )


def _filter_counts(incidents: DataFrame) -> DataFrame:
    return incidents.agg(
        F.count_if("made_sla").alias("met"),
        F.count_if(F.col("reassignment_count") > 0).alias("reassigned"),
        F.count_if(F.col("category") == "Category 0").alias("in_category"),
    )


def _null_counts(incidents: DataFrame) -> DataFrame:
    return incidents.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in ["category", "priority"]],
        F.count("resolved_at").alias("resolved_known"),
        F.count_if(F.col("resolved_at").isNotNull() & F.col("closed_at").isNotNull()).alias(
            "both_known"
        ),
    )


def _category_counts(incidents: DataFrame) -> DataFrame:
    return incidents.where(F.col("category").isNotNull()).groupBy("category").agg(
        F.count("number").alias("incident_count"), F.count_if("sla_breached").alias("sla_breaches")
    )


def _wilson(incidents: DataFrame) -> DataFrame:
    lower, upper = E.wilson_bounds(F.col("sla_breaches"), F.col("incident_count"))
    return _category_counts(incidents).select(
        "category", lower.alias("lower"), upper.alias("upper")
    )


def _eligible(incidents: DataFrame) -> DataFrame:
    return _category_counts(incidents).select(
        "category", (F.col("incident_count") >= S.MIN_SEGMENT_SAMPLE).alias("eligible")
    )


def registry() -> dict[str, Query]:
    status = ["made_sla", "sla_breached"]
    return {
        # sources and sinks
        "read_event_log": _csv_log,
        "several_log_files": _several_files,
        "load_free_text": _loaded_text,
        "report_free_text": _report_text,
        "write_incidents": _stored_table,
        "load_incidents_table": _loaded_table,
        "read_incidents_csv": _loaded_csv,
        "write_reports": _on([*_SLA, "priority"], _report_round_trip, settled=True),
        # cleaning
        "parse_timestamps": _events(L.parse_timestamps, *S.EVENT_TIMES),
        "normalize_boolean": _events(L.normalize_flags, *S.EVENT_FLAGS),
        "coerce_counters": _events(L.coerce_counters, *S.EVENT_COUNTERS),
        "event_order": _last_event,
        "latest_event": _columns(
            "made_sla", "active", "resolved_at", "closed_at", "incident_state", "category",
            "priority", "assignment_group", "caller_id", "resolved_by", "sys_updated_at",
        ),
        "first_opened_at": _columns("opened_at"),
        "cumulative_max": _columns(*S.EVENT_COUNTERS),
        "sla_breached": _columns("sla_breached"),
        "reopened": _columns("reopened"),
        "reassignment_bucket": _columns("reassignment_bucket"),
        "resolution_time_hours": _columns(_HOURS),
        "closure_time_hours": _columns("closure_time_hours"),
        "calendar_dims": _columns("opened_date", "opened_month", "opened_year"),
        "clean_incidents": lambda spark, sf_dir: shown(
            L.clean_incidents(L.null_tokens(M.raw_event_log(spark, sf_dir))).select(
                "number", *_ROUND_TRIP, "active", "sys_mod_count", "incident_state", "caller_id",
                "resolved_by", "sys_updated_at", "location",
            )
        ),
        # expressions
        "priority_level": _columns(
            inputs=["priority"], priority_level=lambda: E.priority_level(F.col("priority"))
        ),
        "priority_rank": _columns(
            inputs=["priority"], priority_rank=lambda: E.priority_rank(F.col("priority"))
        ),
        "reassignment_level": _columns(
            inputs=["reassignment_bucket"],
            reassignment_level=lambda: E.reassignment_level(F.col("reassignment_bucket")),
        ),
        "bucket_rank": _columns(
            inputs=["reassignment_bucket"], bucket_rank=lambda: E.bucket_rank(F.col("reassignment_bucket"))
        ),
        "coalesce_unknown": _columns(
            inputs=["assignment_group"],
            assignment_group_label=lambda: F.coalesce("assignment_group", F.lit(S.UNKNOWN)),
        ),
        "rate_pct": _on(["opened_year", "sla_breached"], _counted_by_year),
        "filter_count": _on(["made_sla", "reassignment_count", "category"], _filter_counts),
        "null_predicates": _on(["category", "priority", "resolved_at", "closed_at"], _null_counts),
        "wilson_interval": _on(["category", "sla_breached"], _wilson),
        "eligible_flag": _on(["category", "sla_breached"], _eligible),
        "closure_lag_hours": _on(
            ["resolved_at", "closed_at"],
            lambda i: K.closure_lag(i).select("number", "closure_lag_hours"),
        ),
        "risk_contribution": _factor_part(*R.CONTRIBUTION_COLUMNS),
        "risk_factor_count": _factor_part("risk_factor_count"),
        "risk_score": _factor_part("sla_risk_score"),
        "risk_band": _factor_part("sla_risk_band"),
        # key figures
        "kpi_overall": _on(
            ["made_sla", "sla_breached", "resolved_at", "reassignment_count", "reopened"],
            K.kpi_overall,
        ),
        "kpi_resolution": _on([_HOURS], K.kpi_resolution, settled=True),
        "kpi_closure": _on(
            ["closure_time_hours", "resolved_at", "closed_at"], K.kpi_closure, settled=True
        ),
        "kpi_reassignment": _on(["reassignment_count"], K.kpi_reassignment, settled=True),
        "kpi_reopen": _on(["reopen_count"], K.kpi_reopen, settled=True),
        "kpi_monthly": _on([*status, "opened_month", _HOURS], K.kpi_monthly, settled=True),
        "kpi_category": _on([*_SLA, "category", "reopened"], K.kpi_category, settled=True),
        "kpi_assignment_group": _on(
            [*_SLA, "assignment_group"], K.kpi_assignment_group, settled=True
        ),
        "kpi_top10_category": _on(
            [*_SLA, "category", "reopened"],
            lambda i: K.kpi_top10(K.kpi_category(i)),
            settled=True,
        ),
        "kpi_top10_assignment_group": _on(
            [*_SLA, "assignment_group"],
            lambda i: K.kpi_top10(K.kpi_assignment_group(i)),
            settled=True,
        ),
        # operational reports
        "q01_kpi_summary": _on(
            [*status, "resolved_at", "reassignment_count", "reopened"], Q.q01_kpi_summary
        ),
        "q02_priority_sla": _on([*status, "priority"], Q.q02_priority_sla),
        "q03_reassignment_sla": _on([*status, "reassignment_bucket"], Q.q03_reassignment_sla),
        "q04_resolution_distribution": _on(
            [_HOURS], Q.q04_resolution_distribution, settled=True
        ),
        "q05_resolution_by_priority": _on(
            [_HOURS, "priority"], Q.q05_resolution_by_priority, settled=True
        ),
        "q06_category_sla": _on([*status, _HOURS, "category"], Q.q06_category_sla),
        "q07_assignment_group": _on(
            [*status, _HOURS, "assignment_group"], Q.q07_assignment_group
        ),
        "q08_monthly": _on([*status, _HOURS, "opened_month"], Q.q08_monthly),
        "q09_breach_concentration": _on(
            [*status, "priority", "reassignment_bucket"], Q.q09_breach_concentration
        ),
        "dash_priority_sla": _on([*status, "priority"], Q.dash_priority_sla),
        "dash_reassignment_sla": _on([*status, "reassignment_bucket"], Q.dash_reassignment_sla),
        "dash_monthly": _on([*status, _HOURS, "opened_month"], Q.dash_monthly),
        "dash_highest_priority_risk": _on([*status, "priority"], Q.dash_highest_priority_risk),
        "dash_highest_reassignment_risk": _on(
            [*status, "reassignment_bucket"], Q.dash_highest_reassignment_risk
        ),
        # segment tables
        "sla_monthly": _on(
            [*_SLA, "opened_month"], lambda i: G.sla_monthly(i, **_ONCE), settled=True
        ),
        "sla_category": _on([*_SLA, "category"], _categories, settled=True),
        # The general form, which does not rely on one row per incident.
        "sla_priority": _on([*_SLA, "priority"], G.sla_priority, settled=True),
        "sla_reassignment": _on([*_SLA, "reassignment_bucket"], G.sla_reassignment, settled=True),
        "reassignment_resolution": _on(
            [_HOURS, "resolved_at", "reassignment_bucket"],
            lambda i: G.reassignment_resolution(i, **_ONCE),
            settled=True,
        ),
        "sla_assignment_group": _on(_GROUP, _groups, settled=True),
        "category_top10_rate": _on(
            [*_SLA, "category"], lambda i: G.top10_rate(_categories(i, False)), settled=True
        ),
        "category_top10_breaches": _on(
            [*_SLA, "category"], lambda i: G.top10_breaches(_categories(i, False)), settled=True
        ),
        "category_top10_median": _on(
            [*_SLA, "category"], lambda i: G.top10_median(_categories(i)), settled=True
        ),
        "group_top10_rate": _on(_GROUP, lambda i: G.top10_rate(_groups(i, False)), settled=True),
        "group_top10_breaches": _on(_GROUP, lambda i: G.top10_breaches(_groups(i, False)), settled=True),
        "group_top10_median": _on(_GROUP, lambda i: G.top10_median(_groups(i)), settled=True),
        "segment_counts_category": _on(
            [*_SLA, "category"], lambda i: G.segment_totals(_categories(i, False)), settled=True
        ),
        "segment_counts_group": _on(_GROUP, lambda i: G.segment_totals(_groups(i, False)), settled=True),
        "missing_group_share": _on(["assignment_group"], G.missing_group_share),
        "order_category": _on([*_SLA, "category"], _positions(lambda i: _categories(i, False)), settled=True),
        "order_group": _on(_GROUP, _positions(lambda i: _groups(i, False)), settled=True),
        "order_priority": _on(
            [*_SLA, "priority"],
            _positions(lambda i: G.sla_priority(i, **_ONCE, percentiles=False)),
            settled=True,
        ),
        "order_monthly": _on(
            [*_SLA, "opened_month"], _positions(lambda i: G.sla_monthly(i, **_ONCE)), settled=True
        ),
        "order_bottlenecks": _on_groups(_positions(_classified)),
        "order_drivers": _on_groups(_positions(_driver_table)),
        "order_risk_reference": _on(
            _FACTORS, _positions(lambda i: R.reference_from_profile(R.factor_profile(i)), keys=2)
        ),
        # bottlenecks
        "bottlenecks": _on_groups(_classified),
        "volume_class": _on_groups(
            lambda g: _classified(g).select(
                "assignment_group", "volume_class", "breach_risk_class", "bottleneck_class"
            )
        ),
        "scalar_broadcast": _on_groups(lambda g: B.thresholds(g.where("eligible_for_comparison"))),
        "drivers": _on_groups(_driver_table),
        "class_lookup_join": _on_groups(
            lambda g: _driver_table(g).select("assignment_group", "bottleneck_class")
        ),
        "driver_segment": _on_groups(
            lambda g: _driver_table(g).select("assignment_group", "driver_segment")
        ),
        "driver_comparison": _on_groups(lambda g: B.driver_comparison(settle(_driver_table(g)))),
        "bottleneck_class_counts": _on_groups(lambda g: B.class_counts(_classified(g))),
        "critical_bottleneck_list": _on_groups(
            lambda g: B.class_list(_classified(g), "Critical Bottleneck")
        ),
        "sla_risk_list": _on_groups(lambda g: B.class_list(_classified(g), "SLA Risk")),
        "driver_segment_counts": _on_groups(lambda g: B.driver_segment_counts(_driver_table(g))),
        # risk
        "risk_reference": _on(
            _FACTORS, lambda i: R.reference_from_profile(R.factor_profile(i))
        ),
        "union_all": _on(_ALL, _merged_reference, settled=True),
        "factor_lookup_join": _factor_part(*R.RATE_COLUMNS),
        "risk_scores": _on_scores(lambda s: s),
        "risk_score_mean": _on_profile(lambda s: R.risk_score_mean(s, "incident_count")),
        "risk_portfolio": _on_profile(_portfolio),
        "risk_concentration": _on_profile(_concentration),
        "concentration_top15": _on_profile(lambda s: R.concentration_top15(_concentration(s))),
        # checks
        "value_counts": _on([*status, "reassignment_bucket", "reopened"], C.value_distributions),
        "v01_incidents": _check_incidents,
        "v01_faults": _faulty_incidents,
        "v11_faults": _on(
            [*_SLA, "reassignment_bucket"], _faulty_buckets, settled=True
        ),
        "v14_faults": _faulty_load,
        "guards": _guards,
        "v02_risk_scores": _check(_FACTORS, _check_scores),
        "v03_portfolio": _check_profile(_check_portfolio),
        "v04_concentration": _check_profile(_check_concentration),
        "v05_monthly": _check(
            [*_SLA, "opened_month"],
            lambda i: C.v05_monthly(settle(G.sla_monthly(i, **_ONCE)), i),
        ),
        "v06_drivers": _check_groups(
            lambda g: C.v06_drivers(settle(_driver_table(g)), g, settle(_classified(g)))
        ),
        "v07_bottlenecks": _check_groups(lambda g: C.v07_bottlenecks(settle(_classified(g)), g)),
        "v08_risk_reference": _check(_ALL, _check_reference),
        "v09_category": _check(
            [*_SLA, "category"], lambda i: C.v09_category(settle(_categories(i)), i)
        ),
        "v10_priority": _check(
            [*_SLA, "priority"],
            lambda i: C.v10_priority(settle(G.sla_priority(i, **_ONCE)), i),
        ),
        "v11_reassignment": _check(
            [*_SLA, "reassignment_bucket"],
            lambda i: C.v11_reassignment(settle(G.sla_reassignment(i, **_ONCE)), i),
        ),
        "v12_reassignment_resolution": _check(
            [_HOURS, "resolved_at", "reassignment_bucket"],
            lambda i: C.v12_reassignment_resolution(
                settle(G.reassignment_resolution(i, **_ONCE)), i
            ),
        ),
        "v13_assignment_group": _check(
            _GROUP, lambda i: C.v13_assignment_group(settle(_groups(i)), i)
        ),
        "v14_load": _load_check,
        **_fault_queries(),
    }
