"""Schemas and fixed values shared by every operator.

Schemas are always given to the reader. Inference would turn ``opened_month``
into a timestamp and a bucket column that only holds ``0`` into an integer.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()
_TIME = T.TimestampNTZType()
_HOURS = T.DoubleType()
_FLAG = T.BooleanType()
_COUNT = T.IntegerType()

# Name, order and type of the incident columns.
INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("number", _TEXT),
        T.StructField("opened_at", _TIME),
        T.StructField("resolved_at", _TIME),
        T.StructField("closed_at", _TIME),
        T.StructField("resolution_time_hours", _HOURS),
        T.StructField("closure_time_hours", _HOURS),
        T.StructField("made_sla", _FLAG),
        T.StructField("sla_breached", _FLAG),
        T.StructField("reassignment_count", _COUNT),
        T.StructField("reassignment_bucket", _TEXT),
        T.StructField("reopen_count", _COUNT),
        T.StructField("reopened", _FLAG),
        T.StructField("sys_mod_count", _COUNT),
        T.StructField("incident_state", _TEXT),
        T.StructField("active", _FLAG),
        T.StructField("category", _TEXT),
        T.StructField("subcategory", _TEXT),
        T.StructField("priority", _TEXT),
        T.StructField("impact", _TEXT),
        T.StructField("urgency", _TEXT),
        T.StructField("assignment_group", _TEXT),
        T.StructField("assigned_to", _TEXT),
        T.StructField("caller_id", _TEXT),
        T.StructField("contact_type", _TEXT),
        T.StructField("location", _TEXT),
        T.StructField("opened_date", T.DateType()),
        T.StructField("opened_month", _TEXT),
        T.StructField("opened_year", _COUNT),
        T.StructField("opened_by", _TEXT),
        T.StructField("sys_created_by", _TEXT),
        T.StructField("sys_created_at", _TIME),
        T.StructField("sys_updated_by", _TEXT),
        T.StructField("sys_updated_at", _TIME),
        T.StructField("u_symptom", _TEXT),
        T.StructField("cmdb_ci", _TEXT),
        T.StructField("knowledge", _FLAG),
        T.StructField("u_priority_confirmation", _FLAG),
        T.StructField("notify", _TEXT),
        T.StructField("problem_id", _TEXT),
        T.StructField("rfc", _TEXT),
        T.StructField("vendor", _TEXT),
        T.StructField("caused_by", _TEXT),
        T.StructField("closed_code", _TEXT),
        T.StructField("resolved_by", _TEXT),
    ]
)
INCIDENT_COLUMNS = INCIDENT_SCHEMA.names

# Columns that only exist once the log has been collapsed.
DERIVED_COLUMNS = [
    "resolution_time_hours",
    "closure_time_hours",
    "sla_breached",
    "reassignment_bucket",
    "reopened",
    "opened_date",
    "opened_month",
    "opened_year",
]
RAW_COLUMNS = [name for name in INCIDENT_COLUMNS if name not in DERIVED_COLUMNS]
RAW_SCHEMA = T.StructType([T.StructField(name, _TEXT) for name in RAW_COLUMNS])

EVENT_TIMES = ["opened_at", "sys_updated_at", "resolved_at", "closed_at"]
EVENT_FLAGS = ["made_sla", "active"]
EVENT_COUNTERS = ["reassignment_count", "reopen_count", "sys_mod_count"]

# Texts that stand for "no value" in the raw log.
NULL_TOKENS = [
    "?", "", "NA", "N/A", "n/a", "NaN", "nan", "-NaN", "-nan", "NULL", "null",
    "None", "<NA>", "#N/A", "#N/A N/A", "#NA", "1.#IND", "-1.#IND", "1.#QNAN",
    "-1.#QNAN",
]

# Accepted spellings of a flag.
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]

# Display order and labels.
PRIORITY_LEVELS = {
    "1 - Critical": "Critical",
    "2 - High": "High",
    "3 - Moderate": "Moderate",
    "4 - Low": "Low",
}
# Limits of the reassignment buckets, both inclusive.
BUCKET_LIMITS = {"0": (0, 0), "1-2": (1, 2), "3-5": (3, 5), "6+": (6, None)}
BUCKETS = list(BUCKET_LIMITS)
RISK_BANDS = ["Low", "Moderate", "High", "Critical"]
BOTTLENECK_CLASSES = ["Critical Bottleneck", "Volume Bottleneck", "SLA Risk", "Lower Priority"]
UNKNOWN = "Unknown"

# Thresholds of the published analysis, all overridable.
MIN_SEGMENT_SAMPLE = 100
MIN_PAIR_SAMPLE = 50
WILSON_Z = 1.96
RISK_BASELINE_RATE = 36.58
RISK_SCORE_MAX = 100.0
RISK_BAND_EDGES = [25.0, 50.0, 75.0]

# The four risk factors: incident column, label, prefix of its score columns.
# The score adds them in this order, so the sum is reproducible to the last bit.
RISK_FACTORS = [
    ("priority", "Priority", "priority"),
    ("reassignment_bucket", "Reassignment Bucket", "reassignment"),
    ("category", "Category", "category"),
    ("assignment_group", "Assignment Group", "assignment_group"),
]
FACTOR_COLUMNS = [column for column, _, _ in RISK_FACTORS]
# Factors whose small segments are not trusted for scoring.
SAMPLED_FACTORS = ["Category", "Assignment Group"]
