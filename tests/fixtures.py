"""Hand-written inputs for the cases the order tables do not contain."""

import csv
from datetime import datetime

from breachscope import schema as S

# number, sys_updated_at, opened_at, resolved_at, made_sla, reassignment_count
EVENTS = [
    ("I1", "29/2/2016 01:16", "29/2/2016 01:16", "?", "true", "0"),
    ("I1", "29/02/2016 11:29", "?", "29/2/2016 11:29", "FALSE", "3"),
    ("I2", "1/3/2016 08:00", "1/3/2016 08:00", "?", "yes", "6"),
    ("I2", "1/3/2016 09:00", "1/3/2016 08:00", "?", "no", "2"),
    ("I3", "2/3/2016 10:00", "2/3/2016 09:00", "?", "1", "0"),
    ("I3", "2/3/2016 10:00", "2/3/2016 09:00", "?", "0", "0"),
    ("I4", "?", "3/3/2016 09:00", "?", "true", "1"),
    ("I4", "3/3/2016 10:00", "3/3/2016 09:00", "?", "false", "2"),
    ("I5", "4/3/2016 10:00", "4/3/2016 09:00", "?", "NA", "NA"),
    ("I6", "5/3/2016 10:00", "5/3/2016 09:00", "not a date", "true", "1"),
    ("I7", "6/3/2016 10:00", "6/3/2016 09:00", "5/3/2016 09:00", "true", "-1"),
    ("?", "7/3/2016 10:00", "7/3/2016 09:00", "?", "true", "0"),
]
_NAMES = ["number", "sys_updated_at", "opened_at", "resolved_at", "made_sla", "reassignment_count"]


def write_log(path, events=EVENTS, names=S.RAW_COLUMNS):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(names)
        for event in events:
            row = dict(zip(_NAMES, event))
            writer.writerow([row.get(name, "?") for name in names])
    return str(path)


def incidents(spark, rows):
    """Incidents from dicts; unnamed columns are null."""
    return spark.createDataFrame(
        [tuple(row.get(name) for name in S.INCIDENT_COLUMNS) for row in rows], S.INCIDENT_SCHEMA
    )


def sample_rows(n=1200):
    """Enough incidents for eligible segments in every dimension, with unknowns."""
    priorities = [*S.PRIORITY_LEVELS, None]
    rows = []
    for i in range(n):
        moves = (i * 7) % 9
        breached = (i * i) % 7 < 2 + (i % 5)
        hours = float((i * 37) % 401) / 4 if i % 11 else None
        rows.append(
            {
                "number": f"N{i:06d}",
                "opened_at": datetime(2016, 1 + i % 6, 1),
                "resolved_at": datetime(2016, 12, 1) if hours is not None else None,
                "resolution_time_hours": hours,
                "made_sla": not breached,
                "sla_breached": breached,
                "reassignment_count": moves,
                "reassignment_bucket": "0" if moves == 0 else "1-2" if moves < 3 else "3-5" if moves < 6 else "6+",
                "reopened": i % 13 == 0,
                "reopen_count": int(i % 13 == 0),
                "category": f"C{i % 4}" if i % 17 else None,
                "priority": priorities[i % 5],
                # The first group holds a third of everything.
                "assignment_group": "G0" if i % 3 == 0 else f"G{i % 7}" if i % 19 else None,
                "opened_month": f"2016-{1 + i % 6:02d}",
                "opened_year": 2016,
            }
        )
    return rows
