"""Fixed parameters of the registered queries (shared by the Spark forms in
`catalog` and their SQL twins in `oracle`)."""

from __future__ import annotations

import datetime as dt

TREND_PARTICIPANT = "P0001"
TREND_TYPE = "glucose"
BMI_STUDY = "STUDY001"
RECENT_DAYS = 7
RECENT_AS_OF = dt.date(2024, 1, 31)
READ_FILTERS = {"study_id": "STUDY001", "measurement_type": "glucose",
                "start_date": "2024-01-10", "end_date": "2024-01-20"}
STUDY_READ = "STUDY002"
# The two loads of the merge checks: morning readings, then the rest.
AM_SPLIT_HOUR = 12
# Dimension check: the first day is the stored load, later days are incoming.
FIRST_LOAD_END = "2024-01-02"
LOOKUP_JOB = "STUDY001_2024-01-15_am"
STREAM_LATENESS = "1 day"
# When the two registered loads take place.
LOAD_INSTANT = dt.datetime(2024, 3, 1, 12)
