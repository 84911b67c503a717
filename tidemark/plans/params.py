"""Parameters of the registered queries on the given tables.

The anchor and the majors are suppliers of the derived rates relation; ``AS_OF`` is its
last date at every scale. Load-time queries run on events, whose last day is 2024-01-30.
"""

import datetime as dt

ANCHOR = "AAA"
MAJORS = ("AAA", "AAB", "AAC")
MAJOR_LABELS = {"AAA": "series_a", "AAB": "series_b", "AAC": "series_c"}
AS_OF = dt.date(2001, 11, 4)
EVENTS_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
ANOMALY_UPPER = 100000.0
PERIOD_START = dt.date(2001, 6, 1)
PERIOD_END = dt.date(2001, 8, 1)
BROKEN_DAY = dt.date(2001, 6, 4)           # a Monday of the period whose landed files include a broken one
WEEK_AS_OF = dt.date(2001, 10, 16)         # end of a week in which the anchor has rows at every scale
LOAD_START = dt.date(2001, 8, 1)           # first day of the load that the incremental marts follow
CHECK_DATE = dt.date(2001, 10, 31)        # the yesterday of the daily run; a day on which the majors have rows at every scale
UPSERT_AS_OF = dt.datetime(2001, 11, 5, 0, 0, 0)
DIM_INIT_DATE = dt.date(2000, 1, 1)
SAMPLE_ROWS = 10
