import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, driver_memory="8g")
    yield s


D = dt.date


def raw_rows(spark, rows):
    """rows: (code, date, rate[, type[, nominal[, name[, load_ts]]]])"""
    from decimal import Decimal

    from tidemark.schema import RAW_SCHEMA
    out = []
    for r in rows:
        code, day, rate = r[0], r[1], r[2]
        rtype = r[3] if len(r) > 3 else "daily"
        nominal = r[4] if len(r) > 4 else 1
        name = r[5] if len(r) > 5 else f"name {code}"
        ts = r[6] if len(r) > 6 else dt.datetime.combine(day, dt.time(18))
        out.append((code, name, Decimal(str(rate)).quantize(Decimal("0.000001")), day, rtype, nominal, ts))
    return spark.createDataFrame(out, RAW_SCHEMA)


def raw_table(spark, rows=None):
    """A raw table of its own in the catalogue."""
    import uuid

    from tidemark.operators import tables
    from tidemark.session import shared_dir
    name = f"tests_raw.t_{uuid.uuid4().hex}"
    tables.create_raw(spark, name, shared_dir(spark, "tests_raw"))
    if rows is not None:
        tables.load_raw(spark, name, rows)
    return name
