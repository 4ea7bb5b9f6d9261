"""The stored tables of the engine over one directory of raw files."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import SparkSession, functions as F

from ..sources import derived
from ..sources.tables import Tables
from ..session import tune
from . import dims, facts

LOAD_DATE = date(2002, 1, 1)
LOAD_TIME = datetime(2002, 1, 1)
RUN_ID = 1


def calendar_bounds(t):
    """First day of the first and last day of the last year of registrations and attempts."""
    orders = t.raw("orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    events = t.raw("events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    both = orders.unionByName(events).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    first = F.make_date(F.year("lo"), F.lit(1), F.lit(1))
    last = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    return both.select(first.alias("first_day"), last.alias("last_day"))


def _first_load(upsert, table, *args):
    return lambda t: upsert(t, dims.empty(t.spark, table), *args)


WAREHOUSE_BUILDERS = {
    "dim_date": lambda t: dims.calendar(dims.day_range(calendar_bounds(t))),
    "dim_academic_period": _first_load(dims.upsert_academic_period, "dim_academic_period"),
    "dim_course": _first_load(dims.upsert_course, "dim_course", LOAD_TIME),
    "dim_staff": _first_load(dims.upsert_staff, "dim_staff", LOAD_TIME),
    "dim_student": lambda t: dims.merge_student(
        dims.empty(t.spark, "dim_student"), dims.student_snapshot(t), LOAD_DATE, LOAD_TIME, RUN_ID
    ),
    "fact_enrollment": lambda t: facts.enrollment_rows(t, RUN_ID, LOAD_TIME),
    "fact_student_gpa": lambda t: facts.gpa_rows(t, RUN_ID, LOAD_TIME),
    "fact_registration_event": lambda t: facts.event_rows(t, RUN_ID, LOAD_TIME),
}

_open: dict[tuple[str, str], Tables] = {}


def open_tables(spark: SparkSession, raw_dir: str) -> Tables:
    """Tables of a raw directory, shared by all queries of the session."""
    key = (spark.sparkContext.applicationId, raw_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Tables(tune(spark), raw_dir, {**derived.BUILDERS, **WAREHOUSE_BUILDERS}, derived.VIEWS)
    return _open[key]
