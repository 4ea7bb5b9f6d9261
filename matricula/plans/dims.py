"""Dimension loads: calendar, period, course, staff (Type 1) and student (Type 2)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dates
from ..functions.bands import full_name
from ..functions.dates import CALENDAR_END, CALENDAR_START, FIRST_WATERMARK
from ..operators.extract import changed_since
from ..operators.load import type1_upsert, unmatched
from ..operators.scd2 import scd2_merge
from ..schemas import conform, schema_of
from ..sources.reference_data import literal_table

# Student attributes whose change opens a new version.
TRACKED = ("programme_name", "level_name", "faculty_name", "department_name", "enrollment_status")


# Columns a later load refreshes on a match.
COURSE_REFRESHED = (
    "course_code", "course_title", "course_description", "credit_units", "category_code", "category_name", "department_name",
    "faculty_name", "faculty_abbreviation", "level_name", "level_number", "semester_offered", "is_compulsory_se", "is_active",
    "has_prerequisites", "prerequisite_count", "dw_updated_at",
)
STAFF_REFRESHED = ("full_name", "department_name", "faculty_name", "designation", "is_active")

# Attributes of a student version taken from the source.
SNAPSHOT = (
    "student_id", "student_matric_no", "full_name", "first_name", "last_name", "gender", "state_of_origin", "programme_name",
    "faculty_name", "department_name", "level_name", "level_number", "degree_type", "admission_year", "enrollment_status",
)


def empty(spark: SparkSession, table: str) -> DataFrame:
    return literal_table(spark, [], schema_of(table))


# --- calendar ----------------------------------------------------------------


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a DataFrame with a ``full_date`` column."""
    day = F.col("full_date")
    return days.select(
        dates.date_key(day).alias("date_key"),
        day,
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_num"),
        F.weekofyear(day).alias("week_num"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_num"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_name"),
        F.year(day).alias("year_num"),
        dates.academic_year(day).alias("academic_year"),
        F.lit(None).cast("int").alias("academic_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        dates.season(day).alias("season"),
    )


def day_range(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of each row."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date"))


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    return calendar(day_range(bounds))


def new_days(days: DataFrame, existing: DataFrame) -> DataFrame:
    return unmatched(days, existing, ["date_key"])


# --- Type 1 ------------------------------------------------------------------


def period_source(t, watermark: datetime = FIRST_WATERMARK, until: datetime | None = None) -> DataFrame:
    sessions = t["academic_session"].select("session_id", "session_name")
    start, end, deadline = F.col("start_date"), F.col("end_date"), F.col("reg_deadline")
    name = F.concat("session_name", F.lit(" - "), "semester_name", F.lit(" Semester"))
    return changed_since(t["semester"], watermark, until).join(sessions, "session_id").select(
        F.col("semester_id").alias("period_sk"),
        "semester_id",
        "session_name",
        "semester_name",
        name.alias("full_period_name"),
        F.year(start).alias("academic_year"),
        start,
        end,
        deadline,
        dates.days_between(start, deadline).alias("reg_duration_days"),
        dates.days_between(start, end).alias("semester_duration_days"),
        "is_current",
    )


def upsert_academic_period(t, target: DataFrame, watermark: datetime = FIRST_WATERMARK, until=None) -> DataFrame:
    return type1_upsert(target, conform(period_source(t, watermark, until), "dim_academic_period"), "semester_id")


def prerequisite_counts(t) -> DataFrame:
    return t["course_prerequisite"].groupBy("course_id").agg(F.count("*").alias("prerequisite_count"))


def course_source(t, now: datetime, watermark: datetime = FIRST_WATERMARK, until: datetime | None = None) -> DataFrame:
    category = t["course_category"].select("category_id", "category_code", "category_name")
    department = t["department"].select("department_id", "faculty_id", "department_name")
    faculty = t["faculty"].select("faculty_id", "faculty_name", F.col("abbreviation").alias("faculty_abbreviation"))
    level = t["student_level"].select("level_id", "level_name", "level_number")
    counted = F.coalesce("prerequisite_count", F.lit(0))
    stamp = F.lit(now).cast("timestamp_ntz")
    return (
        changed_since(t["course"], watermark, until)
        .join(category, "category_id")
        .join(department, "department_id")
        .join(faculty, "faculty_id")
        .join(level, "level_id")
        .join(prerequisite_counts(t), "course_id", "left")
        .withColumns({
            "course_sk": F.col("course_id"),
            "has_prerequisites": counted > 0,
            "prerequisite_count": counted,
            "dw_created_at": stamp,
            "dw_updated_at": stamp,
        })
    )


def upsert_course(t, target: DataFrame, now: datetime, watermark: datetime = FIRST_WATERMARK, until=None) -> DataFrame:
    source = conform(course_source(t, now, watermark, until), "dim_course")
    return type1_upsert(target, source, "course_id", update=COURSE_REFRESHED)


def staff_source(t, now: datetime, watermark: datetime = FIRST_WATERMARK, until: datetime | None = None) -> DataFrame:
    department = t["department"].select("department_id", "faculty_id", "department_name")
    faculty = t["faculty"].select("faculty_id", "faculty_name")
    return (
        changed_since(t["staff"], watermark, until)
        .join(department, "department_id")
        .join(faculty, "faculty_id")
        .withColumns({
            "staff_sk": F.col("staff_id"),
            "full_name": full_name(F.col("first_name"), F.col("last_name")),
            "dw_created_at": F.lit(now).cast("timestamp_ntz"),
        })
    )


def upsert_staff(t, target: DataFrame, now: datetime, watermark: datetime = FIRST_WATERMARK, until=None) -> DataFrame:
    """A match refreshes all but the staff number."""
    return type1_upsert(target, conform(staff_source(t, now, watermark, until), "dim_staff"), "staff_id", update=STAFF_REFRESHED)


# --- Type 2 ------------------------------------------------------------------


def student_snapshot(t, watermark: datetime = FIRST_WATERMARK, until: datetime | None = None, touch: bool = False) -> DataFrame:
    """Students changed since the watermark, flattened through programme, department and faculty.

    With ``touch`` a later change of the programme, department or faculty
    counts as a change of its students.
    """
    stamped = lambda name, *columns: t[name].select(*columns, F.col("updated_at").alias(f"{name}_at"))
    flat = (
        t["student"]
        .join(stamped("programme", "programme_id", "department_id", "degree_type_id", "programme_name"), "programme_id")
        .join(stamped("department", "department_id", "faculty_id", "department_name"), "department_id")
        .join(stamped("faculty", "faculty_id", "faculty_name"), "faculty_id")
        .join(t["student_level"].select(F.col("level_id").alias("current_level_id"), "level_name", "level_number"), "current_level_id")
        .join(t["degree_type"].select("degree_type_id", F.col("degree_code").alias("degree_type")), "degree_type_id")
        .join(
            t["academic_session"].select(F.col("session_id").alias("admission_session_id"), F.col("session_name").alias("admission_year")),
            "admission_session_id",
        )
    )
    if touch:
        flat = flat.withColumn("updated_at", F.greatest("updated_at", "programme_at", "department_at", "faculty_at"))
    named = flat.withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))
    return changed_since(named, watermark, until).select(*SNAPSHOT)


def merge_student(
    current: DataFrame, snapshot: DataFrame, as_of: date, now: datetime, run_id: int, known_keys: DataFrame | None = None
) -> DataFrame:
    """The open student versions after a snapshot, with ``action`` per row."""
    stamp = F.lit(now).cast("timestamp_ntz")
    extra = {"dw_created_at": stamp, "dw_updated_at": stamp, "etl_run_id": F.lit(run_id).cast("bigint")}
    return scd2_merge(current, snapshot, "student_id", TRACKED, as_of, "student_sk", known_keys, extra)
