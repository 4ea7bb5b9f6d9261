"""Fact loads: enrolment, session GPA with running CGPA, registration events.

Facts are joined to few, prepared lookups: everything known per student, per
course and per offering is put together first, so that a large fact meets
each key once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import bands, dates
from ..functions.bands import folded
from ..functions.dates import FIRST_WATERMARK
from ..functions.exact import decimal_ratio
from ..operators.extract import changed_since
from ..operators.load import unmatched
from ..operators.registration import session_gpa
from ..operators.rollup import distinct_rollup
from ..operators.scd2 import current_rows, natural_key
from ..operators.temporal import asof_lookup

EVENT_KEY = ("student_id", "course_sk", "period_sk")


def origin_lookup(t, case_insensitive: bool = False) -> DataFrame:
    """student_id -> state of origin, if it is known."""
    state = t["dim_geography"].select("geo_sk", folded(F.col("state_name"), case_insensitive).alias("state"))
    return (
        t["student"]
        .select("student_id", folded(F.col("state_of_origin"), case_insensitive).alias("state"))
        .join(state, "state", "left")
        .select("student_id", "geo_sk")
    )


def student_lookup(t, case_insensitive: bool = False) -> DataFrame:
    """student_id -> current version and state of origin."""
    current = current_rows(t["dim_student"]).select("student_id", "student_sk")
    return current.join(origin_lookup(t, case_insensitive), "student_id", "left")


def course_lookup(t) -> DataFrame:
    """course_id -> course dimension and units of the source."""
    return t["dim_course"].select("course_id", "course_sk").join(t["course"].select("course_id", "credit_units"), "course_id")


def semester_lookup(t) -> DataFrame:
    """Semesters with their period: two a year, so sent to the facts, which few semesters would otherwise deal to few tasks."""
    period = t["dim_academic_period"].select("semester_id", "period_sk")
    semesters = t["semester"].select("semester_id", "session_id", "semester_name", "start_date", "reg_deadline")
    return F.broadcast(semesters.join(F.broadcast(period), "semester_id"))


def lecturer_lookup(t, fanout: bool = False) -> DataFrame:
    """(course, semester) -> lecturer: the one with the lowest number, or with ``fanout`` each of them."""
    assigned = t["course_assignment"].select("course_id", "semester_id", "staff_id")
    if not fanout:
        assigned = assigned.groupBy("course_id", "semester_id").agg(F.min("staff_id").alias("staff_id"))
    return assigned.join(t["dim_staff"].select("staff_id", "staff_sk"), "staff_id", "left").drop("staff_id")


def enrollment_flags() -> dict:
    """The flags of an enrolment from remark, grade, registration day and course type."""
    is_ = lambda column, value: bands.flag(F.col(column) == value)
    return {
        "is_pass": is_("remark", "Pass"),
        "is_distinction": is_("grade", "A"),
        "is_credit": is_("grade", "B"),
        "is_fail": is_("remark", "Fail"),
        "is_absent": is_("remark", "Absent"),
        "is_late_registration": bands.flag(F.col("registration_date").cast("date") > F.col("reg_deadline")),
        "is_major_course": is_("course_type_taken", "MAJOR"),
        "is_elective_course": is_("course_type_taken", "ELECTIVE"),
        "is_compulsory_se": is_("course_type_taken", "COMPULSORY_SE"),
    }


def enrollment_rows(
    t, run_id: int, now: datetime, watermark: datetime = FIRST_WATERMARK, until: datetime | None = None,
    fanout: bool = False, case_insensitive: bool = False, at_registration: bool = False,
) -> DataFrame:
    """Enrolment facts of the results changed since the watermark, however late they come.

    They point at the student's current version, or with ``at_registration``
    at the one valid on the day of registration.
    """
    results = changed_since(t["course_result"], watermark, until).select(
        "registration_id", "ca_score", "exam_score", "total_score", "grade", "grade_point", "credit_units_earned", "remark", "entered_at"
    )
    registrations = t["course_registration"].drop("updated_at")
    rows = (
        results.join(registrations, "registration_id")
        .join(semester_lookup(t), "semester_id")
        .join(course_lookup(t), "course_id")
        .join(lecturer_lookup(t, fanout), ["course_id", "semester_id"], "left")
    )
    if at_registration:
        dated = rows.withColumn("registered_on", F.col("registration_date").cast("date"))
        versions = t["dim_student"].select("student_id", "student_sk", "effective_date", "expiry_date")
        rows = asof_lookup(dated, versions, "student_id", "registered_on", ["student_sk"], "effective_date", "expiry_date", "inner")
        people = origin_lookup(t, case_insensitive)
    else:
        people = student_lookup(t, case_insensitive)
    return (
        rows.join(people, "student_id")
        .withColumns({
            "reg_date_key": dates.date_key(F.col("registration_date")),
            "result_date_key": dates.date_key(F.col("entered_at")),
            **enrollment_flags(),
            "dw_inserted_at": F.lit(now).cast("timestamp_ntz"),
            "etl_run_id": F.lit(run_id).cast("bigint"),
        })
    )


def period_students(t, enrollment: DataFrame) -> DataFrame:
    """The students of each period and department of a course, as bitmaps that merge into exact distinct counts."""
    department = t["dim_course"].select("course_sk", "department_name")
    students = enrollment.select("period_sk", "course_sk", natural_key(F.col("student_sk")).alias("student_id")).join(department, "course_sk")
    return distinct_rollup(students, ("period_sk", "department_name"), "student_id")


def affected_registrations(t, watermark: datetime, until: datetime | None = None) -> DataFrame:
    return changed_since(t["course_result"], watermark, until).select("registration_id").distinct()


def affected_students(t, watermark: datetime, until: datetime | None = None) -> DataFrame:
    changed = affected_registrations(t, watermark, until)
    return t["course_registration"].join(changed, "registration_id", "left_semi").select("student_id").distinct()


def running_cgpa(sessions: DataFrame, weighted: bool = False) -> DataFrame:
    """Mean of the session GPAs up to each session; every session counts, also one without a GPA.

    One row per (student, session) comes in, so a student's window holds no
    more rows than there are sessions.  ``weighted`` weighs by units.
    """
    so_far = Window.partitionBy("student_id").orderBy("session_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hundredths = (F.col("session_gpa") * 100).cast("bigint")
    weight = F.col("credits_attempted") if weighted else F.lit(1)
    total = F.sum(hundredths * weight).over(so_far)
    count = F.sum(weight).over(so_far)
    return sessions.withColumn("cgpa", decimal_ratio(total, count * 100, 2))


RUNNING = ("student_id", "session_id", "session_gpa", "points_so_far", "sessions_so_far")


def running_state(sessions: DataFrame) -> DataFrame:
    """Per student and session the sum (in hundredths) and number of session GPAs so far, from which the CGPA follows."""
    so_far = Window.partitionBy("student_id").orderBy("session_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hundredths = F.coalesce((F.col("session_gpa") * 100).cast("bigint"), F.lit(0))
    return sessions.select("student_id", "session_id", "session_gpa", F.sum(hundredths).over(so_far).alias("points_so_far"), F.count("*").over(so_far).alias("sessions_so_far"))


def continued_state(state: DataFrame, changed: DataFrame) -> DataFrame:
    """``state`` after new or changed session GPAs: sums go on from the last session before a student's first change.

    Sessions before it, and students without a change, keep their rows; of the sessions after it only the GPA that the
    state holds is needed, not the results behind it.
    """
    first = changed.groupBy("student_id").agg(F.min("session_id").alias("first"))
    known = state.join(first, "student_id", "left")
    kept = known.where("first IS NULL OR session_id < first")
    newest = F.struct("points_so_far", "sessions_so_far")
    base = kept.where("first IS NOT NULL").groupBy("student_id").agg(F.max_by(newest, "session_id").alias("base"))
    later = known.where("session_id >= first").select("student_id", "session_id", "session_gpa")
    fresh = later.join(changed, ["student_id", "session_id"], "left_anti").unionByName(changed.select(*later.columns))
    added = lambda c: (F.col(c) + F.coalesce(F.col(f"base.{c}"), F.lit(0))).alias(c)
    again = running_state(fresh).join(base, "student_id", "left").select("student_id", "session_id", "session_gpa", added("points_so_far"), added("sessions_so_far"))
    return kept.select(*RUNNING).unionByName(again)


def cgpa_of(state: DataFrame) -> DataFrame:
    return state.withColumn("cgpa", decimal_ratio(F.col("points_so_far"), F.col("sessions_so_far") * 100, 2))


def gpa_rows(
    t, run_id: int, now: datetime, watermark: datetime = FIRST_WATERMARK, until: datetime | None = None,
    weighted: bool = False, case_insensitive: bool = False,
) -> DataFrame:
    """GPA facts of all sessions of the students with changed results, placed on the Second semester.

    With ``until`` only results known by then count, so a student with later ones alone has no row.
    """
    results, students = t["course_result"], None
    if watermark > FIRST_WATERMARK or until is not None:
        students = affected_students(t, watermark, until)
    if until is not None:
        results = changed_since(results, FIRST_WATERMARK, until)
    sessions = session_gpa(t["course_registration"], results, t["course"], t["semester"], students)
    second = F.broadcast(semester_lookup(t).where("semester_name = 'Second'").select("session_id", "period_sk"))
    return (
        running_cgpa(sessions, weighted)
        .join(second, "session_id")
        .join(student_lookup(t, case_insensitive), "student_id")
        .withColumnsRenamed({"credits_attempted": "total_credits_attempted", "credits_earned": "total_credits_earned"})
        .withColumns({
            **bands.standing_flags(F.col("cgpa")),
            "dw_inserted_at": F.lit(now).cast("timestamp_ntz"),
            "etl_run_id": F.lit(run_id).cast("bigint"),
        })
    )


def _event(attempts: DataFrame, t, at: str) -> DataFrame:
    day = F.col(at).cast("date")
    known = t["dim_course"].select("course_id", "course_sk")
    students = current_rows(t["dim_student"]).select("student_id", "student_sk")
    return (
        attempts.join(semester_lookup(t), "semester_id")
        .join(known, "course_id")
        .join(students, "student_id")
        .withColumns({
            "attempt_date_key": dates.date_key(day),
            "days_from_sem_start": dates.days_between(F.col("start_date"), day),
            "days_before_deadline": dates.days_between(day, F.col("reg_deadline")),
            "late": bands.flag(day > F.col("reg_deadline")),
        })
    )


EVENT_COLUMNS = (
    "student_id", "student_sk", "course_sk", "period_sk", "attempt_date_key", "days_from_sem_start",
    "days_before_deadline", "was_late", "was_rejected", "prereqs_failed", "registration_status",
)


def event_rows(
    t, run_id: int, now: datetime, watermark: datetime = FIRST_WATERMARK, until: datetime | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Accepted and rejected registration attempts since the watermark that the fact lacks.

    ``existing`` holds the fact's events with their ``student_id``: accepted
    ones are known by student, course and period, whatever the student's
    version, rejected ones by their audit number.
    """
    accepted = _event(changed_since(t["course_registration"], watermark, until), t, "registration_date").withColumns(
        {"was_late": F.col("late"), "was_rejected": F.lit(False), "prereqs_failed": F.lit(0)}
    )
    rejected = _event(changed_since(t["registration_audit"], watermark, until, "attempt_time"), t, "attempt_time").withColumns(
        {"was_rejected": F.lit(True), "registration_status": F.lit("Rejected")}
    )
    if existing is not None:
        accepted = unmatched(accepted, existing.where(~F.col("was_rejected")), EVENT_KEY)
        rejected = unmatched(rejected, existing.where("was_rejected"), ["audit_id"])
    return (
        accepted.select(*EVENT_COLUMNS)
        .unionByName(rejected.select(*EVENT_COLUMNS, "rejection_reason", "audit_id"), allowMissingColumns=True)
        .withColumns({"dw_inserted_at": F.lit(now).cast("timestamp_ntz"), "etl_run_id": F.lit(run_id).cast("bigint")})
    )


def attempted_periods(t, watermark: datetime, until: datetime | None = None) -> DataFrame:
    """The periods (their semesters' numbers) of the attempts since the watermark."""
    accepted = changed_since(t["course_registration"], watermark, until).select("semester_id")
    rejected = changed_since(t["registration_audit"], watermark, until, "attempt_time").select("semester_id")
    return accepted.unionByName(rejected).distinct()


def with_student_id(events: DataFrame) -> DataFrame:
    """Facts with the natural key of their student, over all versions."""
    return events.withColumn("student_id", natural_key(F.col("student_sk")))
