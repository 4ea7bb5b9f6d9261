"""Ad-hoc analytical queries over the warehouse and the reports."""

from __future__ import annotations

from datetime import date

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.exact import mean_of
from ..operators.scd2 import current_rows
from . import reports


def zone_distribution(t) -> DataFrame:
    """Students per geopolitical zone, current versions; students are counted per state before the join."""
    state = t["dim_geography"].select(F.col("state_name").alias("state_of_origin"), "geopolitical_zone")
    per_state = current_rows(t["dim_student"]).groupBy("state_of_origin").agg(F.count("*").alias("n"))
    return per_state.join(state, "state_of_origin").groupBy("geopolitical_zone").agg(F.sum("n").alias("students"))


def faculty_avg_point(t) -> DataFrame:
    """Mean grade point by faculty over every version a fact points at."""
    per_student = t["fact_enrollment"].groupBy("student_sk").agg(F.sum("grade_point").alias("s"), F.count("grade_point").alias("n"))
    faculty = t["dim_student"].select("student_sk", "faculty_name")
    total = per_student.join(faculty, "student_sk").groupBy("faculty_name").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return total.select("faculty_name", mean_of(F.col("s"), F.col("n"), 1, 4).alias("avg_grade_point"))


def version_by_surrogate(facts: DataFrame, versions: DataFrame, surrogate: str, *columns: str) -> DataFrame:
    """Facts with the attributes of the very version they point at."""
    return facts.join(versions.select(surrogate, *columns), surrogate)


def latest_session(t, as_of: date | None = None) -> DataFrame:
    """Name of the latest session, one row; with ``as_of`` the latest begun by that day."""
    periods = t["dim_academic_period"]
    if as_of is not None:
        periods = periods.where(F.col("start_date") <= F.lit(as_of))
    return periods.orderBy(F.col("academic_year").desc(), F.col("semester_id").desc()).limit(1).select("session_name")


def latest_session_filter(t, as_of: date | None = None) -> DataFrame:
    """Faculty performance in the latest session."""
    newest = latest_session(t, as_of).scalar()
    return reports.faculty_performance(t).where(F.col("session_name") == newest).orderBy(F.col("avg_grade_point").desc())


def topk_departments(t, session_name: str, k: int = 10) -> DataFrame:
    """First departments of the ranking; ties are ordered by name."""
    ranked = reports.department_gpa_ranking(t).where(F.col("session_name") == session_name)
    return ranked.orderBy("cgpa_rank", "faculty_name", "department_name").limit(k)


def flagged_courses(t) -> DataFrame:
    return (
        reports.course_failure_rate(t)
        .where(F.col("risk_flag").isin("HIGH RISK", "ELEVATED"))
        .select("course_code", "course_title", "faculty_name", "session_name", "semester_name", "failure_rate_pct", "risk_flag")
        .orderBy(F.col("failure_rate_pct").desc())
    )


def high_failure_courses(t, above: float = 30.0) -> DataFrame:
    return reports.course_failure_rate(t).where(F.col("failure_rate_pct") > above).orderBy(F.col("failure_rate_pct").desc())


def critical_students(t, level: str = "Critical — Probation Risk") -> DataFrame:
    return reports.at_risk_students(t).where(F.col("risk_level") == level).orderBy("cgpa")


def latest_registering_faculties(t) -> DataFrame:
    return (
        reports.registration_behaviour(t)
        .select("faculty_name", "level_name", "session_name", "semester_name", "avg_days_before_deadline", "late_rate_pct")
        .orderBy("avg_days_before_deadline")
    )


def student_trend(t, matric_no: str) -> DataFrame:
    return reports.student_progression(t).where(F.col("student_matric_no") == matric_no).orderBy("session_name")


def semester_timeline(t, session_name: str, semester_name: str) -> DataFrame:
    chosen = (F.col("session_name") == session_name) & (F.col("semester_name") == semester_name)
    return reports.registration_timeline(t).where(chosen).orderBy("registration_date")


def last_runs(t, k: int = 10) -> DataFrame:
    return reports.etl_health(t).orderBy(F.col("etl_run_id").desc()).limit(k)


def run_status_histogram(t) -> DataFrame:
    return t["etl_log"].groupBy("status").agg(F.count("*").alias("runs"))


def run_history(t) -> DataFrame:
    """Runs with their duration, newest first."""
    columns = ("etl_run_id", "run_started_at", "run_finished_at", "status", "rows_inserted", "rows_updated", "scd2_rows_closed")
    return reports.etl_health(t).select(*columns, "dq_errors", "dq_warnings", "duration_seconds").orderBy(F.col("etl_run_id").desc())


def failed_checks(dq_log: DataFrame) -> DataFrame:
    """Logged checks, newest first."""
    return dq_log.orderBy(F.col("checked_at").desc(), "check_name")


def checks_logged(runs) -> DataFrame:
    """The check log of several runs: (run id, time, failed checks of the run) as log rows."""
    rows = [
        failed.select("check_name", "check_category", "severity", "records_flagged", "detail", F.lit(at).cast("timestamp_ntz").alias("checked_at"), F.lit(run_id).cast("bigint").alias("etl_run_id"))
        for run_id, at, failed in runs
    ]
    return reduce(DataFrame.unionByName, rows)


def row_counts(t, names) -> DataFrame:
    """Rows of each named table."""
    parts = [t[n].agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def version_history(dim: DataFrame, key: str, value) -> DataFrame:
    """All versions of one key in order."""
    return dim.where(F.col(key) == F.lit(value)).orderBy("effective_date", "expiry_date")
