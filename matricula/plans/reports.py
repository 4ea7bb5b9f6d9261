"""Reporting views over the warehouse.

Facts are reduced to one row per student (or course, or lecturer) and period
name before they meet a large dimension, so the join moves summaries, one
busy key is combined before the shuffle, and distinct students are counted by
counting rows.  Reports join a fact to the version it points at and keep it
only while that version is current; with ``durable_key`` facts follow their
student to the current version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import bands, dates
from ..functions.bands import MIN_GROUP
from ..functions.exact import mean_of, percent
from ..operators.scd2 import current_rows, natural_key

PERIOD = ("session_name", "semester_name")

# Decimal places of the stored measures, for exact means.
SCORE_SCALE, POINT_SCALE, GPA_SCALE = 2, 1, 2


def _true(column: str) -> Column:
    return F.count_if(F.col(column))


def _mean_parts(column: str) -> dict[str, Column]:
    return {f"{column}_sum": F.sum(column), f"{column}_n": F.count(column)}


def _add_up(names) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _mean(column: str, scale: int, digits: int) -> Column:
    return mean_of(F.col(f"{column}_sum"), F.col(f"{column}_n"), scale, digits)


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def _with_period(fact: DataFrame, t, *columns: str) -> DataFrame:
    return fact.join(t["dim_academic_period"].select("period_sk", *(columns or PERIOD)), "period_sk")


def _students(t, *columns: str) -> DataFrame:
    """student_sk of facts -> attributes, for versions that are current."""
    return current_rows(t["dim_student"]).select("student_sk", *columns)


# --- enrolment reports --------------------------------------------------------


def faculty_performance(t, durable_key: bool = False) -> DataFrame:
    measures = {
        "total_enrollments": F.count("*"),
        **_mean_parts("total_score"),
        **_mean_parts("grade_point"),
        "total_passes": _true("is_pass"),
        "total_failures": _true("is_fail"),
        "total_distinctions": _true("is_distinction"),
    }
    who = "student_id" if durable_key else "student_sk"
    fact = t["fact_enrollment"]
    if durable_key:
        fact = fact.withColumn("student_id", natural_key(F.col("student_sk")))
    per_student = _with_period(fact, t).groupBy(who, *PERIOD).agg(*_named(measures))
    people = current_rows(t["dim_student"]).select(who, "faculty_name")
    total = per_student.join(people, who).groupBy("faculty_name", *PERIOD).agg(
        F.count("*").alias("total_students"), *_add_up(measures)
    )
    n = F.col("total_enrollments")
    return total.select(
        "faculty_name",
        *PERIOD,
        "total_students",
        "total_enrollments",
        _mean("total_score", SCORE_SCALE, 1).alias("avg_total_score"),
        _mean("grade_point", POINT_SCALE, 2).alias("avg_grade_point"),
        "total_passes",
        "total_failures",
        "total_distinctions",
        percent(F.col("total_passes"), n).alias("pass_rate_pct"),
        percent(F.col("total_failures"), n).alias("failure_rate_pct"),
        percent(F.col("total_distinctions"), n).alias("distinction_rate_pct"),
    )


def ser001_compliance_rate(t, level_name: str = "100L") -> DataFrame:
    """First-year students of each faculty against every session, enrolled in the compulsory course or not.

    Every student counts in every session, so totals are counted per faculty
    and only the faculties, not the students, are repeated per session.
    """
    first_years = current_rows(t["dim_student"]).where(F.col("level_name") == level_name).select("student_sk", "faculty_name")
    enrolled = (
        _with_period(t["fact_enrollment"].where("is_compulsory_se"), t, "session_name")
        .groupBy("student_sk", "session_name")
        .agg(F.count("*").alias("n"))
        .join(first_years, "student_sk")
        .groupBy("faculty_name", "session_name")
        .agg(F.sum("n").alias("ser001_registered"), F.count("*").alias("takers"))
    )
    sessions = t["dim_academic_period"].agg(F.collect_set("session_name").alias("names")).scalar()
    every = (
        first_years.groupBy("faculty_name")
        .agg(F.count("*").alias("total_100L_students"))
        .withColumn("names", sessions)
        .withColumn("session_name", F.explode("names"))
        .drop("names")
    )
    takers, total = F.coalesce("takers", F.lit(0)), F.col("total_100L_students")
    return every.join(enrolled, ["faculty_name", "session_name"], "left").select(
        "faculty_name",
        "session_name",
        "total_100L_students",
        "ser001_registered",
        (total - takers).alias("ser001_missing"),
        percent(takers, total).alias("compliance_rate_pct"),
    )


def course_failure_rate(t, min_group: int = MIN_GROUP, high: int = bands.HIGH_FAILURE_PCT, elevated: int = bands.ELEVATED_FAILURE_PCT) -> DataFrame:
    course = t["dim_course"].select(
        "course_sk", "course_code", "course_title", "faculty_name", "department_name", "level_name", "credit_units"
    )
    groups = (
        _with_period(t["fact_enrollment"], t)
        .groupBy("course_sk", *PERIOD)
        .agg(
            F.count("*").alias("total_enrolled"), _true("is_pass").alias("passed"), _true("is_fail").alias("failed"),
            *_named(_mean_parts("total_score")),
        )
        .where(F.col("total_enrolled") >= min_group)
    )
    failed, total = F.col("failed"), F.col("total_enrolled")
    return groups.join(course, "course_sk").select(
        "course_code",
        "course_title",
        "faculty_name",
        "department_name",
        "level_name",
        "credit_units",
        *PERIOD,
        "total_enrolled",
        "passed",
        "failed",
        percent(failed, total).alias("failure_rate_pct"),
        _mean("total_score", SCORE_SCALE, 1).alias("avg_score"),
        bands.failure_flag(failed, total, high, elevated).alias("risk_flag"),
    )


def credit_load_distribution(t, integer_average: bool = True) -> DataFrame:
    """One row per student and period, with the spread of unit loads over faculty, level and period.

    The spread is aggregated and joined back rather than taken in a window: a
    faculty's level may hold a large part of all students.  The mean of whole
    units is a whole number, cut off; ``integer_average=False`` keeps one
    decimal.
    """
    cohort = ["faculty_name", "level_name", "period_sk"]
    loads = (
        t["fact_enrollment"]
        .groupBy("student_sk", "period_sk")
        .agg(F.sum("credit_units").alias("units"))
        .join(_students(t, "faculty_name", "level_name"), "student_sk")
    )
    spread = loads.groupBy(*cohort).agg(
        F.min("units").alias("min_credits"), F.max("units").alias("max_credits"), F.sum("units").alias("s"), F.count("units").alias("n")
    )
    mean = F.call_function("div", F.col("s"), F.col("n")).cast("double") if integer_average else mean_of(F.col("s"), F.col("n"), 0, 1)
    spread = spread.withColumn("avg_credits", mean).drop("s", "n")
    students = F.lit(1).cast("bigint").alias("students")
    return _with_period(loads.join(spread, cohort), t).select(
        "faculty_name", "level_name", *PERIOD, students, "min_credits", "max_credits", "avg_credits"
    )


def student_diversity(t) -> DataFrame:
    """Students and CGPA by origin; a student's CGPA counts once per enrolment of the period it stands on."""
    origin = t["dim_geography"].select("geo_sk", "geopolitical_zone", "region")
    gpa = t["fact_student_gpa"].select("student_sk", "period_sk", "cgpa")
    weighted = F.col("cgpa") * F.col("n")
    group = ["geopolitical_zone", "region", "faculty_name", "session_name"]
    per_period = (
        t["fact_enrollment"]
        .where(F.col("geo_sk").isNotNull())
        .groupBy("student_sk", "period_sk", "geo_sk")
        .agg(F.count("*").alias("n"))
        .join(gpa, ["student_sk", "period_sk"], "left")
    )
    per_session = (
        _with_period(per_period, t, "session_name")
        .groupBy("student_sk", "session_name", "geo_sk")
        .agg(F.sum(weighted).alias("cgpa_sum"), F.sum(F.when(F.col("cgpa").isNotNull(), F.col("n"))).alias("cgpa_n"))
    )
    total = (
        per_session.join(_students(t, "faculty_name"), "student_sk")
        .join(origin, "geo_sk")
        .groupBy(*group)
        .agg(F.count_distinct("student_sk").alias("student_count"), *_add_up(["cgpa_sum", "cgpa_n"]))
    )
    return total.select(*group, "student_count", _mean("cgpa", GPA_SCALE, 2).alias("avg_cgpa"))


def lecturer_performance(t) -> DataFrame:
    lecturer = t["dim_staff"].select("staff_sk", F.col("full_name").alias("lecturer_name"), "department_name", "faculty_name", "designation")
    course = t["dim_course"].select("course_sk", "course_code", "course_title", "level_name", "credit_units")
    groups = (
        _with_period(t["fact_enrollment"].where(F.col("staff_sk").isNotNull()), t)
        .groupBy("staff_sk", "course_sk", *PERIOD)
        .agg(
            F.count("*").alias("students_enrolled"),
            *_named(_mean_parts("total_score")),
            *_named(_mean_parts("grade_point")),
            _true("is_pass").alias("students_passed"),
            _true("is_fail").alias("students_failed"),
            _true("is_distinction").alias("distinctions"),
        )
    )
    return groups.join(lecturer, "staff_sk").join(course, "course_sk").select(
        "lecturer_name",
        "department_name",
        "faculty_name",
        "designation",
        *PERIOD,
        "course_code",
        "course_title",
        "level_name",
        "credit_units",
        "students_enrolled",
        _mean("total_score", SCORE_SCALE, 1).alias("avg_score"),
        _mean("grade_point", POINT_SCALE, 2).alias("avg_grade_point"),
        "students_passed",
        "students_failed",
        "distinctions",
        percent(F.col("students_passed"), F.col("students_enrolled")).alias("pass_rate_pct"),
    )


def prereq_compliance_audit(t) -> DataFrame:
    """Enrolments lacking a good enough result in the prerequisite from an earlier semester.

    Results in required courses are folded to the first semester start per
    (student, course, grade); registrations meet their results, stored by the
    same key, before they move by course.  The search for an earlier pass is one anti-join
    on student and course with two inequalities.  Names and attributes are
    joined to the violations alone.
    """
    starts = t["semester"].select("semester_id", "start_date")
    needs = t["course_prerequisite"].select("course_id", "required_course_id", "min_grade")
    graded = t["course_result"].where(F.col("grade").isNotNull()).select("registration_id", "grade")
    earlier = (
        t["course_registration"]
        .select("registration_id", "student_id", F.col("course_id").alias("required_course_id"), "semester_id")
        .join(graded, "registration_id")
        .join(F.broadcast(starts), "semester_id")
        .select("student_id", "required_course_id", "grade", "start_date")
        .join(needs.select("required_course_id").distinct(), "required_course_id")  # inner: a semi-join would be moved below the others
        .groupBy("student_id", "required_course_id", "grade")
        .agg(F.min("start_date").alias("first_start"))
    )
    main = t["dim_course"].select("course_sk", "course_id", F.col("course_code").alias("registered_course"), F.col("course_title").alias("registered_title"))
    required = t["dim_course"].select(
        F.col("course_id").alias("required_course_id"),
        F.col("course_code").alias("missing_prereq_code"),
        F.col("course_title").alias("missing_prereq_title"),
    )
    rules = main.select("course_sk", "course_id").join(needs, "course_id").drop("course_id")
    period = t["dim_academic_period"].select("period_sk", "semester_id", *PERIOD)
    begins = period.select("period_sk", "semester_id").join(F.broadcast(starts), "semester_id", "left").drop("semester_id")
    enrolled = (
        t["fact_enrollment"]
        .select("student_sk", "course_sk", "period_sk", "registration_status")
        .join(rules, "course_sk")
        .join(F.broadcast(begins), "period_sk")
        .withColumn("student_id", natural_key(F.col("student_sk")))
    )
    e, p = enrolled.alias("e"), earlier.alias("p")
    met = (
        (F.col("e.student_id") == F.col("p.student_id"))
        & (F.col("e.required_course_id") == F.col("p.required_course_id"))
        & (F.col("p.grade") <= F.col("e.min_grade"))
        & (F.col("p.first_start") < F.col("e.start_date"))
    )
    violations = (
        e.join(p, met, "left_anti")
        .select("student_sk", "course_sk", "period_sk", "required_course_id", "registration_status")
        .join(main.drop("course_id"), "course_sk")
        .join(required, "required_course_id")
        .join(F.broadcast(period.drop("semester_id")), "period_sk")
        .join(_students(t, "student_matric_no", "full_name", "faculty_name"), "student_sk")
    )
    return violations.select(
        "student_matric_no",
        "full_name",
        "faculty_name",
        "registered_course",
        "registered_title",
        "missing_prereq_code",
        "missing_prereq_title",
        *PERIOD,
        "registration_status",
    )


# --- GPA reports --------------------------------------------------------------


def at_risk_students(t) -> DataFrame:
    risky = t["fact_student_gpa"].where(
        F.col("is_at_risk") | (F.col("courses_failed") >= bands.MANY_FAILURES) | (F.col("cgpa") < bands.SECOND_LOWER)
    )
    person = ("student_matric_no", "full_name", "faculty_name", "department_name", "programme_name", "level_name")
    return _with_period(risky, t, "session_name").join(_students(t, *person), "student_sk").select(
        *person,
        "cgpa",
        "courses_failed",
        "courses_registered",
        "total_credits_earned",
        bands.risk_level(F.col("cgpa"), F.col("courses_failed")).alias("risk_level"),
        F.col("session_name").alias("latest_session"),
    )


def department_gpa_ranking(t) -> DataFrame:
    """Departments ranked in each session; the ranked rows are one per department and session."""
    group = ["faculty_name", "department_name", "session_name"]
    stats = (
        _with_period(t["fact_student_gpa"], t, "session_name")
        .join(_students(t, "faculty_name", "department_name"), "student_sk")
        .groupBy(*group)
        .agg(
            F.count_distinct("student_sk").alias("student_count"),
            *_named(_mean_parts("session_gpa")),
            *_named(_mean_parts("cgpa")),
            _true("is_first_class").alias("first_class_count"),
            _true("is_second_class_upper").alias("sc_upper_count"),
            _true("is_at_risk").alias("at_risk_count"),
        )
        .select(
            *group,
            _mean("session_gpa", GPA_SCALE, 2).alias("avg_session_gpa"),
            _mean("cgpa", GPA_SCALE, 2).alias("avg_cgpa"),
            "student_count",
            "first_class_count",
            "sc_upper_count",
            "at_risk_count",
        )
    )
    best_first = Window.partitionBy("session_name").orderBy(F.col("avg_cgpa").desc())
    return stats.withColumn("first_class_pct", percent(F.col("first_class_count"), F.col("student_count"))).withColumn(
        "cgpa_rank", F.rank().over(best_first)
    )


def student_progression(t) -> DataFrame:
    """GPA trend; a student's window holds one row per session."""
    person = ("student_id", "student_matric_no", "full_name", "faculty_name", "programme_name")
    in_order = Window.partitionBy("student_id").orderBy("academic_year", "semester_name")
    return (
        _with_period(t["fact_student_gpa"], t, *PERIOD, "academic_year")
        .join(_students(t, *person), "student_sk")
        .select(
            *person[1:],
            *PERIOD,
            "session_gpa",
            "cgpa",
            (F.col("cgpa") - F.lag("cgpa").over(in_order)).alias("cgpa_delta"),
            "courses_registered",
            "courses_passed",
            "courses_failed",
            "total_credits_earned",
            bands.class_of_degree(F.col("cgpa")).alias("class_of_degree"),
            "is_at_risk",
        )
    )


def credit_completion_rate(t) -> DataFrame:
    group = ["faculty_name", "level_name", "session_name"]
    return (
        _with_period(t["fact_student_gpa"], t, "session_name")
        .join(_students(t, "faculty_name", "level_name"), "student_sk")
        .groupBy(*group)
        .agg(
            F.count_distinct("student_sk").alias("students"),
            *_add_up(["total_credits_attempted", "total_credits_earned"]),
            *_named(_mean_parts("session_gpa")),
        )
        .select(
            *group,
            "students",
            "total_credits_attempted",
            "total_credits_earned",
            percent(F.col("total_credits_earned"), F.col("total_credits_attempted")).alias("completion_rate_pct"),
            _mean("session_gpa", GPA_SCALE, 2).alias("avg_gpa"),
        )
    )


def yoy_gpa_trend(t) -> DataFrame:
    return (
        _with_period(t["fact_student_gpa"], t, "session_name")
        .join(_students(t, "faculty_name"), "student_sk")
        .groupBy("faculty_name", "session_name")
        .agg(*_named(_mean_parts("session_gpa")))
        .select("faculty_name", "session_name", _mean("session_gpa", GPA_SCALE, 2).alias("avg_gpa"))
    )


# --- registration reports -----------------------------------------------------


def registration_behaviour(t) -> DataFrame:
    measures = {
        "total_registrations": F.count("*"),
        "late_registrations": _true("was_late"),
        "rejected_registrations": _true("was_rejected"),
        "days_sum": F.sum("days_before_deadline"),
        "days_n": F.count("days_before_deadline"),
    }
    group = ["faculty_name", "level_name", *PERIOD]
    per_student = _with_period(t["fact_registration_event"], t).groupBy("student_sk", *PERIOD).agg(*_named(measures))
    total = per_student.join(_students(t, "faculty_name", "level_name"), "student_sk").groupBy(*group).agg(*_add_up(measures))
    return total.select(
        *group,
        "total_registrations",
        "late_registrations",
        "rejected_registrations",
        _mean("days", 0, 1).alias("avg_days_before_deadline"),
        percent(F.col("late_registrations"), F.col("total_registrations")).alias("late_rate_pct"),
    )


def registration_timeline(t) -> DataFrame:
    """Registrations per day of a period and so far; the window holds one row per day."""
    daily = (
        t["fact_registration_event"]
        .groupBy("period_sk", F.col("attempt_date_key").alias("date_key"))
        .agg(F.count("*").alias("daily_registrations"), _true("was_late").alias("late_registrations"), _true("was_rejected").alias("rejected_attempts"))
        .join(t["dim_date"].select("date_key", "full_date", "day_name"), "date_key")
    )
    so_far = Window.partitionBy("period_sk").orderBy("full_date")
    return _with_period(daily, t, *PERIOD, "start_date", "reg_deadline").select(
        *PERIOD,
        F.col("full_date").alias("registration_date"),
        "day_name",
        dates.days_between(F.col("start_date"), F.col("full_date")).alias("day_of_semester"),
        dates.days_between(F.col("full_date"), F.col("reg_deadline")).alias("days_until_deadline"),
        "daily_registrations",
        F.sum("daily_registrations").over(so_far).alias("cumulative_registrations"),
        "late_registrations",
        "rejected_attempts",
    )


# --- run log ------------------------------------------------------------------


def etl_health(t) -> DataFrame:
    return t["etl_log"].select(
        "etl_run_id",
        "run_started_at",
        "run_finished_at",
        "status",
        dates.seconds_between(F.col("run_started_at"), F.col("run_finished_at")).alias("duration_seconds"),
        "rows_inserted",
        "rows_updated",
        "scd2_rows_closed",
        "dq_errors",
        "dq_warnings",
        "triggered_by",
        bands.run_health(F.col("status"), F.col("dq_warnings")).alias("health_status"),
        "error_message",
    )


REPORTS = {
    f.__name__: f
    for f in (
        faculty_performance, at_risk_students, ser001_compliance_rate, course_failure_rate, registration_behaviour,
        credit_load_distribution, student_diversity, department_gpa_ranking, student_progression,
        prereq_compliance_audit, registration_timeline, lecturer_performance, credit_completion_rate, etl_health,
    )
}
