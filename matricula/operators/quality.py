"""Ten data-quality checks and the gate that blocks a load on errors."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.bands import MAX_UNITS, folded
from ..sources.reference_data import COMPULSORY_CODE

ERROR, WARNING = "ERROR", "WARNING"

# Number, name, category, severity, text after the count.
CHECKS = {
    "DQ-01": ("Students with NULL programme_id", "STUDENT", ERROR, "students have no programme assigned."),
    "DQ-02": ("Results with total_score > 100", "RESULTS", ERROR, "results have total_score exceeding 100."),
    "DQ-03": ("Registrations after semester end date", "REGISTRATION", WARNING, "registrations have dates after semester end."),
    "DQ-04": ("100L students not registered for SER001", "REGISTRATION", WARNING, "active 100L students have not registered SER001 this semester."),
    "DQ-05": ("Students exceeding 24 credit unit limit", "REGISTRATION", ERROR, "student-semester combinations exceed 24 credit unit maximum."),
    "DQ-06": ("Results exist for Dropped registrations", "RESULTS", WARNING, "results found for registrations with status=Dropped."),
    "DQ-07": ("Duplicate matric numbers", "STUDENT", ERROR, "matric numbers appear more than once."),
    "DQ-08": ("Closed semesters with zero registrations", "COURSE", WARNING, "past semesters have no course registrations at all."),
    "DQ-09": ("Grade does not match total score range", "RESULTS", ERROR, "results have a grade that does not match the score-to-grade mapping."),
    "DQ-10": ("Registrations with no result after semester ended", "RESULTS", WARNING, "past-semester registrations have no result entered."),
}


def _count(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.count("*").alias("records_flagged")).select(F.lit(check).alias("check_id"), "records_flagged")


def missing_programme(t) -> DataFrame:
    return _count(t["student"].where(F.col("programme_id").isNull()), "DQ-01")


def _pair(one_row: DataFrame, first: str, second: str) -> DataFrame:
    """A row (a, b) as two checks."""
    return one_row.select(F.expr(f"stack(2, '{first}', a, '{second}', b) as (check_id, records_flagged)"))


def score_and_grade(t) -> DataFrame:
    """DQ-02 and DQ-09 from one scan of the results; a grade outside the scale is not compared."""
    scale = t["grade_scale"].select("grade", "min_score", "max_score")
    graded = t["course_result"].select("grade", "total_score").join(scale, "grade", "left")
    misfit = ~F.col("total_score").between(F.col("min_score"), F.col("max_score"))
    return _pair(graded.agg(F.count_if(F.col("total_score") > 100).alias("a"), F.count_if(misfit).alias("b")), "DQ-02", "DQ-09")


def registration_checks(t, as_of: date, limit: int = MAX_UNITS) -> DataFrame:
    """DQ-03, 05, 06, 08 and 10 from one scan of the registrations.

    Results are counted per registration and joined once; then each (student, semester) is summed up, and each semester
    over its students.  Only the first of these sums moves many rows, and it is combined on the map side."""
    results = t["course_result"].groupBy("registration_id").agg(F.count("*").alias("results"))
    ends = t["semester"].select("semester_id", "end_date")
    late = F.col("registration_date").cast("date") > F.col("end_date")
    dropped = F.when(F.col("registration_status") == "Dropped", F.col("results"))
    unresolved = F.col("results").isNull() & (F.col("registration_status") == "Registered") & (F.col("end_date") < F.lit(as_of))
    # Judged before they move by course: what moves is narrow.
    held = (
        t["course_registration"].select("registration_id", "student_id", "course_id", "semester_id", "registration_date", "registration_status")
        .join(results, "registration_id", "left")
        .join(F.broadcast(ends), "semester_id", "left")
        .select("student_id", "course_id", "semester_id", late.alias("late"), dropped.alias("dropped"), unresolved.alias("unresolved"))
        .join(t["course"].select("course_id", "credit_units"), "course_id", "left")
    )
    loads = held.groupBy("student_id", "semester_id").agg(
        F.sum("credit_units").alias("units"), F.count_if("late").alias("late"), F.sum("dropped").alias("dropped"), F.count_if("unresolved").alias("unresolved")
    )
    used = loads.groupBy("semester_id").agg(
        F.count_if(F.col("units") > limit).alias("over"), F.sum("late").alias("late"), F.sum("dropped").alias("dropped"),
        F.sum("unresolved").alias("unresolved"), F.lit(True).alias("used"),
    )
    # Registrations of an unknown semester count as well; a semester without any is empty.
    by_semester = ends.join(used, "semester_id", "full")
    empty = F.count_if((F.col("end_date") < F.lit(as_of)) & F.col("used").isNull())
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    one = by_semester.agg(total("late"), total("over"), total("dropped"), empty.alias("empty"), total("unresolved"))
    return one.select(F.expr(
        "stack(5, 'DQ-03', late, 'DQ-05', over, 'DQ-06', dropped, 'DQ-08', empty, 'DQ-10', unresolved) as (check_id, records_flagged)"
    ))


def first_years_without_compulsory(t, code: str = COMPULSORY_CODE) -> DataFrame:
    """Counts (student, current semester) pairs without the course: the semesters there are less those it was taken in."""
    current = t["semester"].where("is_current").select("semester_id")
    course = t["course"].where(F.col("course_code") == code).select("course_id")
    taken = (
        t["course_registration"]
        .join(course, "course_id", "left_semi")
        .join(current, "semester_id", "left_semi")
        .groupBy("student_id")
        .agg(F.count_distinct("semester_id").alias("taken"))
    )
    first_year = t["student_level"].where("level_number = 100").select(F.col("level_id").alias("current_level_id"))
    students = t["student"].where("enrollment_status = 'Active'").join(first_year, "current_level_id", "left_semi")
    semesters = current.agg(F.count("*").alias("n")).scalar()
    missing = F.sum(semesters - F.coalesce("taken", F.lit(0)))
    return students.join(taken, "student_id", "left").agg(
        F.coalesce(missing, F.lit(0)).alias("records_flagged")
    ).select(F.lit("DQ-04").alias("check_id"), "records_flagged")


def duplicate_matric(t, case_insensitive: bool = False) -> DataFrame:
    """Numbers with more than one student; with ``case_insensitive`` numbers that differ in case alone are one."""
    number = folded(F.col("student_matric_no"), case_insensitive).alias("student_matric_no")
    return _count(t["student"].groupBy(number).count().where("count > 1"), "DQ-07")


def check_counts(t, as_of: date, unit_limit: int = MAX_UNITS, code: str = COMPULSORY_CODE) -> DataFrame:
    """All ten checks with their counts, zeros included."""
    parts = [
        missing_programme(t),
        duplicate_matric(t),
        score_and_grade(t),
        registration_checks(t, as_of, unit_limit),
        first_years_without_compulsory(t, code),
    ]
    counts = reduce(DataFrame.unionByName, parts)
    rule = F.create_map(
        *[x for k, v in CHECKS.items() for x in (F.lit(k), F.struct(*[F.lit(p).alias(n) for n, p in zip("ncsd", v)]))]
    )[F.col("check_id")]
    return counts.select(
        "check_id",
        rule["n"].alias("check_name"),
        rule["c"].alias("check_category"),
        rule["s"].alias("severity"),
        "records_flagged",
        F.concat_ws(" ", F.col("records_flagged").cast("string"), rule["d"]).alias("detail"),
    )


def run_checks(t, as_of: date, **limits) -> DataFrame:
    """The log rows of one run: checks that flagged something."""
    return check_counts(t, as_of, **limits).where("records_flagged > 0")


def gate(flagged: DataFrame) -> DataFrame:
    """One row: failed error checks, failed warning checks, and whether the load may go on."""
    severity = F.col("severity")
    return flagged.agg(
        F.count_if(severity == ERROR).alias("errors"), F.count_if(severity == WARNING).alias("warnings")
    ).withColumn("passes", F.col("errors") == 0)
