"""Read views and parameterised lookups over the source tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.bands import folded, full_name
from ..sources.reference_data import COMPULSORY_CODE


def _person() -> list:
    return [F.col("student_matric_no"), full_name(F.col("first_name"), F.col("last_name")).alias("student_name")]


def _placement(t) -> DataFrame:
    """programme_id -> programme, department and faculty names."""
    programme = t["programme"].select("programme_id", "programme_name", "department_id")
    department = t["department"].select("department_id", "department_name", "faculty_id")
    faculty = t["faculty"].select("faculty_id", "faculty_name")
    return programme.join(department, "department_id").join(faculty, "faculty_id").select(
        "programme_id", "programme_name", "department_name", "faculty_name"
    )


def student_registration_summary(t, as_of: date) -> DataFrame:
    """Courses and units of each student in the current semester, and whether its window is open."""
    sessions = t["academic_session"].select("session_id", "session_name")
    current = t["semester"].where("is_current").select("semester_id", "session_id", "semester_name", "reg_deadline")
    loads = (
        t["course_registration"]
        .join(current.select("semester_id"), "semester_id", "left_semi")
        .join(t["course"].select("course_id", "credit_units"), "course_id")
        .groupBy("student_id", "semester_id")
        .agg(F.count("*").alias("total_courses_registered"), F.sum("credit_units").alias("total_credit_units"))
    )
    level = t["student_level"].select(F.col("level_id").alias("current_level_id"), F.col("level_name").alias("current_level"))
    closed = F.when(F.lit(as_of) > F.col("reg_deadline"), "Closed").otherwise("Open")
    return (
        loads.join(current.join(sessions, "session_id"), "semester_id")
        .join(t["student"], "student_id")
        .join(level, "current_level_id")
        .join(_placement(t), "programme_id")
        .select(
            *_person(),
            "current_level",
            "programme_name",
            "department_name",
            "faculty_name",
            "semester_name",
            "session_name",
            "reg_deadline",
            "total_courses_registered",
            "total_credit_units",
            closed.alias("reg_window_status"),
        )
    )


def student_transcript(t, students: DataFrame | None = None) -> DataFrame:
    """Registrations with their result, if any; the level is that of the course."""
    people = t["student"] if students is None else students
    period = t["semester"].select("semester_id", "session_id", "semester_name").join(
        t["academic_session"].select("session_id", "session_name"), "session_id"
    )
    course = t["course"].select("course_id", "course_code", "course_title", "credit_units", "level_id").join(
        t["student_level"].select("level_id", "level_name"), "level_id"
    )
    scores = ("ca_score", "exam_score", "total_score", "grade", "grade_point", "credit_units_earned", "remark")
    return (
        t["course_registration"]
        .select("registration_id", "student_id", "course_id", "semester_id", "course_type_taken")
        .join(people.select("student_id", *_person()), "student_id")
        .join(t["course_result"].select("registration_id", *scores), "registration_id", "left")
        .join(period, "semester_id")
        .join(course, "course_id")
        .select(
            "student_matric_no", "student_name", "session_name", "semester_name", "level_name", "course_code",
            "course_title", "credit_units", "course_type_taken", *scores,
        )
    )


def ser001_compliance(t, code: str = COMPULSORY_CODE, case_insensitive: bool = False) -> DataFrame:
    """First-year students against their registrations for the compulsory course in any semester."""
    same = folded(F.col("course_code"), case_insensitive) == folded(F.lit(code), case_insensitive)
    course = t["course"].where(same).select("course_id")
    taken = t["course_registration"].join(course, "course_id", "left_semi").select("student_id", "registration_id")
    first_year = t["student_level"].where("level_number = 100").select(F.col("level_id").alias("current_level_id"), "level_name")
    status = F.when(F.col("registration_id").isNotNull(), "Registered").otherwise("NOT Registered")
    return (
        t["student"]
        .join(first_year, "current_level_id")
        .join(_placement(t), "programme_id")
        .join(taken, "student_id", "left")
        .select(*_person(), "level_name", "faculty_name", "department_name", status.alias("ser001_status"))
    )


def course_prereq_chain(t) -> DataFrame:
    """Direct prerequisites with levels and lowest grade."""
    course = t["course"].join(t["student_level"].select("level_id", "level_name"), "level_id")
    main = course.select("course_id", "course_code", "course_title", F.col("level_name").alias("course_level"))
    required = course.select(
        F.col("course_id").alias("required_course_id"),
        F.col("course_code").alias("prerequisite_code"),
        F.col("course_title").alias("prerequisite_title"),
        F.col("level_name").alias("prereq_level"),
    )
    return t["course_prerequisite"].join(main, "course_id").join(required, "required_course_id").select(
        "course_code", "course_title", "course_level", "prerequisite_code", "prerequisite_title", "prereq_level",
        F.col("min_grade").alias("required_min_grade"),
    )


# --- parameterised lookups ----------------------------------------------------


def student_courses(t, matric_no: str, semester_id: int) -> DataFrame:
    student = t["student"].where(F.col("student_matric_no") == matric_no).select("student_id")
    course = t["course"].select("course_id", "course_code", "course_title", "credit_units")
    return (
        t["course_registration"]
        .where(F.col("semester_id") == semester_id)
        .join(student, "student_id", "left_semi")
        .join(course, "course_id")
        .select("course_type_taken", "course_code", "course_title", "credit_units", "registration_status", "registration_date")
        .orderBy("course_type_taken", "course_code")
    )


def transcript(t, matric_no: str) -> DataFrame:
    chosen = t["student"].where(F.col("student_matric_no") == matric_no)
    return student_transcript(t, chosen).orderBy("session_name", "semester_name", "course_code")
