"""Every registered query by name, as a function of the tables."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import bands
from ..functions.exact import decimal_ratio
from ..operators import constraints, extract, load, quality, registration, rollup, scd2, security, temporal
from ..sources.derived import semester_of
from ..sources.reference_data import resolve_literals
from ..session import fresh_folder, stored
from ..sources.store import Store
from . import adhoc, dims, facts, pipeline, reports, views
from .warehouse import LOAD_TIME, RUN_ID

BATCH_1, BATCH_2 = date(1997, 12, 31), date(1999, 12, 31)
CHECK_DATE = date(2025, 1, 1)
READ_DATE = date(2001, 8, 1)


def portable(df: DataFrame) -> DataFrame:
    """Columns in types every engine prints alike: dates and times as text, flags and counts as BIGINT, decimals as DOUBLE."""

    def plain(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal") or kind == "float":
            column = column.cast("double")
        elif kind in ("boolean", "tinyint", "smallint", "int"):
            column = column.cast("bigint")
        return column.alias(name)

    return df.select(*[plain(n, k) for n, k in df.dtypes])


# --- sources ------------------------------------------------------------------


def seed_key_resolution(t) -> DataFrame:
    """Literal (department, category, title) rows resolved to keys, with the courses under each."""
    rows = [("NATION_3", "LARGE", "Engines"), ("NATION_10", "PROMO", "Posters"), ("NATION_21", "SMALL", "Models"), ("NOWHERE", "SMALL", "None")]
    resolved = resolve_literals(
        t.spark, rows, "department string, category string, title string",
        [(t["department"], "department_name", "department", "department_id"), (t["course_category"], "category_code", "category", "category_id")],
    ).withColumnsRenamed({"department_key": "department_id", "category_key": "category_id"})
    counts = t["course"].groupBy("department_id", "category_id").agg(F.count("*").alias("courses"))
    return resolved.join(counts, ["department_id", "category_id"], "left").select(
        "department_id", "category_id", "title", F.coalesce("courses", F.lit(0)).alias("courses")
    )


def calendar_attributes(t) -> DataFrame:
    """Registrations by academic year, season and kind of day."""
    daily = t["course_registration"].groupBy(F.col("registration_date").cast("date").alias("full_date")).agg(F.count("*").alias("n"))
    days = t["dim_date"].select("full_date", "academic_year", "season", "is_weekend", "quarter_name")
    group = ["academic_year", "season", "quarter_name", "is_weekend"]
    return daily.join(days, "full_date").groupBy(*group).agg(F.sum("n").alias("registrations"), F.count("*").alias("days"))


def incremental_extract(t) -> DataFrame:
    changed = extract.changed_since(t["course_result"], datetime(2000, 1, 1), datetime(2001, 6, 30))
    return changed.select(F.col("registration_id").cast("string").alias("registration_id"), "total_score", "updated_at")


def type1_upsert(t) -> DataFrame:
    """Courses up to a day, then the later ones and some of the same with changed titles."""
    columns = ("course_id", "course_code", "course_title", "credit_units", "updated_at")
    base = extract.changed_since(t["course"], datetime(1900, 1, 1), datetime(1999, 1, 1)).select(*columns)
    batch = extract.changed_since(t["course"], datetime(1998, 1, 1)).select(*columns).withColumn("course_title", F.upper("course_title"))
    return load.type1_upsert(base, batch, "course_id", update=["course_title", "updated_at"])


def replace_affected_keys(t) -> DataFrame:
    columns = ("registration_id", "total_score")
    stored = extract.changed_since(t["course_result"], datetime(1900, 1, 1), datetime(2000, 1, 1)).select(*columns)
    changed = extract.changed_since(t["course_result"], datetime(1999, 1, 1)).select(*columns)
    changed = changed.withColumn("total_score", (F.col("total_score") + 1).cast("decimal(6,2)"))
    out = load.replace_affected_keys(stored, changed, changed, ["registration_id"])
    return out.withColumn("registration_id", F.col("registration_id").cast("string"))


def idempotent_append(t) -> DataFrame:
    """Calendar days up to a day, then the whole calendar twice."""
    days = t["dim_date"].select("date_key", "full_date", "day_name")
    stored = days.where(F.col("full_date") <= F.lit(date(1998, 12, 31)))
    once = load.idempotent_append(stored, days, ["date_key"])
    return load.idempotent_append(once, days, ["date_key"])


# --- expressions, joins, aggregates -------------------------------------------


def case_bands(t) -> DataFrame:
    gpa = t["fact_student_gpa"]
    return gpa.groupBy(
        bands.class_of_degree(F.col("cgpa")).alias("class_of_degree"),
        bands.risk_level(F.col("cgpa"), F.col("courses_failed")).alias("risk_level"),
    ).agg(F.count("*").alias("n"))


def enrollment_flags(t) -> DataFrame:
    flags = ("is_pass", "is_distinction", "is_credit", "is_fail", "is_absent", "is_late_registration", "is_major_course", "is_elective_course", "is_compulsory_se")
    by = t["fact_enrollment"].groupBy("period_sk").agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
    return by.withColumnRenamed("period_sk", "semester_id")


def optional_dim_lookup(t) -> DataFrame:
    """Enrolments by zone of origin and by whether a lecturer is known."""
    state = t["dim_geography"].select("geo_sk", "geopolitical_zone")
    grouped = t["fact_enrollment"].groupBy("geo_sk", F.col("staff_sk").isNotNull().alias("has_lecturer")).agg(F.count("*").alias("n"))
    return grouped.join(state, "geo_sk", "left").groupBy("geopolitical_zone", "has_lecturer").agg(F.sum("n").alias("enrollments"))


def prereq_counts(t) -> DataFrame:
    return t["dim_course"].select("course_code", "has_prerequisites", "prerequisite_count")


def anti_join_orphans(t) -> DataFrame:
    """Registrations without a result."""
    return t["course_registration"].join(t["course_result"].select("registration_id"), "registration_id", "left_anti").select(
        "student_id", "course_id", "semester_id", "registration_status"
    )


def asof_dim_lookup(t) -> DataFrame:
    """Registrations with the student version valid on their day."""
    dated = t["course_registration"].select("student_id", "course_id", "semester_id", F.col("registration_date").cast("date").alias("day"))
    return temporal.asof_lookup(dated, t["student_history"], "student_id", "day", ["programme_name", "enrollment_status"])


def weighted_gpa(t) -> DataFrame:
    sessions = registration.session_gpa(t["course_registration"], t["course_result"], t["course"], t["semester"])
    return sessions.select("student_id", "session_id", "session_gpa", "credits_attempted", "credits_earned")


def running_cgpa(t) -> DataFrame:
    sessions = registration.session_gpa(t["course_registration"], t["course_result"], t["course"], t["semester"])
    return facts.running_cgpa(sessions).select("student_id", "session_id", "session_gpa", "cgpa")


def running_cgpa_weighted(t) -> DataFrame:
    sessions = registration.session_gpa(t["course_registration"], t["course_result"], t["course"], t["semester"])
    return facts.running_cgpa(sessions, weighted=True).select("student_id", "session_id", "cgpa")


def running_cgpa_after_late_results(t) -> DataFrame:
    """The running CGPA of a state that was built before some results came, and then continued with their sessions."""
    late = F.pmod(F.xxhash64("registration_id"), F.lit(10)) == 0
    gpa = lambda results, registrations: registration.session_gpa(registrations, results, t["course"], t["semester"])
    state = stored(facts.running_state(gpa(t["course_result"].where(~late), t["course_registration"])), "gpa-state")
    of = t["semester"].select("semester_id", "session_id")
    came = t["course_registration"].where(late).join(of, "semester_id").select("student_id", "session_id").distinct()
    touched = t["course_registration"].join(of, "semester_id").join(came, ["student_id", "session_id"], "left_semi").drop("session_id")
    after = facts.continued_state(state, stored(gpa(t["course_result"], touched), "late-sessions"))
    return facts.cgpa_of(after).select("student_id", "session_id", "session_gpa", "cgpa")


def faculty_performance_at_registration(t) -> DataFrame:
    """Grade points by the tracked attribute valid at registration rather than today."""
    scored = t["course_registration"].join(t["course_result"].select("registration_id", "grade_point"), "registration_id")
    dated = scored.select("student_id", F.col("registration_date").cast("date").alias("day"), "grade_point")
    seen = temporal.asof_lookup(dated, t["student_history"], "student_id", "day", ["programme_name"])
    return seen.groupBy("programme_name").agg(
        F.count("*").alias("results"), decimal_ratio(F.sum("grade_point") * 10, F.count("grade_point") * 10, 4, 12).alias("avg_grade_point")
    )


# --- warehouse loads, by natural keys -----------------------------------------


def _enrollment_by_keys(rows: DataFrame, t) -> DataFrame:
    student = t["dim_student"].select("student_sk", "student_id")
    staff = t["dim_staff"].select("staff_sk", "staff_id")
    state = t["dim_geography"].select("geo_sk", "state_name")
    return (
        rows.join(student, "student_sk")
        .join(staff, "staff_sk", "left")
        .join(state, "geo_sk", "left")
        .withColumnsRenamed({"course_sk": "course_id", "period_sk": "semester_id"})
        .drop("student_sk", "staff_sk", "geo_sk", "registration_id", "dw_inserted_at", "etl_run_id")
    )


def fact_enrollment(t) -> DataFrame:
    return _enrollment_by_keys(t["fact_enrollment"], t)


def fact_enrollment_fanout(t) -> DataFrame:
    """Enrolments once per lecturer of the course and semester."""
    rows = facts.enrollment_rows(t, RUN_ID, LOAD_TIME, fanout=True)
    return rows.groupBy("semester_id").agg(F.count("*").alias("rows"), F.count("staff_sk").alias("with_lecturer"), F.sum("staff_sk").alias("staff_sum"))


def fact_student_gpa(t) -> DataFrame:
    student = t["dim_student"].select("student_sk", "student_id")
    state = t["dim_geography"].select("geo_sk", "state_name")
    return (
        t["fact_student_gpa"].join(student, "student_sk").join(state, "geo_sk", "left").withColumnRenamed("period_sk", "semester_id")
        .drop("student_sk", "geo_sk", "dw_inserted_at", "etl_run_id")
    )


def fact_registration_event(t) -> DataFrame:
    events = facts.with_student_id(t["fact_registration_event"])
    return events.withColumnsRenamed({"course_sk": "course_id", "period_sk": "semester_id"}).drop(
        "student_sk", "audit_id", "dw_inserted_at", "etl_run_id"
    )


def _without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def dim_student(t) -> DataFrame:
    return _without(t["dim_student"], "student_sk", "dw_created_at", "dw_updated_at", "etl_run_id")


# --- history ------------------------------------------------------------------

TRACKED = ["programme_name", "enrollment_status"]


def _snapshot(t, day: date) -> DataFrame:
    """Last change of each student up to a day."""
    last = F.max_by(F.struct(*TRACKED), "changed_on").alias("last")
    return t["student_change"].where(F.col("changed_on") <= F.lit(day)).groupBy("student_id").agg(last).select("student_id", "last.*")


def _empty_history(t) -> DataFrame:
    return dims.empty(t.spark, "dim_student").select("student_sk", "student_id", *TRACKED, "effective_date", "expiry_date", "is_current")


def _first_load(t) -> DataFrame:
    return scd2.scd2_merge(_empty_history(t), _snapshot(t, BATCH_1), "student_id", TRACKED, BATCH_1, "student_sk")


def _second_load(t, first: DataFrame | None = None) -> DataFrame:
    """A snapshot merged into the stored dimension."""
    first = stored(_first_load(t).drop("action"), "first-load") if first is None else first
    snapshot = stored(_snapshot(t, BATCH_2), "snapshot")
    return scd2.scd2_merge(first, snapshot, "student_id", TRACKED, BATCH_2, "student_sk")


def scd2_first_load(t) -> DataFrame:
    return _first_load(t).drop("student_sk", "action")


def scd2_second_load(t) -> DataFrame:
    versions = _second_load(t).drop("action")
    return versions.withColumn("version", scd2.version_number(F.col("student_sk"))).drop("student_sk")


def scd2_counts(t) -> DataFrame:
    return scd2.scd2_counts(_second_load(t))


def scd2_current(t) -> DataFrame:
    return scd2.current_rows(_second_load(t)).select("student_id", *TRACKED, "effective_date")


def version_history(t) -> DataFrame:
    return adhoc.version_history(_second_load(t), "student_id", 7).select("student_id", *TRACKED, "effective_date", "expiry_date", "is_current")


def version_by_surrogate(t) -> DataFrame:
    """Orders pointing at the version open when they were loaded, counted by that version's attribute."""
    first = stored(_first_load(t).drop("action"), "first-load")
    versions = stored(_second_load(t, first).drop("action"), "second-load")
    early = first.select("student_id", "student_sk")
    late = scd2.current_rows(versions).select("student_id", "student_sk")
    orders = t.raw("orders").select(F.col("o_custkey").alias("student_id"), F.col("o_orderdate").cast("date").alias("day"))
    loaded = orders.where(F.col("day") <= F.lit(BATCH_1)).join(early, "student_id").unionByName(
        orders.where(F.col("day") > F.lit(BATCH_1)).join(late, "student_id")
    )
    pointed = adhoc.version_by_surrogate(loaded, versions, "student_sk", "programme_name")
    return pointed.groupBy("programme_name", F.year("day").alias("year")).agg(F.count("*").alias("orders"))


def versions_from_changes(t) -> DataFrame:
    return t["student_history"]


def versions_from_timestamps(t) -> DataFrame:
    """Versions of each user's last event type, to the microsecond."""
    versions = temporal.versions_from_changes(t.raw("events"), "user_id", "ts", ["event_type"], "event_id")
    open_ = F.year("valid_to") == 9999
    length = F.timestamp_diff("SECOND", "valid_from", "valid_to")
    return versions.groupBy("user_id", "event_type").agg(
        F.count("*").alias("versions"), F.count_if(open_).alias("open"), F.sum(F.when(~open_, length)).alias("seconds")
    )


def system_time_as_of(t) -> DataFrame:
    return temporal.system_time(t["student_history"], "as_of", date(1998, 6, 1))


def system_time_between(t) -> DataFrame:
    return temporal.system_time(t["student_history"], "between", date(1998, 1, 1), date(1998, 3, 1))


def system_time_all(t) -> DataFrame:
    return temporal.system_time(t["student_history"], "all").orderBy("student_id", "valid_from")


# --- checks -------------------------------------------------------------------


def _with(t, **tables: DataFrame):
    """The tables with some replaced."""
    return ChainMap(tables, t)


def _records(df: DataFrame, check: str) -> DataFrame:
    return df.where(F.col("check_id") == check).select("records_flagged")


def dq_checks(t) -> DataFrame:
    return quality.check_counts(t, CHECK_DATE)


def dq_gate(t) -> DataFrame:
    return quality.gate(quality.run_checks(t, CHECK_DATE))


def dq01(t) -> DataFrame:
    """On students whose programme is taken away where they are suspended."""
    programme = F.when(F.col("enrollment_status") != "Suspended", F.col("programme_id"))
    return _records(quality.missing_programme(_with(t, student=t["student"].withColumn("programme_id", programme))), "DQ-01")


def dq02(t) -> DataFrame:
    """On results with ten points more."""
    results = t["course_result"].withColumn("total_score", F.col("total_score") + 10)
    return _records(quality.score_and_grade(_with(t, course_result=results)), "DQ-02")


def dq03(t) -> DataFrame:
    """On semesters that end 180 days after their start."""
    short = t["semester"].withColumn("end_date", F.date_add("start_date", 180))
    return _records(quality.registration_checks(_with(t, semester=short), CHECK_DATE), "DQ-03")


def dq04(t) -> DataFrame:
    return _records(quality.first_years_without_compulsory(t), "DQ-04")


def dq05(t) -> DataFrame:
    return _records(quality.registration_checks(t, CHECK_DATE), "DQ-05")


def dq06(t) -> DataFrame:
    return _records(quality.registration_checks(t, CHECK_DATE), "DQ-06")


def dq07_duplicates(t) -> DataFrame:
    """On students numbered by state and programme."""
    number = F.concat_ws("/", "state_of_origin", F.col("programme_id").cast("string"))
    return _records(quality.duplicate_matric(_with(t, student=t["student"].withColumn("student_matric_no", number))), "DQ-07")


def dq07_case_insensitive(t) -> DataFrame:
    """On students numbered by state and programme, half of them in small letters."""
    number = F.concat_ws("/", "state_of_origin", F.col("programme_id").cast("string"))
    mixed = F.when(F.col("student_id") % 2 == 0, F.lower(number)).otherwise(number)
    return _records(quality.duplicate_matric(_with(t, student=t["student"].withColumn("student_matric_no", mixed)), True), "DQ-07")


def dq08(t) -> DataFrame:
    return _records(quality.registration_checks(t, CHECK_DATE), "DQ-08")


def dq09_grade_range(t) -> DataFrame:
    return _records(quality.score_and_grade(t), "DQ-09")


def dq10(t) -> DataFrame:
    return _records(quality.registration_checks(t, CHECK_DATE), "DQ-10")


RAW_RULES = {
    "checks": (constraints.Check("customer", "balance", "c_acctbal >= 0"), constraints.Check("orders", "status", "o_orderstatus IN ('O','F')")),
    "not_nulls": (constraints.NotNull("orders", ("o_orderkey", "o_custkey")),),
    "uniques": (constraints.Unique("lineitem", ("l_orderkey", "l_linenumber")), constraints.Unique("customer", ("c_nationkey", "c_mktsegment"))),
    "references": (constraints.Reference("orders", "o_custkey", "recent", "user_id"),),
}


def raw_constraint_violations(t) -> DataFrame:
    """Rules that the raw tables do break, counted per rule."""
    raw = {n: t.raw(n) for n in ("customer", "orders", "lineitem")}
    raw["recent"] = t.raw("events").select("user_id").distinct()
    found = constraints.violations(raw, raw, **RAW_RULES)
    return found.groupBy("rule").agg(F.count("*").alias("keys"), F.sum("violations").alias("violations"))


MODEL_TABLES = (
    "academic_session", "semester", "student_level", "degree_type", "grade_scale", "college", "faculty", "department", "programme",
    "course_category", "course", "course_prerequisite", "programme_course", "student", "course_registration", "registration_audit",
    "course_result", "staff", "course_assignment", "security_user_map", "etl_watermark", "etl_log", "dim_date", "dim_student",
    "dim_course", "dim_academic_period", "dim_staff", "dim_geography", "fact_enrollment", "fact_student_gpa", "fact_registration_event",
)


def model_violations(t) -> DataFrame:
    """All declared rules over the model and the warehouse."""
    return constraints.violations(t, MODEL_TABLES)


def _damaged(t):
    """The model with rows that break a rule of every kind."""
    student, course = t["student"], t["course"]
    suspended = F.col("enrollment_status") == "Suspended"
    moved = F.when(F.col("current_level_id") == 1, F.col("programme_id") + 1000).otherwise(F.col("programme_id"))
    return _with(
        t,
        student=student.withColumns({"email": F.col("state_of_origin"), "gender": F.when(suspended, "Unknown").otherwise(F.col("gender")), "programme_id": moved}),
        course=course.withColumns({"level_id": F.col("level_id") + 3, "course_title": F.when(~F.col("is_compulsory_se"), F.col("course_title"))}),
        semester=t["semester"].withColumn("reg_deadline", F.when(F.col("is_current"), F.date_add("end_date", 1)).otherwise(F.col("reg_deadline"))),
        course_registration=t["course_registration"].withColumn(
            "registration_status", F.when(F.col("registration_status") == "Dropped", "Cancelled").otherwise(F.col("registration_status"))
        ),
        course_prerequisite=t["course_prerequisite"].withColumn("required_course_id", F.col("course_id")),
        course_result=t["course_result"].withColumn("remark", F.when(F.col("remark") != "Absent", F.col("remark"))),
    )


def constraint_violations(t) -> DataFrame:
    """All declared rules over a damaged model, counted per rule."""
    found = model_violations(_damaged(t))
    return found.groupBy("rule").agg(F.count("*").alias("keys"), F.sum("violations").alias("violations"))


CHECK_DATES = (date(1996, 1, 1), date(1999, 1, 1), CHECK_DATE)


def _check_log(t) -> DataFrame:
    """What checks at three dates logged."""
    runs = [(n, datetime(d.year, d.month, d.day), quality.run_checks(t, d)) for n, d in enumerate(CHECK_DATES, 1)]
    return adhoc.checks_logged(runs)


def failed_checks(t) -> DataFrame:
    return adhoc.failed_checks(_check_log(t)).select("checked_at", "etl_run_id", "check_name", "severity", "records_flagged", "detail")


def check_log_violations(t) -> DataFrame:
    """Rules of the check log, on one whose warnings carry a severity that does not exist and whose errors have no detail."""
    log = _check_log(t).withColumn("severity", F.when(F.col("severity") == "WARNING", "NOTICE").otherwise(F.col("severity")))
    found = constraints.violations({"dq_check_log": log}, ["dq_check_log"])
    return found.groupBy("rule").agg(F.count("*").alias("keys"), F.sum("violations").alias("violations"))


def run_change(t) -> tuple[Mapping[str, DataFrame], dict[str, DataFrame], dict[str, DataFrame]]:
    """The model with prerequisites on themselves, and the rows that a run takes out and puts in: it repairs half of the
    prerequisites, breaks statuses and remarks, drops programmes that have students and repeats staff numbers."""
    wrong = t["course_prerequisite"].withColumn("required_course_id", F.col("course_id"))
    dropped, absent = t["course_registration"].where("registration_status = 'Dropped'"), t["course_result"].where("remark = 'Absent'")
    removed = {
        "course_prerequisite": wrong.where("prerequisite_id % 2 = 0"), "course_registration": dropped, "course_result": absent,
        "programme": t["programme"].where("programme_id % 10 = 3"),
    }
    added = {
        "course_prerequisite": t["course_prerequisite"].where("prerequisite_id % 2 = 0"),
        "course_registration": dropped.withColumn("registration_status", F.lit("Cancelled")),
        "course_result": absent.withColumn("remark", F.lit(None).cast("string")),
        "staff": t["staff"].where("staff_id % 10 = 0").withColumn("staff_id", F.col("staff_id") + 1_000_000_000),
    }
    return _with(t, course_prerequisite=wrong), removed, added


def violations_of_run(t) -> DataFrame:
    """What a run breaks and mends, from the keys it touches."""
    found = constraints.changed_violations(*run_change(t), MODEL_TABLES)
    return found.groupBy("rule").agg(F.count("*").alias("keys"), F.sum("before").alias("before"), F.sum("after").alias("after"))


# --- visibility ---------------------------------------------------------------


def _visible(user: str):
    return lambda t: security.visible_rows(t["student"], t["security_user_map"], user, t).select("student_id", "student_matric_no")


def rls_child_rows(t) -> DataFrame:
    """Registrations of the students a lecturer sees."""
    rows = security.visible_rows(t["course_registration"], t["security_user_map"], "lecturer_five", t)
    return rows.groupBy("semester_id").agg(F.count("*").alias("registrations"), F.count_distinct("student_id").alias("students"))


def rls_block(t) -> DataFrame:
    """Writes to active students that a faculty administrator may not make."""
    writes = t["student"].where("enrollment_status = 'Active'").select("student_id")
    return security.blocked_writes(writes, t["security_user_map"], "fadmin_two", t)


# --- registration -------------------------------------------------------------


def _requests(t) -> DataFrame:
    """A request per event: some for a closed semester, some for an unknown one, many repeated."""
    digit = F.col("event_id") % 10
    return t.raw("events").select(
        F.col("event_id").alias("request_id"),
        F.col("event_id").alias("sequence"),
        F.col("user_id").alias("student_id"),
        F.floor("value").cast("bigint").alias("course_id"),
        F.when(digit == 0, F.lit(20012)).when(digit == 1, F.lit(20999)).otherwise(semester_of(F.col("ts"))).cast("bigint").alias("semester_id"),
        F.lit("ELECTIVE").alias("course_type"),
        F.col("ts").alias("requested_at"),
    )


def _validated(t, cap: int | None) -> DataFrame:
    return registration.validate_registrations(
        _requests(t), t["semester"], t["course"], t["course_prerequisite"], t["course_registration"], t["course_result"], cap
    ).select("request_id", "message", "rejection_reason", "was_late", "prereqs_failed")


def registration_validation(t) -> DataFrame:
    return _validated(t, None)


def registration_cap_greedy(t) -> DataFrame:
    return _validated(t, bands.MAX_UNITS)


def promote_students(t) -> DataFrame:
    return registration.promote_students(
        t["student"], 2000, t["student"], t["student_level"], t["course_registration"], t["course_result"], t["course"], t["semester"]
    )


def promoted_levels(t) -> DataFrame:
    """Students per level after promotion, and the level history written."""
    promotions = stored(promote_students(t), "promoted")
    history = dims.empty(t.spark, "student_level_history")
    students, written = registration.apply_promotions(promotions, t["student"], history, LOAD_TIME)
    after = students.groupBy(F.col("current_level_id").alias("level_id")).agg(F.count("*").alias("students"))
    records = written.groupBy("level_id").agg(F.count("*").alias("records"), F.sum("total_credits_earned").alias("credits"))
    return after.join(records, "level_id", "left")


# --- orchestration ------------------------------------------------------------

HALF_WAY, COMPLETE = datetime(1998, 6, 30), datetime(2030, 1, 1)


def _clean(t):
    """The source with whole scores, so that grades fit their bands."""
    whole = F.floor("total_score").cast("decimal(6,2)")
    return _with(t, course_result=t["course_result"].withColumn("total_score", whole))


def _as_it_was(t, day: datetime):
    """The source at ``day``: students were not suspended yet by changes made later."""
    later = F.col("updated_at") > F.lit(day).cast("timestamp_ntz")
    students = t["student"].withColumn("enrollment_status", F.when(later, "Active").otherwise(F.col("enrollment_status")))
    return _with(t, student=students.withColumn("updated_at", F.when(later, F.col("created_at")).otherwise(F.col("updated_at"))))


_loaded: dict[tuple[str, str], tuple[dict[str, DataFrame], dict[str, DataFrame]]] = {}


def two_runs(t) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """What a fresh warehouse holds after a first and after a second increment; loaded once per session and source."""
    key = (t.spark.sparkContext.applicationId, t.raw_dir)
    if key not in _loaded:
        store = Store(t.spark, fresh_folder(t.spark, "warehouse"))
        source, options = _clean(t), {"calendar": t["dim_date"], "geography": t["dim_geography"], "unit_limit": 1_000_000}
        pipeline.run_incremental(store, _as_it_was(source, HALF_WAY), HALF_WAY, **options)
        half = pipeline.published(store)
        pipeline.run_incremental(store, source, COMPLETE, **options)
        _loaded[key] = half, pipeline.published(store)
    return _loaded[key]


def incremental_equals_full_enrollment(t) -> DataFrame:
    """All enrolments after two increments, semester and course rows stamped past the first one included."""
    loaded = two_runs(t)[1]
    return _enrollment_by_keys(loaded["fact_enrollment"], loaded)


def incremental_equals_full_events(t) -> DataFrame:
    return fact_registration_event(two_runs(t)[1])


def fact_student_gpa_as_of(t) -> DataFrame:
    """GPA rows after the first increment: only results known by then count."""
    half = two_runs(t)[0]
    rows = facts.with_student_id(half["fact_student_gpa"]).withColumnRenamed("period_sk", "semester_id")
    return rows.select("student_id", "semester_id", "session_gpa", "cgpa", "total_credits_attempted", "total_credits_earned", "courses_registered")


def update_by_keys(t) -> DataFrame:
    """Registrations whose result is a fail are set to repeated, unless they were dropped."""
    failed = t["course_result"].where("remark = 'Fail'").select("registration_id")
    rows = load.update_by_keys(
        t["course_registration"], failed, ["registration_id"], {"registration_status": F.lit("Repeat")}, F.col("registration_status") != "Dropped")
    return rows.groupBy("semester_id", "registration_status").agg(F.count("*").alias("registrations"))


def with_defaults(t) -> DataFrame:
    """Results without a remark or an origin get the defaults."""
    rows = t["course_result"].select("remark", "credit_units_earned").withColumn("remark", F.when(F.col("remark") != "Absent", F.col("remark")))
    filled = load.with_defaults(rows, {"remark": "Pending", "entered_by": "registry"})
    return filled.groupBy("remark", "entered_by").agg(F.count("*").alias("results"), F.sum("credit_units_earned").alias("units"))


def distinct_students(t) -> DataFrame:
    """Distinct students per department and period, per department and over all, from the bitmaps that two loads left."""
    kept = two_runs(t)[1]["period_students"]
    counts = [rollup.distinct_counts(kept, keys, "students") for keys in (("department_name", "period_sk"), ("department_name",), ())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts).select("department_name", F.col("period_sk").alias("semester_id"), "students")


def versions_from_late_changes(t) -> DataFrame:
    """Versions of each user's event type, built from a third of the events and then from the others, each batch out of order."""
    events = t.raw("events").select("user_id", "ts", "event_type", "event_id")
    batch = lambda n: events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == n)
    columns = ("user_id", "ts", ["event_type"], "event_id")
    kept = temporal.merge_changes(events.limit(0).select("user_id", F.col("ts").alias("valid_from"), F.col("ts").alias("valid_to"), "event_type", "event_id"), batch(0), *columns)
    for n in (1, 2):
        kept = temporal.merge_changes(stored(kept, "versions"), batch(n), *columns)
    open_ = F.year("valid_to") == 9999
    length = F.timestamp_diff("SECOND", "valid_from", "valid_to")
    return kept.groupBy("user_id", "event_type").agg(
        F.count("*").alias("versions"), F.count_if(open_).alias("open"), F.sum(F.when(~open_, length)).alias("seconds")
    )


def watermark_advance(t) -> DataFrame:
    """The marks after both increments: loaded entities at the second end, the others as they were."""
    marks = two_runs(t)[1]["etl_watermark"]
    return marks.groupBy(F.date_format("last_extracted_at", "yyyy-MM-dd").alias("mark")).agg(F.count("*").alias("entities"))


def run_counters(t) -> DataFrame:
    """Rows the first run counted as inserted beside the rows it left."""
    half = two_runs(t)[0]
    log = half["etl_log"].where("etl_run_id = 1").select(F.col("rows_inserted").alias("inserted"))
    names = ("dim_student", "dim_course", "dim_staff", "dim_academic_period", "fact_enrollment", "fact_student_gpa", "fact_registration_event")
    left = adhoc.row_counts(half, names).agg(F.sum("rows").alias("inserted"))
    return log.select(F.lit("counted").alias("what"), "inserted").unionByName(left.select(F.lit("stored").alias("what"), "inserted"))


def run_incremental(t) -> DataFrame:
    """What two increments leave: rows per table and rows that are current, with the state of the runs."""
    loaded = two_runs(t)[1]
    names = ("dim_academic_period", "dim_course", "dim_staff", "dim_student", "fact_enrollment", "fact_student_gpa", "fact_registration_event")
    counts = adhoc.row_counts(loaded, names)
    current = scd2.current_rows(loaded["dim_student"]).agg(F.count("*").alias("rows")).select(F.lit("current students").alias("table_name"), "rows")
    runs = loaded["etl_log"].groupBy(F.concat(F.lit("runs "), F.col("status")).alias("table_name")).agg(F.count("*").alias("rows"))
    closed = loaded["etl_log"].select(F.lit("closed by the last run").alias("table_name"), F.col("scd2_rows_closed").alias("rows"), "etl_run_id")
    return counts.unionByName(current).unionByName(runs).unionByName(closed.where("etl_run_id = 2").drop("etl_run_id"))


def load_outcomes(t) -> DataFrame:
    """A load of the source as it is, under the real limits, that errors block, beside two that go on with warnings."""
    store = Store(t.spark, fresh_folder(t.spark, "blocked"))
    try:
        pipeline.run_incremental(store, t, COMPLETE)
    except pipeline.LoadBlocked:
        pass
    blocked = pipeline.run_log(store).select(F.lit("as it is").alias("source"), "etl_run_id", "status", "dq_errors", "dq_warnings")
    loaded = two_runs(t)[1]["etl_log"].select(F.lit("cleaned").alias("source"), "etl_run_id", "status", "dq_errors", "dq_warnings")
    return blocked.unionByName(loaded)


def student_registration_summary(t) -> DataFrame:
    return views.student_registration_summary(t, READ_DATE)


CATALOG = {
    **reports.REPORTS,
    **{f.__name__: f for f in (
        seed_key_resolution, calendar_attributes, incremental_extract, type1_upsert, replace_affected_keys, idempotent_append,
        case_bands, enrollment_flags, optional_dim_lookup, prereq_counts, anti_join_orphans, asof_dim_lookup, weighted_gpa,
        running_cgpa, running_cgpa_weighted, running_cgpa_after_late_results, faculty_performance_at_registration, fact_enrollment, fact_enrollment_fanout,
        fact_student_gpa, fact_registration_event, dim_student, scd2_first_load, scd2_second_load, scd2_counts, scd2_current,
        version_history, version_by_surrogate, versions_from_changes, versions_from_timestamps, system_time_as_of, system_time_between,
        system_time_all, dq_checks, dq_gate, dq01, dq02, dq03, dq04, dq05, dq06, dq07_duplicates, dq07_case_insensitive, dq08, dq09_grade_range, dq10,
        raw_constraint_violations, constraint_violations, failed_checks, check_log_violations, violations_of_run, load_outcomes, distinct_students, versions_from_late_changes, rls_child_rows, rls_block, registration_validation,
        registration_cap_greedy, promote_students, promoted_levels, run_incremental, student_registration_summary, incremental_equals_full_enrollment,
        incremental_equals_full_events, fact_student_gpa_as_of, update_by_keys, with_defaults, watermark_advance, run_counters,
    )},
    "credit_load_exact": lambda t: reports.credit_load_distribution(t, integer_average=False),
    "faculty_performance_durable": lambda t: reports.faculty_performance(t, durable_key=True),
    "dim_date": lambda t: t["dim_date"],
    "dim_academic_period": lambda t: t["dim_academic_period"].drop("period_sk"),
    "dim_course": lambda t: t["dim_course"].drop("course_sk", "dw_created_at", "dw_updated_at"),
    "dim_staff": lambda t: t["dim_staff"].drop("staff_sk", "dw_created_at"),
    "snowflake_flatten": lambda t: dims.student_snapshot(t),
    "snowflake_changed": lambda t: dims.student_snapshot(t, datetime(1999, 1, 1)).select("student_id", "faculty_name", "level_name"),
    "watermark_pivot": lambda t: extract.pivot_watermarks(t["etl_watermark"]),
    "zone_distribution": adhoc.zone_distribution,
    "student_transcript": views.student_transcript,
    "ser001_compliance": views.ser001_compliance,
    "prereq_chain": views.course_prereq_chain,
    "student_courses": lambda t: views.student_courses(t, "Customer#000000007", 19981),
    "transcript": lambda t: views.transcript(t, "Customer#000000007"),
    "latest_session_filter": lambda t: adhoc.latest_session_filter(t, date(2001, 12, 31)),
    "topk_departments": lambda t: adhoc.topk_departments(t, "2000/2001"),
    "yoy_gpa_trend": reports.yoy_gpa_trend,
    "faculty_avg_point": adhoc.faculty_avg_point,
    "flagged_courses": adhoc.flagged_courses,
    "high_failure_courses": adhoc.high_failure_courses,
    "critical_students": adhoc.critical_students,
    "latest_registering_faculties": adhoc.latest_registering_faculties,
    "noncompliant_students": lambda t: views.ser001_compliance(t).where("ser001_status = 'NOT Registered'"),
    "student_trend": lambda t: adhoc.student_trend(t, "Customer#000000007"),
    "semester_timeline": lambda t: adhoc.semester_timeline(t, "2000/2001", "First"),
    "last_runs": adhoc.last_runs,
    "run_history": adhoc.run_history,
    "run_status_histogram": adhoc.run_status_histogram,
    "row_counts": lambda t: adhoc.row_counts(t, MODEL_TABLES),
    "rls_student": _visible("student_seven"),
    "rls_lecturer": _visible("lecturer_five"),
    "rls_faculty_admin": _visible("fadmin_two"),
    "rls_registry": _visible("registry_admin"),
    "rls_unmapped": _visible("nobody"),
}
