"""Batch validation of course registrations, and promotion of students.

Registration rules run in order: valid semester, deadline, not yet
registered, unit limit, prerequisites.  Requests are taken in request order
per (student, semester); a rejected request uses no units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bands import MAX_UNITS
from ..functions.exact import decimal_ratio
from ..session import stored
from .load import type1_upsert

# Messages of the procedures.
INVALID_SEMESTER = "ERROR: Invalid semester."
DEADLINE_PASSED = "ERROR: Registration deadline has passed."
ALREADY_REGISTERED = "ERROR: Already registered for this course."
OVER_LIMIT = "ERROR: Registration would exceed {cap} credit unit maximum."
PREREQUISITES = "prerequisite(s) not satisfied."
REGISTERED = "SUCCESS: Course registered successfully."
UNKNOWN_COURSE = "ERROR: Unknown course."
AUDIT_DEADLINE = "Registration deadline passed"
AUDIT_PREREQUISITES = "Prerequisites not satisfied"
AT_TOP_LEVEL = "INFO: Student at maximum level — eligible for graduation."

REQUEST = ["student_id", "course_id", "semester_id"]
GROUP = ["student_id", "semester_id"]


def rule_deadline(requests: DataFrame, semester: DataFrame) -> DataFrame:
    """Adds ``valid_semester`` and ``late``; ``requested_at`` is compared by day."""
    known = semester.select("semester_id", "reg_deadline")
    return (
        requests.join(F.broadcast(known), "semester_id", "left")
        .withColumn("valid_semester", F.col("reg_deadline").isNotNull())
        .withColumn("late", F.coalesce(F.col("requested_at").cast("date") > F.col("reg_deadline"), F.lit(False)))
        .drop("reg_deadline")
    )


def rule_duplicate(requests: DataFrame, registration: DataFrame) -> DataFrame:
    """Adds ``registered``: the same student, course and semester is present in any status."""
    held = registration.join(requests.select(*REQUEST).distinct(), REQUEST, "left_semi")
    held = held.select(*REQUEST).distinct().withColumn("registered", F.lit(True))
    return requests.join(held, REQUEST, "left").fillna(False, ["registered"])


def rule_prerequisites(requests: DataFrame, prerequisite: DataFrame, registration: DataFrame, result: DataFrame) -> DataFrame:
    """Adds ``unmet``: attempts at required courses without a grade or with a worse one, none at all counting once.

    Attempts are folded to one row per (student, course, grade) before they
    meet the requests.
    """
    needs = prerequisite.select("course_id", "required_course_id", "min_grade")
    wanted = requests.select("student_id", "course_id").distinct().join(needs, "course_id")
    pairs = wanted.select("student_id", F.col("required_course_id").alias("course_id")).distinct()
    attempts = (
        registration.join(pairs, ["student_id", "course_id"], "left_semi")
        .select("registration_id", "student_id", F.col("course_id").alias("required_course_id"))
        .join(result.select("registration_id", "grade"), "registration_id", "left")
        .groupBy("student_id", "required_course_id", "grade")
        .agg(F.count("*").alias("attempts"))
    )
    worse = F.col("grade").isNull() | (F.col("grade") > F.col("min_grade"))
    unmet = (
        wanted.join(attempts, ["student_id", "required_course_id"], "left")
        .where(worse)
        .groupBy("student_id", "course_id")
        .agg(F.sum(F.coalesce("attempts", F.lit(1))).alias("unmet"))
    )
    return requests.join(unmet, ["student_id", "course_id"], "left").fillna(0, ["unmet"])


def existing_units(requests: DataFrame, registration: DataFrame, course: DataFrame) -> DataFrame:
    """Units each requesting (student, semester) holds already, whatever the status."""
    return (
        registration.join(requests.select(*GROUP).distinct(), GROUP, "left_semi")
        .join(course.select("course_id", "credit_units"), "course_id")
        .groupBy(*GROUP)
        .agg(F.sum("credit_units").alias("held"))
    )


def rule_unit_cap(candidates: DataFrame, cap: int = MAX_UNITS) -> DataFrame:
    """Greedy unit limit: per (student, semester) the accepted steps in request order.

    ``candidates`` have request_id, sequence, units and held, and meet every
    other rule.  Once a request of u units does not fit, no later one of u
    units does, so at most cap / u of each size can be accepted and only that
    many are looked at; a group shrinks to a few dozen rows whatever its size,
    and the result is that of taking the requests one by one.  Requests of no
    units use nothing and are left to the caller.
    """
    same_size = Window.partitionBy(*GROUP, "units").orderBy("sequence", "request_id")
    possible = (
        candidates.where(F.col("units") > 0)
        .withColumn("rank", F.row_number().over(same_size))
        .where(F.col("rank") <= cap)
        .where(F.col("rank") * F.col("units") <= cap)
    )
    step = F.struct(F.col("sequence"), F.col("request_id"), F.col("units").cast("long").alias("units"))
    steps = possible.groupBy(*GROUP).agg(
        F.first("held").alias("held"), F.array_sort(F.collect_list(step)).alias("steps")
    )
    accepted_type = "array<struct<sequence:{s},request_id:{r},load:bigint>>".format(
        s=candidates.schema["sequence"].dataType.simpleString(), r=candidates.schema["request_id"].dataType.simpleString()
    )

    def take(state: Column, request: Column) -> Column:
        load = state["load"] + request["units"]
        step = F.struct(request["sequence"].alias("sequence"), request["request_id"].alias("request_id"), load.alias("load"))
        grown = F.concat(state["taken"], F.array(step))
        return F.when(load <= cap, F.struct(load.alias("load"), grown.alias("taken"))).otherwise(state)

    start = F.struct(F.col("held").cast("long").alias("load"), F.array().cast(accepted_type).alias("taken"))
    return steps.select(*GROUP, F.aggregate("steps", start, take)["taken"].alias("taken"))


def judge_rules(
    requests: DataFrame, semester: DataFrame, course: DataFrame, prerequisite: DataFrame, registration: DataFrame, result: DataFrame
) -> DataFrame:
    """Requests with the outcome of every rule that does not depend on other requests."""
    units = course.select("course_id", F.col("credit_units").alias("units"), F.lit(True).alias("known_course"))
    ruled = rule_deadline(requests, semester)
    ruled = rule_duplicate(ruled, registration)
    ruled = rule_prerequisites(ruled, prerequisite, registration, result)
    ruled = ruled.join(units, "course_id", "left")
    return ruled.join(existing_units(requests, registration, course), GROUP, "left").fillna(0, ["held"])


def validate_registrations(
    requests: DataFrame,
    semester: DataFrame,
    course: DataFrame,
    prerequisite: DataFrame,
    registration: DataFrame,
    result: DataFrame,
    cap: int | None = MAX_UNITS,
) -> DataFrame:
    """One row per request with ``message`` and, for audited rejections, the audit columns.

    ``requests``: request_id (unique), student_id, course_id, semester_id,
    course_type, requested_at and sequence (order within the batch).  With
    ``cap=None`` the unit rule is left out.  The judged requests are stored
    once, since the batch is then read from several sides.
    """
    ruled = stored(judge_rules(requests, semester, course, prerequisite, registration, result), "requests")

    # Only the first eligible request for a course can be accepted; a repeat of an accepted one is a duplicate.
    eligible = F.col("valid_semester") & ~F.col("late") & ~F.col("registered") & (F.col("unmet") == 0) & F.col("known_course")
    first = ruled.where(eligible).groupBy(*REQUEST).agg(
        F.min(F.struct("sequence", "request_id")).alias("first"), F.first("units").alias("units"), F.first("held").alias("held")
    )
    judged = ruled.join(first.select(*REQUEST, F.col("first.request_id").alias("first_request")), REQUEST, "left")
    if cap is None:
        taken, over = F.col("first_request").isNotNull(), F.lit(False)
    else:
        judged = judged.join(rule_unit_cap(first.select(*REQUEST, "first.*", "units", "held"), cap), GROUP, "left")
        fits = F.exists("taken", lambda s: s["request_id"] == F.col("first_request"))
        free = F.col("first_request").isNotNull() & (F.col("units") == 0) & (F.col("held") <= cap)
        taken = F.coalesce(fits, F.lit(False)) | free
        earlier = F.filter("taken", lambda s: F.struct(s["sequence"], s["request_id"]) < F.struct("sequence", "request_id"))
        load = F.coalesce(F.try_element_at(earlier, F.lit(-1))["load"], F.col("held").cast("long"))
        over = F.coalesce(load + F.col("units") > cap, F.lit(False))
    repeat = taken & (F.col("first_request") != F.col("request_id"))
    message = (
        F.when(~F.col("valid_semester"), INVALID_SEMESTER)
        .when(F.col("late"), DEADLINE_PASSED)
        .when(F.col("registered") | repeat, ALREADY_REGISTERED)
        .when(over & ~taken, OVER_LIMIT.format(cap=cap))
        .when(F.col("unmet") > 0, F.concat_ws(" ", F.lit("ERROR:"), F.col("unmet").cast("string"), F.lit(PREREQUISITES)))
        .when(F.col("known_course").isNull(), UNKNOWN_COURSE)
        .otherwise(REGISTERED)
    )
    reason = F.when(F.col("message") == DEADLINE_PASSED, AUDIT_DEADLINE).when(
        F.col("message").endswith(PREREQUISITES), AUDIT_PREREQUISITES
    )
    return judged.withColumn("message", message).select(
        *requests.columns,
        "message",
        (F.col("message") == REGISTERED).alias("accepted"),
        reason.alias("rejection_reason"),
        F.when(reason.isNotNull(), F.col("message") == DEADLINE_PASSED).alias("was_late"),
        F.when(reason == AUDIT_PREREQUISITES, F.col("unmet")).when(reason.isNotNull(), 0).alias("prereqs_failed"),
    )


def accepted_registrations(validated: DataFrame) -> DataFrame:
    """The registrations to append, without an identifier."""
    return validated.where("accepted").select(
        *REQUEST,
        F.col("requested_at").alias("registration_date"),
        F.lit("Registered").alias("registration_status"),
        F.col("course_type").alias("course_type_taken"),
        F.col("requested_at").alias("updated_at"),
    )


def audit_rows(validated: DataFrame) -> DataFrame:
    """The audited rejections: missed deadlines and unmet prerequisites."""
    return validated.where(F.col("rejection_reason").isNotNull()).select(
        *REQUEST, F.col("requested_at").alias("attempt_time"), "was_late", "prereqs_failed", "rejection_reason"
    )


def session_gpa(
    registration: DataFrame, result: DataFrame, course: DataFrame, semester: DataFrame, students: DataFrame | None = None
) -> DataFrame:
    """Per (student, session): units attempted and earned, course counts by outcome, unit-weighted GPA.

    With ``students`` (distinct student_id) of these alone; they are met last, since the sums then need no further shuffle.
    """
    remark = lambda r: F.count_if(F.col("remark") == r)
    weighted = (F.col("grade_point") * 10).cast("long") * F.col("credit_units")
    rows = (
        result.select("registration_id", "grade_point", "credit_units_earned", "remark")
        .join(registration.select("registration_id", "student_id", "course_id", "semester_id"), "registration_id")
        .join(course.select("course_id", "credit_units"), "course_id")
        .join(F.broadcast(semester.select("semester_id", "session_id")), "semester_id")
    )
    if students is not None:
        rows = rows.join(students, "student_id")
    return (
        rows.groupBy("student_id", "session_id")
        .agg(
            F.sum("credit_units").alias("credits_attempted"),
            F.sum("credit_units_earned").alias("credits_earned"),
            F.count("*").alias("courses_registered"),
            remark("Pass").alias("courses_passed"),
            remark("Fail").alias("courses_failed"),
            remark("Absent").alias("courses_absent"),
            F.sum(weighted).alias("_tenths"),
        )
        .withColumn("session_gpa", decimal_ratio(F.col("_tenths"), F.col("credits_attempted") * 10, 2))
        .drop("_tenths")
    )


def promote_students(
    candidates: DataFrame, session_id: int, student: DataFrame, level: DataFrame,
    registration: DataFrame, result: DataFrame, course: DataFrame, semester: DataFrame,
) -> DataFrame:
    """One row per candidate: old and new level, GPA and units of the session, message.

    The next level is the one numbered 100 higher; without one the student is
    left as is.  There is no pass condition.
    """
    in_session = semester.where(F.col("session_id") == session_id)
    chosen = candidates.select("student_id").distinct()
    mine = registration.join(chosen, "student_id", "left_semi")
    gpa = session_gpa(mine, result, course, in_session).select("student_id", "session_gpa", "credits_earned")
    now = level.select(F.col("level_id").alias("current_level_id"), "level_number")
    following = level.select((F.col("level_number") - 100).alias("level_number"), F.col("level_id").alias("new_level_id"))
    placed = (
        chosen.join(student.select("student_id", "current_level_id"), "student_id", "left")
        .join(now, "current_level_id", "left")
        .join(following, "level_number", "left")
        .join(gpa, "student_id", "left")
    )
    promoted = F.concat(
        F.lit("SUCCESS: Promoted to "), (F.col("level_number") + 100).cast("string"), F.lit("L. GPA: "),
        F.coalesce(F.col("session_gpa").cast("string"), F.lit("")),
    )
    return placed.select(
        "student_id",
        F.lit(session_id).cast("bigint").alias("session_id"),
        "level_number",
        "new_level_id",
        F.col("session_gpa").alias("gpa"),
        F.coalesce("credits_earned", F.lit(0)).alias("total_credits_earned"),
        F.when(F.col("new_level_id").isNull(), AT_TOP_LEVEL).otherwise(promoted).alias("message"),
    )


def apply_promotions(promotions: DataFrame, student: DataFrame, history: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """New student table and new level history (one row per student and session)."""
    moved = stored(promotions.where(F.col("new_level_id").isNotNull()), "promotions")
    stamp = F.lit(now).cast("timestamp_ntz")
    student = type1_upsert(
        student, moved.select("student_id", F.col("new_level_id").alias("current_level_id"), stamp.alias("updated_at")), "student_id"
    )
    rows = moved.select(
        "student_id", "session_id", F.col("new_level_id").alias("level_id"), "gpa", F.col("gpa").alias("cgpa"), "total_credits_earned"
    )
    key = F.struct("student_id", "session_id").alias("_key")
    keyed = type1_upsert(
        history.select(key, "*"), rows.select(key, "*", stamp.alias("recorded_at")), "_key", update=rows.columns
    )
    return student, keyed.drop("_key")


