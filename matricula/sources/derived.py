"""The records model over the given star-schema files: each source table as a plan over raw Parquet.

customer -> student, part -> course, lineitem with orders -> registrations
and results, supplier -> staff, nation and region -> departments, faculties
and states, events -> rejected attempts and run log.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.temporal import versions_from_changes
from ..schemas import schema_of
from ..session import buckets
from . import reference_data as ref

CURRENT_SEMESTER = 20012
DEADLINE_DAYS = 90
PASS_SCORE = 40  # fixed value: lowest passing score
FIRST_ADMISSION = 1995
CHANGE_EPOCH = "1996-01-01"
CHANGE_SPAN = 1461
BASE_STAMP = "1995-01-01 00:00:00"


def semester_of(moment: Column) -> Column:
    return (F.year(moment) * 10 + F.when(F.month(moment) <= 6, 1).otherwise(2)).cast("bigint")


def registration_key(order: Column, part: Column) -> Column:
    """Exact identifier of an (order, part) pair: 19 digits each."""
    return order.cast("decimal(19,0)") * F.lit(Decimal(10) ** 19) + part.cast("decimal(19,0)")


def grade_for(total: Column) -> Column:
    """Best band whose lowest score is reached."""
    return _band(total, 0)


def points_for(total: Column) -> Column:
    return _band(total, 3)


def _band(total: Column, field: int) -> Column:
    reached = F.when(F.lit(False), F.lit(None))
    for band in ref.GRADE_SCALE:
        reached = reached.when(total >= band[1], F.lit(band[field]))
    return reached


def _stamp(text: str = BASE_STAMP) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _changed_on(key: str) -> Column:
    day = F.date_add(F.lit(CHANGE_EPOCH).cast("date"), F.pmod(F.col(key), F.lit(CHANGE_SPAN)).cast("int"))
    return day.cast("timestamp_ntz")


def _positions(values: DataFrame, column: str) -> DataFrame:
    """Codes of a closed code list with their position in alphabetical order."""
    codes = values.select(column).distinct().agg(F.array_sort(F.collect_set(column)).alias("codes"))
    return codes.select(F.posexplode("codes").alias("position", column))


# --- institutional structure -------------------------------------------------


def faculty(t) -> DataFrame:
    return t.raw("region").select(
        F.col("r_regionkey").alias("faculty_id"),
        F.col("r_name").alias("faculty_name"),
        F.substring("r_name", 1, 3).alias("abbreviation"),
        _stamp().alias("updated_at"),
    )


def department(t) -> DataFrame:
    return t.raw("nation").select(
        F.col("n_nationkey").alias("department_id"),
        F.col("n_regionkey").alias("faculty_id"),
        F.col("n_name").alias("department_name"),
        F.col("n_name").alias("abbreviation"),
        _stamp().alias("updated_at"),
    )


def college(t) -> DataFrame:
    one = t.raw("region").where("r_regionkey = 0")
    return one.select(F.lit(1).alias("college_id"), F.col("r_name").alias("college_name"), _stamp().alias("updated_at"))


def geography(t) -> DataFrame:
    nation, region = t.raw("nation"), t.raw("region")
    half = F.when(F.col("r_regionkey") < 3, "North").otherwise("South")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("geo_sk"),
        F.col("n_name").alias("state_name"),
        F.col("r_name").alias("geopolitical_zone"),
        half.alias("region"),
    )


def segment(t) -> DataFrame:
    return _positions(t.raw("customer"), "c_mktsegment")


def programme(t) -> DataFrame:
    pairs = t.raw("customer").select("c_nationkey", "c_mktsegment").distinct()
    nation = t.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return pairs.join(t["segment"], "c_mktsegment").join(nation, "c_nationkey").select(
        (F.col("c_nationkey") * 100 + F.col("position")).alias("programme_id"),
        F.col("c_nationkey").alias("department_id"),
        (F.col("position") + 1).alias("degree_type_id"),
        F.concat_ws(" ", "n_name", "c_mktsegment").alias("programme_name"),
        F.lit(4).alias("duration_years"),
        _stamp().alias("updated_at"),
    )


# --- calendar ----------------------------------------------------------------


def semester(t) -> DataFrame:
    moments = t.raw("orders").select(semester_of(F.col("o_orderdate")).alias("semester_id"))
    attempts = t.raw("events").where("event_type = 'error'").select(semester_of(F.col("ts")).alias("semester_id"))
    year, half = F.expr("cast(semester_id div 10 as int)"), F.col("semester_id") % 10
    start = F.when(half == 1, F.make_date(year, F.lit(1), F.lit(1))).otherwise(F.make_date(year, F.lit(7), F.lit(1)))
    end = F.when(half == 1, F.make_date(year, F.lit(6), F.lit(30))).otherwise(F.make_date(year, F.lit(12), F.lit(31)))
    return moments.distinct().unionByName(attempts.distinct()).distinct().select(
        "semester_id",
        year.alias("session_id"),
        F.when(half == 1, "First").otherwise("Second").alias("semester_name"),
        start.alias("start_date"),
        end.alias("end_date"),
        F.date_add(start, DEADLINE_DAYS).alias("reg_deadline"),
        (F.col("semester_id") == CURRENT_SEMESTER).alias("is_current"),
        start.cast("timestamp_ntz").alias("created_at"),
        start.cast("timestamp_ntz").alias("updated_at"),
    )


def academic_session(t) -> DataFrame:
    year = F.col("session_id").cast("int")
    return t["semester"].groupBy("session_id").agg(F.max("is_current").alias("is_current")).select(
        "session_id",
        F.concat_ws("/", year.cast("string"), (year + 1).cast("string")).alias("session_name"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("end_date"),
        "is_current",
        F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("created_at"),
        F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("updated_at"),
    )


# --- courses -----------------------------------------------------------------


def course_category(t) -> DataFrame:
    return _positions(t.raw("part"), "p_type").select(
        (F.col("position") + 1).alias("category_id"),
        F.col("p_type").alias("category_code"),
        F.col("p_type").alias("category_name"),
    )


def course(t) -> DataFrame:
    key = F.col("p_partkey")
    category = t["course_category"].select("category_id", F.col("category_code").alias("p_type"))
    code = F.when(key == 0, ref.COMPULSORY_CODE).otherwise(F.concat(F.lit("CRS"), key.cast("string")))
    offered = F.element_at(F.array(*[F.lit(x) for x in ("First", "Second", "Both")]), (key % 3 + 1).cast("int"))
    return t.raw("part").join(category, "p_type").select(
        key.alias("course_id"),
        (key % 25).alias("department_id"),
        "category_id",
        code.alias("course_code"),
        F.col("p_name").alias("course_title"),
        F.col("p_brand").alias("course_description"),
        (F.col("p_size") % 4 + 1).alias("credit_units"),
        (key % 5 + 1).alias("level_id"),
        offered.alias("semester_offered"),
        F.lit(True).alias("is_active"),
        (key % 50 == 0).alias("is_compulsory_se"),
        _stamp().alias("created_at"),
        _changed_on("p_partkey").alias("updated_at"),
    )


def course_prerequisite(t) -> DataFrame:
    key = F.col("p_partkey")
    return t.raw("part").where((key % 3 == 0) & (key > 0)).select(
        key.alias("prerequisite_id"),
        key.alias("course_id"),
        (key - 1).alias("required_course_id"),
        F.when(key % 2 == 0, "C").otherwise("E").alias("min_grade"),
    )


def programme_course(t) -> DataFrame:
    """Compulsory courses of a department's own courses, mapped to its programmes."""
    own = t["course"].where("is_compulsory_se").select("course_id", "department_id")
    number = F.shiftleft(F.col("programme_id").cast("bigint"), 32) + F.col("course_id")
    return t["programme"].select("programme_id", "department_id").join(own, "department_id").select(
        number.alias("programme_course_id"), "programme_id", "course_id", F.lit("COMPULSORY_SE").alias("course_type"), F.lit(True).alias("is_compulsory")
    )


# --- people ------------------------------------------------------------------


def _last_name(column: str) -> Column:
    return F.substring_index(F.col(column), "#", -1)


def _first_name(column: str) -> Column:
    return F.substring_index(F.col(column), "#", 1)


def student(t) -> DataFrame:
    key = F.col("c_custkey")
    state = t.raw("nation").select(F.col("n_nationkey").cast("bigint").alias("state_key"), "n_name")
    return t.raw("customer").withColumn("state_key", key * 7 % 25).join(state, "state_key").join(
        t["segment"], "c_mktsegment"
    ).select(
        key.alias("student_id"),
        F.col("c_name").alias("student_matric_no"),
        _first_name("c_name").alias("first_name"),
        _last_name("c_name").alias("last_name"),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(F.lower(_last_name("c_name")), F.lit("@students.example")).alias("email"),
        F.col("n_name").alias("state_of_origin"),
        (F.col("c_nationkey") * 100 + F.col("position")).alias("programme_id"),
        (key % 5 + 1).alias("current_level_id"),
        (key % 7 + FIRST_ADMISSION).alias("admission_session_id"),
        F.when(F.col("c_acctbal") < 0, "Suspended").otherwise("Active").alias("enrollment_status"),
        _stamp().alias("created_at"),
        _changed_on("c_custkey").alias("updated_at"),
    )


def staff(t) -> DataFrame:
    return t.raw("supplier").select(
        F.col("s_suppkey").alias("staff_id"),
        F.col("s_name").alias("staff_no"),
        _first_name("s_name").alias("first_name"),
        _last_name("s_name").alias("last_name"),
        F.col("s_nationkey").alias("department_id"),
        F.when(F.col("s_acctbal") >= 5000, "Professor").otherwise("Lecturer").alias("designation"),
        F.concat(F.lower(_last_name("s_name")), F.lit("@staff.example")).alias("email"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
        _changed_on("s_suppkey").alias("updated_at"),
    )


# --- registrations and results -----------------------------------------------


def by_key(rows: DataFrame, key: Column | str) -> DataFrame:
    """Rows dealt by the key that their table is stored by, one task a bucket."""
    return rows.repartition(buckets(rows.sparkSession), key)


def first_line(t) -> DataFrame:
    """First order line per (customer, part, semester), by an aggregate that combines before the shuffle; dealt by the
    registration that it stands for."""
    lines = t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus", "l_partkey"
    )
    orders = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    line = F.struct(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus", "o_orderdate"
    )
    first = (
        lines.join(orders, "l_orderkey")
        .groupBy("o_custkey", "l_partkey", semester_of(F.col("o_orderdate")).alias("semester_id"))
        .agg(F.min(line).alias("line"))
        .select("o_custkey", "l_partkey", "line.*")
    )
    # What follows from other columns is added once the rows are dealt.
    key = registration_key(F.col("l_orderkey"), F.col("l_partkey"))
    return by_key(first, key).withColumns({"semester_id": semester_of(F.col("o_orderdate")), "registration_id": key})


def course_registration(t) -> DataFrame:
    part = F.col("l_partkey")
    kind = F.when(part % 50 == 0, "COMPULSORY_SE").when(F.col("l_returnflag") == "N", "MAJOR").otherwise("ELECTIVE")
    return t["first_line"].select(
        "registration_id",
        F.col("o_custkey").alias("student_id"),
        part.alias("course_id"),
        "semester_id",
        F.col("o_orderdate").alias("registration_date"),
        F.when(F.col("l_linenumber") == 7, "Dropped").otherwise("Registered").alias("registration_status"),
        kind.alias("course_type_taken"),
        F.col("o_orderdate").alias("updated_at"),
    )


def course_result(t) -> DataFrame:
    part = F.col("l_partkey")
    units = t["course"].select(F.col("course_id").alias("l_partkey"), "credit_units")
    continuous = (F.col("l_quantity").cast("int") * F.lit(Decimal("0.6"))).cast("decimal(5,2)")
    exam = ((F.col("l_orderkey") * 3 + part * 7 + F.col("l_linenumber") * 11) % 71).cast("decimal(5,2)")
    absent = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1)
    # Moved by course and dealt by their key while the rows are narrow, without the long identifier that both parts of the
    # key make; the rest follows from these columns.
    scored = t["first_line"].where("l_linestatus = 'F'").select(
        "l_orderkey", "l_partkey", continuous.alias("ca_score"), exam.alias("exam_score"), absent.alias("absent"), "l_shipdate"
    )
    key = registration_key(F.col("l_orderkey"), F.col("l_partkey"))
    dealt = by_key(scored.join(units, "l_partkey"), key).withColumn("registration_id", key)
    total = F.col("ca_score") + F.col("exam_score")
    remark = F.when(F.col("absent"), "Absent").when(F.col("total_score") >= PASS_SCORE, "Pass").otherwise("Fail")
    graded = dealt.withColumn("total_score", total).withColumn("remark", remark)
    return graded.select(
        F.col("registration_id").alias("result_id"),
        "registration_id",
        "ca_score",
        "exam_score",
        "total_score",
        grade_for(F.col("total_score")).alias("grade"),
        points_for(F.col("total_score")).alias("grade_point"),
        F.when(F.col("remark") == "Pass", F.col("credit_units")).otherwise(0).alias("credit_units_earned"),
        "remark",
        F.col("l_shipdate").alias("entered_at"),
        F.col("l_shipdate").alias("updated_at"),
    )


def course_assignment(t) -> DataFrame:
    return t["first_line"].where("l_linenumber = 1").select(
        F.col("l_partkey").alias("course_id"), "semester_id", F.col("l_suppkey").alias("staff_id")
    ).distinct()


def registration_audit(t) -> DataFrame:
    courses = t.raw("part").agg(F.count("*").alias("n")).scalar()
    failed = (F.floor("value") % 3).cast("int")
    reason = F.when(failed == 0, "Registration deadline passed").otherwise("Prerequisites not satisfied")
    return t.raw("events").where("event_type = 'error'").select(
        F.col("event_id").alias("audit_id"),
        F.col("user_id").alias("student_id"),
        (F.col("event_id") % courses).alias("course_id"),
        semester_of(F.col("ts")).alias("semester_id"),
        F.col("ts").alias("attempt_time"),
        (failed == 0).alias("was_late"),
        failed.alias("prereqs_failed"),
        reason.alias("rejection_reason"),
    )


# --- history, security, run bookkeeping --------------------------------------


def student_change(t) -> DataFrame:
    """Dated changes of two tracked attributes: the last order of each customer and day."""
    day = F.col("o_orderdate").cast("date").alias("changed_on")
    last = F.max(F.struct("o_orderkey", "o_orderpriority", "o_orderstatus")).alias("last")
    return t.raw("orders").groupBy(F.col("o_custkey").alias("student_id"), day).agg(last).select(
        "student_id",
        "changed_on",
        F.col("last.o_orderpriority").alias("programme_name"),
        F.col("last.o_orderstatus").alias("enrollment_status"),
    )


def student_history(t) -> DataFrame:
    return versions_from_changes(t["student_change"], "student_id", "changed_on", ["programme_name", "enrollment_status"])


def security_user_map(t) -> DataFrame:
    rows = [
        ("student_seven", "student", 7, None),
        ("lecturer_five", "lecturer", 5, None),
        ("fadmin_two", "faculty_admin", None, 2),
        ("registry_admin", "registry_admin", None, None),
    ]
    return ref.literal_table(t.spark, rows, schema_of("security_user_map"))


def etl_watermark(t) -> DataFrame:
    """Latest change seen per entity."""
    marks = None
    for entity in ref.LOADED_ENTITIES:
        mark = t[entity].agg(F.max("updated_at").alias("last_extracted_at"), F.count("*").alias("last_row_count"))
        mark = mark.select(F.lit(entity).alias("entity_name"), "*", F.col("last_extracted_at").alias("updated_at"))
        marks = mark if marks is None else marks.unionByName(mark)
    return marks


def etl_log(t) -> DataFrame:
    """A run log from the event stream: one run per hour, counts by event type."""
    of = lambda kind: F.count_if(F.col("event_type") == kind)
    hours = t.raw("events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.min("ts").alias("run_started_at"),
        F.max("ts").alias("run_finished_at"),
        of("purchase").alias("rows_inserted"),
        of("click").alias("rows_updated"),
        of("signup").alias("scd2_rows_closed"),
        F.count_if((F.col("event_type") == "error") & (F.col("value") > 200)).alias("dq_errors"),
        F.count_if((F.col("event_type") == "view") & (F.col("value") > 100)).alias("dq_warnings"),
        F.count("*").alias("events"),
    )
    run_id = F.date_format("hour", "yyyyMMddHH").cast("bigint")
    status = (
        F.when(F.hour("hour") == 0, "RUNNING")
        .when(F.col("dq_errors") > 0, "FAILED")
        .when(F.col("events") % 7 == 0, "PARTIAL")
        .otherwise("SUCCESS")
    )
    runs = hours.withColumn("etl_run_id", run_id).withColumn("status", status)
    message = F.concat(F.col("dq_errors").cast("string"), F.lit(" DQ errors blocked the load."))
    return runs.withColumn("run_finished_at", F.when(F.col("status") != "RUNNING", F.col("run_finished_at"))).select(
        "*", F.when(F.col("status") == "FAILED", message).alias("error_message"), F.lit("scheduler").alias("triggered_by")
    )


BUILDERS = {
    "faculty": faculty,
    "department": department,
    "college": college,
    "segment": segment,
    "programme": programme,
    "degree_type": lambda t: ref.degree_type(t.spark),
    "student_level": lambda t: ref.student_level(t.spark),
    "grade_scale": lambda t: ref.grade_scale(t.spark),
    "semester": semester,
    "academic_session": academic_session,
    "course_category": course_category,
    "course": course,
    "course_prerequisite": course_prerequisite,
    "programme_course": programme_course,
    "student": student,
    "staff": staff,
    "first_line": first_line,
    "course_registration": course_registration,
    "course_result": course_result,
    "course_assignment": course_assignment,
    "registration_audit": registration_audit,
    "student_change": student_change,
    "student_history": student_history,
    "security_user_map": security_user_map,
    "etl_watermark": etl_watermark,
    "etl_log": etl_log,
    "dim_geography": geography,
}

# Projections of one raw or stored table, and literal tables: not worth a copy.
VIEWS = frozenset({
    "course_registration", "faculty", "department", "college", "degree_type", "student_level", "grade_scale", "course_prerequisite", "staff",
    "registration_audit", "security_user_map",
})
