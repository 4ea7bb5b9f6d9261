"""The small university end to end, against answers worked out by hand."""

from collections import ChainMap
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import seed
from matricula.operators import constraints, quality, registration, security
from matricula.plans import adhoc, pipeline, reports, views
from matricula.session import fresh_folder
from matricula.sources.reference_data import literal_table
from matricula.sources.store import Store
from matricula.schemas import schema_of


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def load(spark, corrected=True):
    source = seed.source(spark, corrected)
    store = Store(spark, fresh_folder(spark, "seed"))
    run = pipeline.run_incremental(store, source, seed.AS_OF).first()
    return source, store, run


@pytest.fixture(scope="module")
def loaded(spark):
    return load(spark)


@pytest.fixture(scope="module")
def t(loaded):
    source, store, _ = loaded
    return ChainMap(pipeline.published(store), source)


def counts(t, as_of=date(2025, 3, 15)):
    return {r["check_id"]: r["records_flagged"] for r in quality.check_counts(t, as_of).collect() if r["records_flagged"]}


def test_checks(spark):
    assert counts(seed.source(spark, corrected=False)) == {"DQ-04": 5, "DQ-08": 5, "DQ-09": 3, "DQ-10": 21}
    assert counts(seed.source(spark)) == {"DQ-04": 5, "DQ-08": 5, "DQ-10": 21}


def test_check_log_text(spark):
    row = quality.run_checks(seed.source(spark, corrected=False), date(2025, 3, 15)).where("check_id = 'DQ-09'").first()
    assert row["detail"] == "3 results have a grade that does not match the score-to-grade mapping."


def test_errors_block_the_load(spark):
    store = Store(spark, fresh_folder(spark, "blocked"))
    with pytest.raises(pipeline.LoadBlocked):
        pipeline.run_incremental(store, seed.source(spark, corrected=False), seed.AS_OF)
    run = pipeline.run_log(store).first()
    assert (run["status"], run["dq_errors"], run["dq_warnings"]) == ("FAILED", 1, 3)
    assert run["error_message"] == "1 DQ errors blocked the load."
    assert Store(spark, store.root).names() == []
    assert [r["severity"] for r in adhoc.failed_checks(store.log("dq_check_log")).collect()].count("ERROR") == 1


def test_run_record(loaded):
    run = loaded[2]
    assert (run["status"], run["dq_errors"], run["dq_warnings"], run["scd2_rows_closed"]) == ("SUCCESS", 0, 3, 0)
    courses = len(seed.CODES)
    assert run["rows_inserted"] == 8 + courses + 11 + 10 + 5 + 1 + 26


def test_dim_date(t):
    dim = t["dim_date"]
    assert dim.count() == 3652
    assert dim.where("is_weekend").count() == 1044
    first = dim.where("date_key = 20210101").first()
    assert (first["day_name"], first["week_num"], first["academic_year"], first["season"]) == ("Friday", 53, "2020/2021", "First Semester")


def test_enrollment(t):
    rows = t["fact_enrollment"].collect()
    assert len(rows) == 5
    assert {(r.student_sk // 1_000_000, r.period_sk, r.staff_sk) for r in rows} == {(3, 5, None)}
    assert all(r.is_pass and not r.is_late_registration for r in rows)


@pytest.mark.parametrize("corrected,gpa,upper", [(False, "3.00", False), (True, "3.60", True)])
def test_gpa(spark, corrected, gpa, upper):
    s = seed.source(spark, corrected)
    row = registration.session_gpa(s["course_registration"], s["course_result"], s["course"], s["semester"]).first()
    assert (row["session_gpa"], row["credits_attempted"], row["credits_earned"], row["session_id"]) == (Decimal(gpa), 15, 15, 3)


def test_gpa_fact(t):
    row = t["fact_student_gpa"].first()
    assert (row["period_sk"], row["cgpa"], row["is_second_class_upper"], row["is_second_class_lower"]) == (6, Decimal("3.60"), True, False)


def test_events(t):
    e = t["fact_registration_event"]
    assert (e.count(), e.where("was_rejected").count(), e.where("was_late").count()) == (26, 0, 0)


def test_faculty_performance(t):
    (row,) = as_dicts(reports.faculty_performance(t))
    assert row == {
        "faculty_name": "Faculty 14", "session_name": "2023/2024", "semester_name": "First", "total_students": 1, "total_enrollments": 5,
        "avg_total_score": 64.0, "avg_grade_point": 3.6, "total_passes": 5, "total_failures": 0, "total_distinctions": 2,
        "pass_rate_pct": 100.0, "failure_rate_pct": 0.0, "distinction_rate_pct": 40.0,
    }


def test_reports_on_little_data(t):
    assert reports.at_risk_students(t).count() == 0
    assert reports.course_failure_rate(t).count() == 0
    assert reports.lecturer_performance(t).count() == 0
    (load_row,) = as_dicts(reports.credit_load_distribution(t))
    assert (load_row["students"], load_row["min_credits"], load_row["max_credits"], load_row["avg_credits"]) == (1, 15, 15, 15.0)
    (diversity,) = as_dicts(reports.student_diversity(t))
    assert (diversity["geopolitical_zone"], diversity["region"], diversity["student_count"], diversity["avg_cgpa"]) == ("South-West", "South", 1, None)
    (trend,) = as_dicts(reports.student_progression(t))
    assert (trend["cgpa_delta"], trend["class_of_degree"]) == (None, "2nd Class Upper")
    (done,) = as_dicts(reports.credit_completion_rate(t))
    assert (done["total_credits_attempted"], done["total_credits_earned"], done["completion_rate_pct"]) == (15, 15, 100.0)


def test_compliance_rate(t):
    rows = as_dicts(reports.ser001_compliance_rate(t))
    assert len(rows) == 16
    assert {(r["ser001_registered"], r["compliance_rate_pct"]) for r in rows} == {(None, 0.0)}
    assert sum(r["total_100L_students"] for r in rows) == 5 * 4


def test_registration_behaviour(t):
    rows = {(r["faculty_name"], r["semester_name"], r["session_name"]): r for r in as_dicts(reports.registration_behaviour(t))}
    seven = sorted(r["total_registrations"] for k, r in rows.items() if k[2] == "2024/2025")
    assert seven == [4, 4, 4, 9]
    assert {r["avg_days_before_deadline"] for k, r in rows.items() if k[2] == "2024/2025"} == {7.0}
    five = rows[("Faculty 14", "First", "2023/2024")]
    assert (five["total_registrations"], five["avg_days_before_deadline"]) == (5, 9.0)


def test_timeline(t):
    rows = {r["registration_date"]: r for r in as_dicts(reports.registration_timeline(t))}
    late, early = rows[date(2024, 9, 20)], rows[date(2023, 9, 20)]
    assert (late["daily_registrations"], late["day_name"], late["day_of_semester"], late["days_until_deadline"]) == (21, "Friday", 11, 7)
    assert (early["daily_registrations"], early["day_name"], early["day_of_semester"], early["days_until_deadline"]) == (5, "Wednesday", 9, 9)


def test_prerequisite_audit(t):
    rows = {(r["registered_course"], r["missing_prereq_code"]) for r in as_dicts(reports.prereq_compliance_audit(t))}
    assert rows == {("CSC301", "CSC201"), ("CSC302", "CSC201")}


def test_source_views(t):
    assert views.student_registration_summary(t, date(2025, 3, 15)).count() == 0
    assert views.student_transcript(t).count() == 26
    assert [r["ser001_status"] for r in views.ser001_compliance(t).collect()] == ["Registered"] * 5
    assert views.ser001_compliance(t, "ser001 ", case_insensitive=True).where("ser001_status = 'Registered'").count() == 5
    assert views.ser001_compliance(t, "ser001").where("ser001_status = 'Registered'").count() == 0
    assert views.course_prereq_chain(t).count() == 19
    assert [r["course_code"] for r in views.transcript(t, "CST/2022/001").collect()] == ["CSC301", "CSC302", "CSC304", "CSC305", "CSC306"]
    courses = views.student_courses(t, "CST/2024/002", 7).collect()
    assert [r["course_code"] for r in courses] == ["SER001", "AIT101", "CSC101", "CSC103"]


def test_zone_distribution(t):
    found = {r["geopolitical_zone"]: r["students"] for r in adhoc.zone_distribution(t).collect()}
    assert found == {"South-West": 4, "South-East": 3, "North-West": 2, "North-Central": 1}


@pytest.mark.parametrize("user,n", [
    ("student_one", 1), ("lecturer_one", 2), ("lecturer_eight", 5), ("fadmin_14", 5), ("fadmin_12", 1), ("registry_admin", 10), ("nobody", 0),
])
def test_visibility(t, user, n):
    assert security.visible_rows(t["student"], t["security_user_map"], user, t).count() == n


def test_visibility_of_writes_and_child_rows(t):
    assert security.blocked_writes(t["student"], t["security_user_map"], "fadmin_14", t).count() == 5
    assert security.visible_rows(t["course_registration"], t["security_user_map"], "student_two", t).count() == 4


def request(spark, *rows):
    schema = "request_id bigint, sequence bigint, student_id bigint, course_id bigint, semester_id bigint, course_type string, requested_at timestamp_ntz"
    return spark.createDataFrame([(i, i, *r) for i, r in enumerate(rows, 1)], schema)


def validate(t, requests, **options):
    return registration.validate_registrations(
        requests, t["semester"], t["course"], t["course_prerequisite"], t["course_registration"], t["course_result"], **options
    )


def test_registration_rules(spark, t):
    on_time, late = datetime(2025, 2, 20), datetime(2025, 3, 15)
    c = seed.course_id
    rows = [
        (3, c("CSC401"), 8, "MAJOR", on_time),
        (3, c("CSC401"), 8, "MAJOR", late),
        (3, c("CSC401"), 99, "MAJOR", on_time),
        (1, c("CSC101"), 7, "MAJOR", datetime(2024, 9, 20)),
        (1, c("CSC202"), 8, "MAJOR", on_time),
        (1, c("MAT101"), 8, "ELECTIVE", on_time),
        (1, c("MAT101"), 8, "ELECTIVE", on_time),
        (1, 9999, 8, "ELECTIVE", on_time),
    ]
    found = {r["request_id"]: r for r in validate(t, request(spark, *rows)).collect()}
    assert [found[i]["message"] for i in range(1, 9)] == [
        "ERROR: 1 prerequisite(s) not satisfied.", "ERROR: Registration deadline has passed.", "ERROR: Invalid semester.",
        "ERROR: Already registered for this course.", "ERROR: 1 prerequisite(s) not satisfied.", "SUCCESS: Course registered successfully.",
        "ERROR: Already registered for this course.", "ERROR: Unknown course.",
    ]
    assert (found[1]["was_late"], found[1]["prereqs_failed"], found[1]["rejection_reason"]) == (False, 1, "Prerequisites not satisfied")
    assert (found[2]["was_late"], found[2]["prereqs_failed"], found[2]["rejection_reason"]) == (True, 0, "Registration deadline passed")
    assert found[3]["rejection_reason"] is None
    validated = validate(t, request(spark, *rows))
    assert registration.accepted_registrations(validated).count() == 1
    assert registration.audit_rows(validated).count() == 3


def test_promotion(spark):
    s = seed.source(spark, corrected=False)
    args = (s["student"], s["student_level"], s["course_registration"], s["course_result"], s["course"], s["semester"])
    one = s["student"].where("student_matric_no = 'CST/2022/001'")
    (row,) = registration.promote_students(one, 3, *args).collect()
    assert row["message"] == "SUCCESS: Promoted to 400L. GPA: 3.00"
    top = s["student"].where("student_id = 1").withColumn("current_level_id", F.lit(7).cast("bigint"))
    (row,) = registration.promote_students(top, 3, top, *args[1:]).collect()
    assert row["message"].startswith("INFO: Student at maximum level")

    promotions = registration.promote_students(one, 3, *args)
    history = literal_table(spark, [(3, 3, 1, None, None, 0, None)], schema_of("student_level_history"))
    students, history = registration.apply_promotions(promotions, s["student"], history, datetime(2025, 1, 1))
    assert students.where("student_id = 3").first()["current_level_id"] == 4
    assert students.count() == 10
    (written,) = history.collect()
    assert (written["level_id"], written["gpa"], written["cgpa"], written["total_credits_earned"]) == (4, Decimal("3.00"), Decimal("3.00"), 15)


def test_constraints_hold(t):
    found = constraints.violations(t, t)
    assert found.collect() == []


def test_second_run_adds_nothing(spark):
    source, store, _ = load(spark)
    before = {n: sorted(map(str, df.drop("dw_updated_at").collect())) for n, df in pipeline.published(store).items() if n not in ("etl_log", "etl_watermark")}
    again = pipeline.run_incremental(store, source, datetime(2025, 3, 16)).first()
    assert (again["rows_inserted"], again["rows_updated"], again["scd2_rows_closed"]) == (0, 0, 0)
    after = {n: sorted(map(str, df.drop("dw_updated_at").collect())) for n, df in pipeline.published(store).items() if n not in ("etl_log", "etl_watermark")}
    assert after == before
    full = pipeline.run_incremental(store, source, datetime(2025, 3, 17), force_full=True).first()
    assert full["scd2_rows_closed"] == 0
    loaded = pipeline.published(store)
    assert {n: loaded[n].count() for n in before} == {n: len(rows) for n, rows in before.items()}


def test_changes_reach_the_warehouse(spark):
    source, store, _ = load(spark)
    late = datetime(2025, 3, 16, 8)
    moved = source["student"].withColumn("updated_at", F.when(F.col("student_id") == 3, F.lit(late).cast("timestamp_ntz")).otherwise(F.col("updated_at")))
    moved = moved.withColumn("current_level_id", F.when(F.col("student_id") == 3, F.lit(4).cast("bigint")).otherwise(F.col("current_level_id")))
    better = source["course_result"].withColumn("updated_at", F.when(F.col("result_id") == 5, F.lit(late).cast("timestamp_ntz")).otherwise(F.col("updated_at")))
    better = better.withColumns({
        "grade": F.when(F.col("result_id") == 5, "D").otherwise(F.col("grade")),
        "exam_score": F.when(F.col("result_id") == 5, 26).otherwise(F.col("exam_score")).cast("decimal(5,2)"),
        "total_score": F.when(F.col("result_id") == 5, 46).otherwise(F.col("total_score")).cast("decimal(6,2)"),
        "grade_point": F.when(F.col("result_id") == 5, 2).otherwise(F.col("grade_point")).cast("decimal(3,1)"),
    })
    run = pipeline.run_incremental(store, {**source, "student": moved, "course_result": better}, datetime(2025, 3, 17)).first()
    assert (run["rows_updated"], run["scd2_rows_closed"]) == (1, 1)
    t = pipeline.published(store)
    versions = adhoc.version_history(t["dim_student"], "student_matric_no", "CST/2022/001").collect()
    assert [(v["level_name"], v["effective_date"], v["expiry_date"], v["is_current"]) for v in versions] == [
        ("300L", date(2025, 3, 15), date(2025, 3, 17), False), ("400L", date(2025, 3, 17), date(9999, 12, 31), True),
    ]
    # Only the changed result was reloaded, so four facts still point at the closed version and leave the report.
    assert t["fact_enrollment"].count() == 5
    (now,) = as_dicts(reports.faculty_performance(t))
    assert (now["total_enrollments"], now["avg_grade_point"]) == (1, 2.0)
    (durable,) = as_dicts(reports.faculty_performance(t, durable_key=True))
    assert (durable["total_enrollments"], durable["total_students"]) == (5, 1)
    (gpa,) = t["fact_student_gpa"].collect()
    assert gpa["session_gpa"] == Decimal("3.80")
    assert t["fact_registration_event"].count() == 26


def _stamped(df, key, value, late):
    return df.withColumn("updated_at", F.when(F.col(key) == value, F.lit(late).cast("timestamp_ntz")).otherwise(F.col("updated_at")))


def test_a_load_touches_only_its_parts(spark):
    """Open versions and the index of registrations are read and rewritten by key; other parts keep their files."""
    source, store, _ = load(spark)
    before = {n: store.parts(n) for n in ("dim_student", "registration_period", "fact_enrollment")}
    assert sorted(before["dim_student"]) == sorted({f"current-{i % pipeline.STUDENT_PARTS}" for i in range(1, 11)})
    index = sorted(map(tuple, store.read("registration_period").collect()))
    assert index == sorted(map(tuple, store.read("fact_enrollment").select("registration_id", "period_sk").collect())) and len(index) == 5
    late = datetime(2025, 3, 16, 8)
    moved = _stamped(source["student"], "student_id", 3, late).withColumn("phone", F.when(F.col("student_id") == 3, "1"))
    moved = moved.withColumn("enrollment_status", F.when(F.col("student_id") == 3, "Deferred").otherwise(F.col("enrollment_status")))
    run = pipeline.Run(store, {**source, "student": moved}, 2, datetime(2025, 3, 17), datetime(2025, 3, 17))
    registration = index[0][0]
    looked = run.indexed(spark.createDataFrame([(registration,)], "registration_id decimal(38,0)"))
    assert {f.rsplit("/", 1)[0].removeprefix("file:").removeprefix("//") for f in looked.inputFiles()} < {p.removeprefix("file:") for p in before["registration_period"].values()} or len(before["registration_period"]) == 1
    pipeline.run_incremental(store, {**source, "student": moved, "course_result": _stamped(source["course_result"], "result_id", 5, late)}, datetime(2025, 3, 17))
    after = {n: store.parts(n) for n in before}
    changed = {k for k, v in after["dim_student"].items() if before["dim_student"].get(k) != v}
    assert changed == {"current-3", "closed-2"}
    assert store.read("dim_student").count() == 11
    assert after["registration_period"] == before["registration_period"]  # the result stays in its period
    dealt = pipeline.run_incremental(store, source, datetime(2025, 3, 18), student_parts=4, force_full=True).first()
    assert dealt["status"] == "SUCCESS"
    assert {k for k in store.parts("dim_student") if k.startswith("current")} == {f"current-{i}" for i in range(4)}
    assert store.read("dim_student").where("is_current").count() == 10


def test_a_result_that_moves_leaves_its_old_period(spark):
    """A registration changed to another semester is found through the index and taken out of the old period."""
    source, store, _ = load(spark)
    (one,) = source["course_result"].where("result_id = 5").select("registration_id").collect()
    late = datetime(2025, 3, 16, 8)
    other = source["course_registration"].withColumn("semester_id", F.when(F.col("registration_id") == one[0], F.lit(4).cast("bigint")).otherwise(F.col("semester_id")))
    pipeline.run_incremental(store, {**source, "course_registration": other, "course_result": _stamped(source["course_result"], "result_id", 5, late)}, datetime(2025, 3, 17))
    fact = store.read("fact_enrollment")
    assert fact.count() == 5 and [r[0] for r in fact.where(F.col("registration_id") == one[0]).select("period_sk").collect()] == [4]
    assert store.read("registration_period").where(F.col("registration_id") == one[0]).count() == 2


def test_validated_load(spark):
    """A run whose changes break a declared rule of the warehouse is logged, blocked and not published."""
    source = seed.source(spark)
    store = Store(spark, fresh_folder(spark, "validated"))
    assert pipeline.run_incremental(store, source, seed.AS_OF, validate=True).first()["status"] == "SUCCESS"
    late = datetime(2025, 3, 16, 8)
    nameless = _stamped(source["course"], "course_id", 2, late).withColumn("course_title", F.when(F.col("course_id") != 2, F.col("course_title")))
    with pytest.raises(pipeline.LoadBlocked):
        pipeline.run_incremental(store, {**source, "course": nameless}, datetime(2025, 3, 17), validate=True)
    (row,) = store.log("dq_check_log").where("check_category = 'CONSTRAINT'").collect()
    assert (row["check_name"], row["records_flagged"], row["etl_run_id"]) == ("not_null:dim_course.course_title", 1, 2)
    assert Store(spark, store.root).read("dim_course").where("course_title IS NULL").count() == 0
    assert pipeline.run_incremental(store, source, datetime(2025, 3, 18), validate=True).first()["status"] == "SUCCESS"
    newest = adhoc.failed_checks(store.log("dq_check_log")).first()
    assert newest["checked_at"] == datetime(2025, 3, 18)


def test_failed_run_changes_nothing(spark):
    source, store, _ = load(spark)
    broken = {**source, "course_registration": source["course_registration"].drop("semester_id")}
    with pytest.raises(Exception):
        pipeline.run_incremental(store, broken, datetime(2025, 4, 1))
    reopened = Store(spark, store.root)
    assert reopened.read("fact_enrollment").count() == 5
    assert {r["etl_run_id"]: r["status"] for r in pipeline.run_log(reopened).collect()} == {1: "SUCCESS", 2: "FAILED"}
    health = {r["etl_run_id"]: r["health_status"] for r in reports.etl_health(pipeline.published(reopened)).collect()}
    assert health == {1: "Healthy with Warnings", 2: "FAILED — Action Required"}
