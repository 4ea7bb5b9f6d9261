"""What moves: rows of tables stored by key, of plans with few semesters, of stars with many leaves."""

import re
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from matricula.llm.components import components, contracted
from matricula.operators import quality
from matricula.operators.registration import session_gpa
from matricula.plans import facts, reports
from matricula.session import stored
from matricula.sources import derived


@pytest.fixture
def unsent(spark):
    """No side is sent to all tasks unless a plan says so."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_registrations_meet_their_results_without_a_shuffle(tables, unsent, capsys):
    registrations, results = tables["course_registration"], tables["course_result"]
    whole = results.withColumn("total_score", F.floor("total_score"))
    assert "Exchange" not in plan_of(registrations.join(whole, "registration_id"), capsys)
    assert registrations.join(results, "registration_id").count() == results.count() > 0


def test_first_lines_are_dealt_once_for_registrations_and_results(tables, unsent, capsys):
    assert "Exchange" not in plan_of(derived.course_registration(tables), capsys)
    lines, registrations = tables["first_line"], tables["course_registration"]
    keys = lines.select((F.col("registration_id") % F.lit(Decimal(10) ** 19)).alias("part"), "l_partkey", "registration_id")
    assert keys.where("part <> l_partkey OR registration_id IS NULL").isEmpty()
    assert lines.where(F.col("semester_id") != derived.semester_of(F.col("o_orderdate"))).isEmpty()
    assert registrations.count() == registrations.select("student_id", "course_id", "semester_id").distinct().count() == lines.count() > 0


@pytest.mark.parametrize("rows", [
    lambda t: facts.enrollment_rows(t, 1, datetime(2002, 1, 1)),
    lambda t: facts.event_rows(t, 1, datetime(2002, 1, 1)),
    lambda t: facts.gpa_rows(t, 1, datetime(2002, 1, 1), until=datetime(2030, 1, 1)),
    reports.prereq_compliance_audit,
])
def test_facts_are_not_dealt_by_their_few_semesters(tables, unsent, capsys, rows):
    plan = plan_of(rows(tables), capsys)
    assert "Exchange hashpartitioning" in plan
    assert not re.findall(r"hashpartitioning\((?:semester_id|session_id|period_sk)#\d+L?, \d+\)", plan)


def test_gpa_of_some_students_is_that_of_all(spark, tables):
    everyone = {tuple(r) for r in facts.gpa_rows(tables, 1, datetime(2002, 1, 1)).select("student_id", "period_sk", "session_gpa", "cgpa").collect()}
    until = {tuple(r) for r in facts.gpa_rows(tables, 1, datetime(2002, 1, 1), until=datetime(2030, 1, 1)).select("student_id", "period_sk", "session_gpa", "cgpa").collect()}
    assert everyone == until


def test_contracted_stars_keep_their_components_and_shrink(spark):
    hubs, leaves = 20, 300
    edges = spark.range(leaves).select(F.explode(F.sequence(F.lit(1000).cast("long"), F.lit(999 + hubs).cast("long"))).alias("a"), F.col("id").alias("b"))
    edges = edges.unionByName(spark.createDataFrame([(5000, 5001), (5002, 5001), (1003, 1004)], "a long, b long"))
    small = contracted(edges)
    assert edges.count() > 6000 and small.count() < 2 * (hubs + leaves)
    assert {tuple(r) for r in components(small).collect()} == {tuple(r) for r in components(edges).collect()}
    assert Counter(r.component for r in components(small).collect()) == {0: leaves + hubs, 5000: 3}


@pytest.fixture
def small_sends(spark):
    """Sides of up to 200 kB are sent to all tasks."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sides_are_sent_by_the_size_of_their_rows(spark, small_sends, capsys):
    """The driver builds a side that is sent: 20,000 courses of 24 bytes, in a file of a few kB, are too many here."""
    course = stored(spark.range(20_000).selectExpr("id AS course_id", "cast(id % 4 + 1 AS int) AS credit_units", "'title' AS course_title", "'text' AS course_description"), "courses")
    semester = stored(spark.createDataFrame([(20001, 2000), (20002, 2000)], "semester_id long, session_id long"), "semesters")
    taken = spark.range(40_000).selectExpr("id AS registration_id", "id % 7 AS student_id", "id % 20000 AS course_id", "20001 + id % 2 AS semester_id")
    results = taken.selectExpr("registration_id", "cast(3 AS decimal(3,1)) AS grade_point", "1 AS credit_units_earned", "'Pass' AS remark")
    sessions = session_gpa(stored(taken, "registrations"), stored(results, "results"), course, semester)
    plan = plan_of(sessions, capsys)
    assert not re.findall(r"BroadcastHashJoin \[course_id#\d+L?\]", plan) and re.findall(r"SortMergeJoin \[course_id#\d+L?\]", plan)
    assert re.findall(r"BroadcastHashJoin \[semester_id#\d+L?\]", plan)
    assert sessions.agg(F.sum("courses_registered")).first()[0] == 40_000
    few = stored(course.where("course_id < 500"), "few-courses")
    assert "SortMergeJoin [course_id" not in plan_of(stored(taken, "registrations").join(few, "course_id"), capsys)


@pytest.mark.parametrize("rows", [derived.course_result, reports.prereq_compliance_audit])
def test_results_move_without_their_long_identifier(tables, unsent, capsys, rows):
    plan = plan_of(rows(tables), capsys)
    assert "Exchange hashpartitioning" in plan and not re.findall(r"hashpartitioning\(registration_id#", plan)


def test_checked_registrations_are_judged_before_they_move(tables, unsent, capsys):
    moved = re.findall(r"hashpartitioning\(course_id#.*\n.*Project \[(.*)\]", plan_of(quality.registration_checks(tables, date(2025, 1, 1)), capsys))
    narrow = [m for m in moved if "student_id" in m]
    assert narrow and not any(re.search(r"\bregistration_(id|date|status)#\d+L?(?:,|$)", m) for m in narrow)
