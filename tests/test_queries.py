"""Every registered query beside its SQL, on the given data and on data where one key holds a third of all rows."""

import pytest

import __spark_entry__ as entry
import oracles
from compare import compare, duck
from matricula.plans.catalog import CATALOG, model_violations

SQL = oracles.oracle_sql()
QUERIES = entry.queries()

SKEWED = (
    "faculty_performance", "registration_behaviour", "credit_load_distribution", "student_diversity", "prereq_compliance_audit",
    "lecturer_performance", "course_failure_rate", "fact_student_gpa", "running_cgpa", "scd2_second_load", "asof_dim_lookup",
    "versions_from_timestamps", "dq_checks", "registration_cap_greedy", "rls_lecturer", "student_registration_summary", "run_incremental",
)


@pytest.fixture(scope="module")
def con(raw_dir):
    return duck(raw_dir)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(CATALOG) == set(SQL) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, raw_dir, name):
    assert compare(QUERIES[name](spark, raw_dir), con, SQL[name]) is None


def test_views(spark, tables):
    tables.create_views(["student", "fact_enrollment"])
    assert spark.sql("SELECT count(*) FROM student").first()[0] == tables["student"].count()


def test_constraints_of_the_model_hold(tables):
    assert model_violations(tables).count() == 0


@pytest.fixture(scope="module")
def skewed(raw_dir, tmp_path_factory):
    """A third of the orders, lines and events moved to one customer, part and user."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = duck(raw_dir)
    changed = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM orders",
        "lineitem": "SELECT * REPLACE (CASE WHEN l_linenumber % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey, CASE WHEN l_linenumber % 3 = 1 THEN 5 ELSE l_suppkey END AS l_suppkey) FROM lineitem",
        "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM events",
    }
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"COPY ({changed.get(name, f'SELECT * FROM {name}')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder, duck(folder)


@pytest.mark.parametrize("name", SKEWED)
def test_skewed(spark, skewed, name):
    folder, con = skewed
    assert compare(QUERIES[name](spark, folder), con, SQL[name]) is None
