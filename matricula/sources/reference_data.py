"""Closed reference tables of the data model."""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..schemas import schema_of

# Grade bands (grade, lowest score, highest score, points, remark).
GRADE_SCALE = [
    ("A", 70, 100, Decimal("5.0"), "Excellent"),
    ("B", 60, 69, Decimal("4.0"), "Good"),
    ("C", 50, 59, Decimal("3.0"), "Average"),
    ("D", 45, 49, Decimal("2.0"), "Pass"),
    ("E", 40, 44, Decimal("1.0"), "Marginal Pass"),
    ("F", 0, 39, Decimal("0.0"), "Fail"),
]

# Numbers of the student levels; a level is named by its number and an L.
LEVEL_NUMBERS = (100, 200, 300, 400, 500, 600, 700)

# Degree codes.
DEGREE_CODES = ("B.Sc", "B.A", "B.Tech", "B.Eng", "MBBS", "B.DS", "B.Pharm", "LL.B", "B.Ed", "B.Agric", "B.F.A")

# Course categories and, among them, the types a registration can have.
COURSE_CATEGORIES = ("MAJOR", "ELECTIVE", "COMPULSORY_SE", "GEN_STUDIES", "COMMON")
COURSE_TYPES = ("MAJOR", "ELECTIVE", "COMPULSORY_SE")

# Code of the course every first-year student takes.
COMPULSORY_CODE = "SER001"

# Entities with a high-water mark, in seeding order, and those a load advances.
ENTITIES = (
    "student", "course", "course_registration", "course_result", "student_level_history", "programme",
    "department", "faculty", "semester", "academic_session", "staff",
)
LOADED_ENTITIES = (
    "student", "course", "course_registration", "course_result", "academic_session", "semester", "staff",
)

# State, geopolitical zone, region.
STATES = [
    ("Abia", "South-East", "South"),
    ("Adamawa", "North-East", "North"),
    ("Akwa Ibom", "South-South", "South"),
    ("Anambra", "South-East", "South"),
    ("Bauchi", "North-East", "North"),
    ("Bayelsa", "South-South", "South"),
    ("Benue", "North-Central", "North"),
    ("Borno", "North-East", "North"),
    ("Cross River", "South-South", "South"),
    ("Delta", "South-South", "South"),
    ("Ebonyi", "South-East", "South"),
    ("Edo", "South-South", "South"),
    ("Ekiti", "South-West", "South"),
    ("Enugu", "South-East", "South"),
    ("FCT", "North-Central", "North"),
    ("Gombe", "North-East", "North"),
    ("Imo", "South-East", "South"),
    ("Jigawa", "North-West", "North"),
    ("Kaduna", "North-West", "North"),
    ("Kano", "North-West", "North"),
    ("Katsina", "North-West", "North"),
    ("Kebbi", "North-West", "North"),
    ("Kogi", "North-Central", "North"),
    ("Kwara", "North-Central", "North"),
    ("Lagos", "South-West", "South"),
    ("Nasarawa", "North-Central", "North"),
    ("Niger", "North-Central", "North"),
    ("Ogun", "South-West", "South"),
    ("Ondo", "South-West", "South"),
    ("Osun", "South-West", "South"),
    ("Oyo", "South-West", "South"),
    ("Plateau", "North-Central", "North"),
    ("Rivers", "South-South", "South"),
    ("Sokoto", "North-West", "North"),
    ("Taraba", "North-East", "North"),
    ("Yobe", "North-East", "North"),
    ("Zamfara", "North-West", "North"),
]


def literal_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """Rows given in the program, as a local relation: Spark knows its size and needs no Python worker to read it."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)


def grade_scale(spark: SparkSession) -> DataFrame:
    rows = [(i, *band) for i, band in enumerate(GRADE_SCALE, 1)]
    return literal_table(spark, rows, schema_of("grade_scale"))


def student_level(spark: SparkSession) -> DataFrame:
    rows = [(i, f"{n}L", n, None) for i, n in enumerate(LEVEL_NUMBERS, 1)]
    return literal_table(spark, rows, schema_of("student_level"))


def degree_type(spark: SparkSession) -> DataFrame:
    rows = [(i, code, code) for i, code in enumerate(DEGREE_CODES, 1)]
    return literal_table(spark, rows, schema_of("degree_type"))


def states(spark: SparkSession) -> DataFrame:
    """Static geography dimension of the 37 states."""
    rows = [(i, *state) for i, state in enumerate(STATES, 1)]
    return literal_table(spark, rows, schema_of("dim_geography"))


def resolve_literals(spark: SparkSession, rows: list[tuple], schema: str, lookups) -> DataFrame:
    """Inline rows whose names are resolved to keys: ``lookups`` is a list of (table, name column, literal column, key)."""
    out = literal_table(spark, rows, StructType.fromDDL(schema))
    for table, name, literal, key in lookups:
        side = table.select(F.col(name).alias(literal), F.col(key).alias(f"{literal}_key"))
        out = out.join(side, literal)
    return out

