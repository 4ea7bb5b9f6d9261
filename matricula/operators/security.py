"""Row-level visibility of students by user, as a filter of the read API."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def roles_of(user_map: DataFrame, user: str) -> list:
    """The user's rows (role_name, entity_id, faculty_id) of the map, which has one per user; read before anything is planned."""
    return user_map.where(F.col("db_username") == user).select("role_name", "entity_id", "faculty_id").distinct().collect()


def _keys_of(role, tables: dict[str, DataFrame]) -> DataFrame | None:
    """Student ids that one role sees; None for a role that is not a faculty administrator's or lecturer's."""
    if role["role_name"] == "faculty_admin":
        department = tables["department"].where(F.col("faculty_id") == role["faculty_id"])
        programme = tables["programme"].join(department, "department_id", "left_semi")
        return tables["student"].join(programme, "programme_id", "left_semi").select("student_id")
    if role["role_name"] == "lecturer":
        taught = tables["course_assignment"].where(F.col("staff_id") == role["entity_id"]).select("course_id").distinct()
        return tables["course_registration"].join(taught, "course_id", "left_semi").select("student_id")
    return None


def visible_rows(rows: DataFrame, user_map: DataFrame, user: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows with a ``student_id`` the user may see; a registry administrator sees all, an unmapped user none.

    The role is looked up first, so each user's plan holds that role alone: no join for the registry or a student, one
    semi-join against the keys of the others.  Works for the student table and, opt-in, for any table keyed by student.
    """
    roles = roles_of(user_map, user)
    if any(r["role_name"] == "registry_admin" for r in roles):
        return rows
    own = [r["entity_id"] for r in roles if r["role_name"] == "student" and r["entity_id"] is not None]
    wide = [k for k in (_keys_of(r, tables) for r in roles) if k is not None]
    if not wide:
        return rows.where(F.col("student_id").isin(own)) if own else rows.where(F.lit(False))
    if own:
        wide.append(rows.where(F.col("student_id").isin(own)).select("student_id"))
    return rows.join(reduce(DataFrame.unionByName, wide).distinct(), "student_id", "left_semi").select(*rows.columns)


def blocked_writes(writes: DataFrame, user_map: DataFrame, user: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of a write set the user may not touch."""
    allowed = visible_rows(writes.select("student_id").distinct(), user_map, user, tables)
    return writes.join(allowed, "student_id", "left_anti")
