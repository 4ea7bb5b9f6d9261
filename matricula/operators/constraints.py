"""Declared constraints as set-based validators producing (rule, key, violations) rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..session import stored
from ..sources.reference_data import COURSE_TYPES

# Closed value sets.
SEMESTER_NAMES = ("First", "Second")
SEMESTERS_OFFERED = ("First", "Second", "Both")
GENDERS = ("Male", "Female", "Other")
ENROLLMENT_STATUSES = ("Active", "Suspended", "Withdrawn", "Graduated", "Deferred")
REGISTRATION_STATUSES = ("Registered", "Dropped", "Completed")
RESULT_REMARKS = ("Pass", "Fail", "Absent", "Withheld")
SEVERITIES = ("ERROR", "WARNING", "INFO")
ROLES = ("student", "lecturer", "faculty_admin", "registry_admin")
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED", "PARTIAL")


@dataclass(frozen=True)
class Check:
    """A row condition; NULL passes."""

    table: str
    name: str
    condition: str


@dataclass(frozen=True)
class NotNull:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """No two rows agree on the columns; NULLs count as equal."""

    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """A non-null child column has a parent row."""

    table: str
    column: str
    parent: str
    parent_column: str


def _in(column, values):
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


CHECKS = (
    Check("academic_session", "session_dates", "end_date > start_date"),
    Check("semester", "semester_dates", "end_date > start_date"),
    Check("semester", "reg_deadline", "reg_deadline <= end_date"),
    Check("semester", "semester_name", _in("semester_name", SEMESTER_NAMES)),
    Check("course", "semester_offered", _in("semester_offered", SEMESTERS_OFFERED)),
    Check("course_prerequisite", "no_self_prereq", "course_id <> required_course_id"),
    Check("programme_course", "programme_course_type", _in("course_type", COURSE_TYPES)),
    Check("student", "gender", _in("gender", GENDERS)),
    Check("student", "enrollment_status", _in("enrollment_status", ENROLLMENT_STATUSES)),
    Check("course_registration", "registration_status", _in("registration_status", REGISTRATION_STATUSES)),
    Check("course_registration", "course_type", _in("course_type_taken", COURSE_TYPES)),
    Check("course_result", "result_remark", _in("remark", RESULT_REMARKS)),
    Check("dq_check_log", "dq_severity", _in("severity", SEVERITIES)),
    Check("security_user_map", "role", _in("role_name", ROLES)),
    Check("etl_log", "etl_status", _in("status", RUN_STATUSES)),
)

UNIQUES = tuple(
    Unique(table, columns)
    for table, columns in (
        ("etl_watermark", ("entity_name",)),
        ("academic_session", ("session_name",)),
        ("semester", ("session_id", "semester_name")),
        ("student_level", ("level_name",)),
        ("student_level", ("level_number",)),
        ("degree_type", ("degree_code",)),
        ("grade_scale", ("grade",)),
        ("college", ("college_name",)),
        ("faculty", ("faculty_name",)),
        ("faculty", ("abbreviation",)),
        ("department", ("faculty_id", "department_name")),
        ("course_category", ("category_code",)),
        ("course", ("course_code",)),
        ("course_prerequisite", ("course_id", "required_course_id")),
        ("programme_course", ("programme_id", "course_id")),
        ("student", ("student_matric_no",)),
        ("student", ("email",)),
        ("student_level_history", ("student_id", "session_id")),
        ("course_registration", ("student_id", "course_id", "semester_id")),
        ("course_result", ("registration_id",)),
        ("staff", ("staff_no",)),
        ("staff", ("email",)),
        ("course_assignment", ("course_id", "semester_id", "staff_id")),
        ("security_user_map", ("db_username",)),
        ("dim_date", ("full_date",)),
        ("dim_course", ("course_id",)),
        ("dim_academic_period", ("semester_id",)),
        ("dim_staff", ("staff_id",)),
        ("dim_geography", ("state_name",)),
        ("dim_student", ("student_sk",)),
        ("fact_enrollment", ("registration_id",)),
        ("fact_student_gpa", ("student_sk", "period_sk")),
    )
)

REFERENCES = tuple(
    Reference(*r)
    for r in (
        ("semester", "session_id", "academic_session", "session_id"),
        ("faculty", "college_id", "college", "college_id"),
        ("department", "faculty_id", "faculty", "faculty_id"),
        ("programme", "department_id", "department", "department_id"),
        ("programme", "degree_type_id", "degree_type", "degree_type_id"),
        ("course", "department_id", "department", "department_id"),
        ("course", "category_id", "course_category", "category_id"),
        ("course", "level_id", "student_level", "level_id"),
        ("course_prerequisite", "course_id", "course", "course_id"),
        ("course_prerequisite", "required_course_id", "course", "course_id"),
        ("programme_course", "programme_id", "programme", "programme_id"),
        ("programme_course", "course_id", "course", "course_id"),
        ("student", "programme_id", "programme", "programme_id"),
        ("student", "current_level_id", "student_level", "level_id"),
        ("student", "admission_session_id", "academic_session", "session_id"),
        ("student_level_history", "student_id", "student", "student_id"),
        ("student_level_history", "session_id", "academic_session", "session_id"),
        ("student_level_history", "level_id", "student_level", "level_id"),
        ("course_registration", "student_id", "student", "student_id"),
        ("course_registration", "course_id", "course", "course_id"),
        ("course_registration", "semester_id", "semester", "semester_id"),
        ("registration_audit", "student_id", "student", "student_id"),
        ("registration_audit", "course_id", "course", "course_id"),
        ("registration_audit", "semester_id", "semester", "semester_id"),
        ("course_result", "registration_id", "course_registration", "registration_id"),
        ("staff", "department_id", "department", "department_id"),
        ("course_assignment", "course_id", "course", "course_id"),
        ("course_assignment", "semester_id", "semester", "semester_id"),
        ("course_assignment", "staff_id", "staff", "staff_id"),
        ("fact_enrollment", "student_sk", "dim_student", "student_sk"),
        ("fact_enrollment", "course_sk", "dim_course", "course_sk"),
        ("fact_enrollment", "period_sk", "dim_academic_period", "period_sk"),
        ("fact_student_gpa", "student_sk", "dim_student", "student_sk"),
        ("fact_student_gpa", "period_sk", "dim_academic_period", "period_sk"),
        ("fact_registration_event", "student_sk", "dim_student", "student_sk"),
        ("fact_registration_event", "course_sk", "dim_course", "course_sk"),
        ("fact_registration_event", "period_sk", "dim_academic_period", "period_sk"),
    )
)

# The columns declared NOT NULL, and the primary keys.
NOT_NULLS = tuple(
    NotNull(table, tuple(columns.split()))
    for table, columns in (
        ("etl_watermark", "entity_name last_extracted_at last_row_count updated_at"),
        ("academic_session", "session_id session_name start_date end_date is_current created_at updated_at"),
        ("semester", "semester_id session_id semester_name start_date end_date reg_deadline is_current created_at updated_at"),
        ("student_level", "level_id level_name level_number"),
        ("degree_type", "degree_type_id degree_code degree_name"),
        ("grade_scale", "grade_scale_id grade min_score max_score grade_point"),
        ("college", "college_id college_name updated_at"),
        ("faculty", "faculty_id faculty_name abbreviation updated_at"),
        ("department", "department_id faculty_id department_name updated_at"),
        ("programme", "programme_id department_id degree_type_id programme_name duration_years updated_at"),
        ("course_category", "category_id category_code category_name"),
        ("course", "course_id department_id category_id course_code course_title credit_units level_id semester_offered is_active is_compulsory_se created_at updated_at"),
        ("course_prerequisite", "prerequisite_id course_id required_course_id min_grade"),
        ("programme_course", "programme_course_id programme_id course_id course_type is_compulsory"),
        ("student", "student_id student_matric_no first_name last_name programme_id current_level_id admission_session_id enrollment_status created_at updated_at"),
        ("student_history", "student_id valid_from valid_to"),
        ("student_level_history", "student_id session_id level_id total_credits_earned recorded_at"),
        ("course_registration", "registration_id student_id course_id semester_id registration_date registration_status course_type_taken updated_at"),
        ("registration_audit", "audit_id student_id course_id semester_id attempt_time was_late prereqs_failed"),
        ("course_result", "result_id registration_id credit_units_earned remark entered_at updated_at"),
        ("staff", "staff_id staff_no first_name last_name department_id is_active updated_at"),
        ("course_assignment", "course_id semester_id staff_id"),
        ("dq_check_log", "check_name check_category severity records_flagged checked_at"),
        ("security_user_map", "db_username role_name"),
        ("etl_log", "etl_run_id run_started_at status rows_inserted rows_updated scd2_rows_closed dq_errors dq_warnings triggered_by"),
        ("dim_date", "date_key full_date day_name day_num week_num month_num month_name quarter_num quarter_name year_num is_weekend is_holiday"),
        ("dim_student", "student_sk student_id student_matric_no full_name effective_date expiry_date is_current dw_created_at dw_updated_at"),
        ("dim_course", "course_sk course_id course_code course_title credit_units is_compulsory_se is_active has_prerequisites prerequisite_count dw_created_at dw_updated_at"),
        ("dim_academic_period", "period_sk semester_id session_name semester_name academic_year start_date end_date reg_deadline is_current"),
        ("dim_staff", "staff_sk staff_id is_active dw_created_at"),
        ("dim_geography", "geo_sk state_name"),
        ("fact_enrollment", "student_sk course_sk period_sk registration_id credit_units credit_units_earned is_pass is_distinction is_credit is_fail is_absent is_late_registration is_major_course is_elective_course is_compulsory_se dw_inserted_at"),
        ("fact_student_gpa", "student_sk period_sk total_credits_attempted total_credits_earned courses_registered courses_passed courses_failed courses_absent is_first_class is_second_class_upper is_second_class_lower is_third_class is_at_risk dw_inserted_at"),
        ("fact_registration_event", "student_sk course_sk period_sk was_late was_rejected prereqs_failed dw_inserted_at"),
    )
)


def _name(rule) -> str:
    if isinstance(rule, Check):
        return f"check:{rule.table}.{rule.name}"
    if isinstance(rule, NotNull):
        return f"not_null:{rule.table}.{','.join(rule.columns)}"
    if isinstance(rule, Unique):
        return f"unique:{rule.table}.{','.join(rule.columns)}"
    return f"reference:{rule.table}.{rule.column}->{rule.parent}"


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _broken(rule) -> str:
    return f"NOT coalesce({rule.condition}, true)" if isinstance(rule, Check) else f"{rule.columns[0]} IS NULL"


def _typed(df: DataFrame, columns) -> tuple[tuple[str, ...], list[str]]:
    """The types under which keys of these columns meet, all integers as BIGINT, and the columns cast to them."""
    kinds = dict(df.dtypes)
    types = tuple("bigint" if kinds[c] in INTEGERS else "decimal(38,0)" if kinds[c].startswith("decimal") and kinds[c].endswith(",0)") else kinds[c] for c in columns)
    return types, [c if kinds[c] == t else f"CAST({c} AS {t.upper()})" for c, t in zip(columns, types, strict=True)]


def _entry(number: int, keys, parent: int = 0) -> str:
    named = ", ".join(f"'k{i}', {k}" for i, k in enumerate(keys))
    return f"named_struct('rule', {number}, {named}, 'child', {1 - parent}, 'parent', {parent})"


def _row_entries(df: DataFrame, numbered) -> DataFrame:
    """The rows that break a rule on their own, once per rule, in one scan; the key is the first column."""
    any_broken = " OR ".join(f"({_broken(r)})" for _, r in numbered)
    said = ", ".join(f"CASE WHEN {_broken(r)} THEN {n} END" for n, r in numbered)
    broken = df.where(any_broken).selectExpr(f"explode(array_compact(array({said}))) AS rule", f"CAST({df.columns[0]} AS STRING) AS k0")
    return broken.selectExpr("rule", "k0", "1 AS child", "0 AS parent")


@dataclass(frozen=True)
class RuleSet:
    """Rules by number, for the tables at hand."""

    rules: tuple

    @staticmethod
    def over(available, checks=CHECKS, not_nulls=NOT_NULLS, uniques=UNIQUES, references=REFERENCES) -> RuleSet:
        single = [NotNull(r.table, (c,)) for r in not_nulls for c in r.columns]
        rules = [r for r in (*checks, *single, *uniques) if r.table in available]
        return RuleSet((*rules, *(r for r in references if r.table in available and r.parent in available)))

    @property
    def tables(self) -> list[str]:
        return list(dict.fromkeys([r.table for r in self.rules] + [r.parent for r in self.rules if isinstance(r, Reference)]))

    def entries(self, table: str, df: DataFrame) -> list[tuple[tuple[str, ...], DataFrame]]:
        """What the rows of df say, as rows of a table: (types of the key, frame of rule, k0, k1, ..., child, parent).

        Broken rows come from one scan, keys of one type from another; what is said about keys is exploded on the
        map side, where the counts are combined before anything moves."""
        numbered = list(enumerate(self.rules))
        row_rules = [(n, r) for n, r in numbered if r.table == table and isinstance(r, (Check, NotNull))]
        by_type: dict[tuple[str, ...], list[tuple[str, str]]] = {}

        def say(number, columns, parent, test):
            types, keys = _typed(df, columns)
            by_type.setdefault(types, []).append((_entry(number, keys, parent), test))

        for n, r in numbered:
            if isinstance(r, Unique) and r.table == table:
                say(n, r.columns, 0, "true")
            if isinstance(r, Reference) and r.table == table:
                say(n, (r.column,), 0, f"{r.column} IS NOT NULL")
            if isinstance(r, Reference) and r.parent == table:
                say(n, (r.parent_column,), 1, f"{r.parent_column} IS NOT NULL")
        found = [(("string",), _row_entries(df, row_rules))] if row_rules else []
        for types, said in by_type.items():
            rows = df if any(test == "true" for _, test in said) else df.where(" OR ".join(test for _, test in said))
            entries = ", ".join(e if test == "true" else f"CASE WHEN {test} THEN {e} END" for e, test in said)
            found.append((types, rows.selectExpr(f"inline(array({entries}))").where("rule IS NOT NULL")))
        return found

    def collected(self, frames) -> dict[tuple[str, ...], DataFrame]:
        """Entries of several tables, one frame per type of key."""
        by_type: dict[tuple[str, ...], list[DataFrame]] = {}
        for table, df in frames:
            for types, rows in self.entries(table, df):
                by_type.setdefault(types, []).append(rows)
        return {types: reduce(DataFrame.unionByName, rows) for types, rows in by_type.items()}

    def is_broken(self, child: str, parent: str) -> str:
        """A row rule is broken by any entry, a unique key by a second one, a reference by a child without a parent."""
        keys = ", ".join(str(n) for n, r in enumerate(self.rules) if isinstance(r, Unique)) or "-1"
        return f"CASE WHEN rule IN ({keys}) THEN {child} > 1 ELSE {child} > 0 AND {parent} = 0 END"

    def named(self) -> str:
        names = ", ".join(f"'{_name(r)}'" for r in self.rules)
        return f"array({names})[rule] AS rule"

    def key_text(self, types) -> str:
        """A key as text: a reference's or row's as it is; a unique key's columns joined, text with its length in front."""
        keys = ", ".join(str(n) for n, r in enumerate(self.rules) if isinstance(r, Unique)) or "-1"
        part = lambda i, t: f"length(k{i}) || ':' || k{i}" if t == "string" else f"CAST(k{i} AS STRING)"
        joined = "concat_ws('|', " + ", ".join(f"coalesce({part(i, t)}, 'null')" for i, t in enumerate(types)) + ")"
        return f"CASE WHEN rule IN ({keys}) THEN {joined} ELSE CAST(k0 AS STRING) END AS key"


def _keys(types) -> list[str]:
    return [f"k{i}" for i in range(len(types))]


def violations(tables, available, checks=CHECKS, not_nulls=NOT_NULLS, uniques=UNIQUES, references=REFERENCES) -> DataFrame:
    """rule, key, violations: every rule whose tables are ``available``, with one shuffle per type of key.

    Keys keep their types and are counted per rule on the map side, so a key
    that many rows share moves once.
    """
    rules = RuleSet.over(available, checks, not_nulls, uniques, references)
    parts = []
    for types, entries in rules.collected((table, tables[table]) for table in rules.tables).items():
        counted = entries.groupBy("rule", *_keys(types)).agg(F.sum("child").alias("violations"), F.sum("parent").alias("parents"))
        parts.append(counted.where(rules.is_broken("violations", "parents")).selectExpr(rules.named(), rules.key_text(types), "violations"))
    return reduce(DataFrame.unionByName, parts)


def changed_violations(before, removed, added, available, checks=CHECKS, not_nulls=NOT_NULLS, uniques=UNIQUES, references=REFERENCES) -> DataFrame:
    """rule, key, before, after: the keys whose count of violations a change of rows alters, without a second full check.

    ``removed`` and ``added`` map a table to the rows taken out and put in
    (rows that are in both cancel out); ``before`` holds the tables as they
    were.  Only keys that those rows name are looked at: the tables' entries
    are cut to them before they are counted, and the counts after the change
    follow from those before and from the rows changed.
    """
    rules = RuleSet.over(available, checks, not_nulls, uniques, references)
    gone = rules.collected((t, df) for t, df in removed.items() if t in rules.tables)
    came = rules.collected((t, df) for t, df in added.items() if t in rules.tables)
    moved = {t for t in (*removed, *added) if t in rules.tables}
    # A rule can change where one of its tables has; of such a rule all tables count.
    beside = {t for r in rules.rules if isinstance(r, Reference) and moved & {r.table, r.parent} for t in (r.table, r.parent)}
    old = rules.collected((t, before[t]) for t in rules.tables if t in moved | beside)
    parts = []
    for types in dict.fromkeys([*gone, *came]):
        key = ["rule", *_keys(types)]
        signed = [f[types].selectExpr(*key, f"{sign} * child AS child", f"{sign} * parent AS parent") for f, sign in ((gone, -1), (came, 1)) if types in f]
        change = reduce(DataFrame.unionByName, signed).groupBy(*key).agg(F.sum("child").alias("more"), F.sum("parent").alias("more_parents"))
        # Keys whose rows cancel out have not changed.
        change = stored(change.where("more <> 0 OR more_parents <> 0"), "changed-keys")
        same = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in key])
        was = old[types].join(change, same(old[types], change), "left_semi").groupBy(*key).agg(F.sum("child").alias("had"), F.sum("parent").alias("parents"))
        both = change.join(was, same(change, was), "left").select(*[change[k] for k in key], "more", "more_parents", "had", "parents")
        counts = both.selectExpr(*key, "coalesce(had, 0) AS had", "coalesce(parents, 0) AS parents", "coalesce(had, 0) + more AS has", "coalesce(parents, 0) + more_parents AS now_parents")
        judged = counts.selectExpr(*key, f"CASE WHEN {rules.is_broken('had', 'parents')} THEN had ELSE 0 END AS before", f"CASE WHEN {rules.is_broken('has', 'now_parents')} THEN has ELSE 0 END AS after")
        parts.append(judged.where("before <> after").selectExpr(rules.named(), rules.key_text(types), "before", "after"))
    if not parts:
        return before[rules.tables[0]].limit(0).selectExpr("'' AS rule", "'' AS key", "0L AS before", "0L AS after")
    return reduce(DataFrame.unionByName, parts)
