"""Independent SQL for each registered query, over the raw tables.

``BASE`` holds the records model as common table expressions; a statement
names those it reads and gets them, with what they read, in front.
"""

from __future__ import annotations

import re


def rounded(num: str, den: str, digits: int) -> str:
    """Exact quotient of whole numbers, rounded half away from zero, as DOUBLE."""
    n, d = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    size = f"((2 * abs({n}) * {10 ** digits} + {d}) // (2 * {d}))"
    return f"(CAST(CASE WHEN {n} < 0 THEN -{size} ELSE {size} END AS DOUBLE) / {10 ** digits}.0)"


def flag(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS BIGINT)"


def day_key(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS BIGINT)"


def sem_of(column: str) -> str:
    return f"(year({column}) * 10 + CASE WHEN month({column}) <= 6 THEN 1 ELSE 2 END)"


# Score, points and GPA as whole hundredths, tenths and hundredths.
SCORE = "CAST(total_score * 100 AS BIGINT)"
POINT = "CAST(grade_point * 10 AS BIGINT)"

GRADES = (("A", 70, 100, 50), ("B", 60, 69, 40), ("C", 50, 59, 30), ("D", 45, 49, 20), ("E", 40, 44, 10), ("F", 0, 39, 0))


def band(field: int) -> str:
    quote = "'{}'" if field == 0 else "{}"
    return "CASE " + " ".join(f"WHEN total_score >= {g[1]} THEN {quote.format(g[field])}" for g in GRADES) + " END"


BASE = {
    "faculty": "SELECT r_regionkey AS faculty_id, r_name AS faculty_name, r_name[1:3] AS abbreviation FROM region",
    "department": "SELECT n_nationkey AS department_id, n_regionkey AS faculty_id, n_name AS department_name FROM nation",
    "segment": "SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS position FROM (SELECT DISTINCT c_mktsegment FROM customer)",
    "programme": """SELECT DISTINCT c_nationkey * 100 + position AS programme_id, c_nationkey AS department_id,
        position + 1 AS degree_type_id, n_name || ' ' || c_mktsegment AS programme_name
        FROM customer JOIN segment USING (c_mktsegment) JOIN nation ON n_nationkey = c_nationkey""",
    "degree_type": """SELECT * FROM (VALUES (1,'B.Sc'),(2,'B.A'),(3,'B.Tech'),(4,'B.Eng'),(5,'MBBS'),(6,'B.DS'),(7,'B.Pharm'),
        (8,'LL.B'),(9,'B.Ed'),(10,'B.Agric'),(11,'B.F.A')) v(degree_type_id, degree_code)""",
    "student_level": "SELECT i AS level_id, (i * 100) || 'L' AS level_name, i * 100 AS level_number FROM range(1, 8) r(i)",
    "grade_scale": "SELECT * FROM (VALUES "
    + ",".join(f"('{g}',{lo},{hi},{p})" for g, lo, hi, p in GRADES)
    + ") v(grade, min_score, max_score, tenths)",
    "geography": """SELECT n_nationkey AS geo_id, n_name AS state_name, r_name AS geopolitical_zone,
        CASE WHEN r_regionkey < 3 THEN 'North' ELSE 'South' END AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "semester": f"""SELECT semester_id, semester_id // 10 AS session_id,
        CASE WHEN semester_id % 10 = 1 THEN 'First' ELSE 'Second' END AS semester_name,
        CASE WHEN semester_id % 10 = 1 THEN make_date(semester_id // 10, 1, 1) ELSE make_date(semester_id // 10, 7, 1) END AS start_date,
        CASE WHEN semester_id % 10 = 1 THEN make_date(semester_id // 10, 6, 30) ELSE make_date(semester_id // 10, 12, 31) END AS end_date,
        CAST(CASE WHEN semester_id % 10 = 1 THEN make_date(semester_id // 10, 1, 1) ELSE make_date(semester_id // 10, 7, 1) END
            + INTERVAL 90 DAY AS DATE) AS reg_deadline,
        semester_id = 20012 AS is_current
        FROM (SELECT {sem_of('o_orderdate')} AS semester_id FROM orders
              UNION SELECT {sem_of('ts')} FROM events WHERE event_type = 'error')""",
    "session": "SELECT DISTINCT session_id, session_id || '/' || (session_id + 1) AS session_name FROM semester",
    "period": "SELECT s.*, n.session_name FROM semester s JOIN session n USING (session_id)",
    "category": "SELECT p_type, row_number() OVER (ORDER BY p_type) AS category_id FROM (SELECT DISTINCT p_type FROM part)",
    "course": """SELECT p_partkey AS course_id, p_partkey % 25 AS department_id, p_type AS category_code,
        CASE WHEN p_partkey = 0 THEN 'SER001' ELSE 'CRS' || p_partkey END AS course_code, p_name AS course_title,
        p_brand AS course_description, 1 + p_size % 4 AS credit_units, 1 + p_partkey % 5 AS level_id,
        CASE p_partkey % 3 WHEN 0 THEN 'First' WHEN 1 THEN 'Second' ELSE 'Both' END AS semester_offered,
        p_partkey % 50 = 0 AS is_compulsory_se,
        CAST(DATE '1996-01-01' + CAST(p_partkey % 1461 AS INTEGER) AS TIMESTAMP) AS updated_at FROM part""",
    "prerequisite": """SELECT p_partkey AS course_id, p_partkey - 1 AS required_course_id,
        CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'E' END AS min_grade FROM part WHERE p_partkey % 3 = 0 AND p_partkey > 0""",
    "student": """SELECT c_custkey AS student_id, c_name AS student_matric_no, split_part(c_name, '#', 1) AS first_name,
        split_part(c_name, '#', 2) AS last_name, CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
        n_name AS state_of_origin, c_nationkey * 100 + position AS programme_id, 1 + c_custkey % 5 AS current_level_id,
        1995 + c_custkey % 7 AS admission_session_id,
        CASE WHEN c_acctbal < 0 THEN 'Suspended' ELSE 'Active' END AS enrollment_status,
        CAST(DATE '1996-01-01' + CAST(c_custkey % 1461 AS INTEGER) AS TIMESTAMP) AS updated_at
        FROM customer JOIN segment USING (c_mktsegment) JOIN nation ON n_nationkey = c_custkey * 7 % 25""",
    "staff": """SELECT s_suppkey AS staff_id, s_name AS staff_no, split_part(s_name, '#', 1) || ' ' || split_part(s_name, '#', 2) AS full_name,
        s_nationkey AS department_id, CASE WHEN s_acctbal >= 5000 THEN 'Professor' ELSE 'Lecturer' END AS designation,
        s_acctbal >= 0 AS is_active, CAST(DATE '1996-01-01' + CAST(s_suppkey % 1461 AS INTEGER) AS TIMESTAMP) AS updated_at FROM supplier""",
    "first_line": f"""SELECT * FROM (
        SELECT l.*, o_custkey, o_orderdate, {sem_of('o_orderdate')} AS semester_id,
            row_number() OVER (PARTITION BY o_custkey, l_partkey, {sem_of('o_orderdate')}
                ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_quantity, l_returnflag, l_linestatus) AS rn
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1""",
    "registration": """SELECT l_orderkey, l_partkey, o_custkey AS student_id, l_partkey AS course_id, semester_id,
        o_orderdate AS registration_date, CASE WHEN l_linenumber = 7 THEN 'Dropped' ELSE 'Registered' END AS registration_status,
        CASE WHEN l_partkey % 50 = 0 THEN 'COMPULSORY_SE' WHEN l_returnflag = 'N' THEN 'MAJOR' ELSE 'ELECTIVE' END AS course_type_taken
        FROM first_line""",
    "result": f"""SELECT s.*, {band(0)} AS grade, {band(3)} AS tenths,
        CASE WHEN remark = 'Pass' THEN 1 + p_size % 4 ELSE 0 END AS credit_units_earned, CAST({band(3)} / 10.0 AS DECIMAL(3,1)) AS grade_point
        FROM (SELECT q.*, ca_score + exam_score AS total_score,
                CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'Absent'
                     WHEN ca_score + exam_score >= 40 THEN 'Pass' ELSE 'Fail' END AS remark
              FROM (SELECT *, CAST(CAST(floor(l_quantity) AS INTEGER) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(5,2)) AS ca_score,
                    CAST((l_orderkey * 3 + l_partkey * 7 + l_linenumber * 11) % 71 AS DECIMAL(5,2)) AS exam_score
                    FROM first_line WHERE l_linestatus = 'F') q) s
        JOIN part ON p_partkey = l_partkey""",
    "assignment": "SELECT DISTINCT l_partkey AS course_id, semester_id, l_suppkey AS staff_id FROM first_line WHERE l_linenumber = 1",
    "lecturer": "SELECT course_id, semester_id, min(staff_id) AS staff_id FROM assignment GROUP BY ALL",
    "audit": f"""SELECT event_id AS audit_id, user_id AS student_id, event_id % (SELECT count(*) FROM part) AS course_id,
        {sem_of('ts')} AS semester_id, ts AS attempt_time, CAST(floor(value) AS BIGINT) % 3 AS prereqs_failed,
        CAST(floor(value) AS BIGINT) % 3 = 0 AS was_late FROM events WHERE event_type = 'error'""",
    "change": """SELECT * FROM (SELECT o_custkey AS student_id, CAST(o_orderdate AS DATE) AS changed_on, o_orderpriority AS programme_name,
            o_orderstatus AS enrollment_status, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                ORDER BY o_orderkey DESC, o_orderpriority DESC, o_orderstatus DESC) AS rn FROM orders) WHERE rn = 1""",
    "history": """SELECT student_id, programme_name, enrollment_status, changed_on AS valid_from,
        coalesce(lead(changed_on) OVER (PARTITION BY student_id ORDER BY changed_on), DATE '9999-12-31') AS valid_to FROM change""",
    "flat": """SELECT student_id, student_matric_no, first_name || ' ' || last_name AS full_name, first_name, last_name, gender,
        state_of_origin, programme_name, faculty_name, department_name, level_name, level_number, degree_code AS degree_type,
        session_name AS admission_year, enrollment_status, s.updated_at
        FROM student s JOIN programme p USING (programme_id) JOIN department d ON d.department_id = p.department_id
        JOIN faculty f ON f.faculty_id = d.faculty_id JOIN student_level l ON l.level_id = s.current_level_id
        JOIN degree_type t ON t.degree_type_id = p.degree_type_id JOIN session n ON n.session_id = s.admission_session_id""",
    "dim_course": """SELECT c.*, faculty_name, f.abbreviation AS faculty_abbreviation, department_name, level_name, level_number,
        coalesce(n, 0) AS prerequisite_count FROM course c JOIN department d USING (department_id) JOIN faculty f USING (faculty_id)
        JOIN student_level l USING (level_id) LEFT JOIN (SELECT course_id, count(*) AS n FROM prerequisite GROUP BY 1) q USING (course_id)""",
    "dim_staff": """SELECT staff_id, staff_no, full_name, department_name, faculty_name, designation, is_active
        FROM staff JOIN department USING (department_id) JOIN faculty USING (faculty_id)""",
    "enrollment": """SELECT r.student_id, r.course_id, r.semester_id, l.staff_id, g.state_name, r.registration_date, x.l_shipdate AS entered_at,
        r.course_type_taken, r.registration_status, ca_score, exam_score, total_score, grade, grade_point, tenths, c.credit_units,
        credit_units_earned, coalesce(remark = 'Pass', false) AS is_pass, coalesce(grade = 'A', false) AS is_distinction,
        coalesce(grade = 'B', false) AS is_credit, coalesce(remark = 'Fail', false) AS is_fail, coalesce(remark = 'Absent', false) AS is_absent,
        CAST(r.registration_date AS DATE) > reg_deadline AS is_late_registration, course_type_taken = 'MAJOR' AS is_major_course,
        course_type_taken = 'ELECTIVE' AS is_elective_course, course_type_taken = 'COMPULSORY_SE' AS is_compulsory_se
        FROM result x JOIN registration r ON r.l_orderkey = x.l_orderkey AND r.l_partkey = x.l_partkey
        JOIN course c ON c.course_id = r.course_id JOIN semester s ON s.semester_id = r.semester_id
        JOIN student st ON st.student_id = r.student_id LEFT JOIN geography g ON g.state_name = st.state_of_origin
        LEFT JOIN lecturer l ON l.course_id = r.course_id AND l.semester_id = r.semester_id""",
    "session_gpa": f"""SELECT student_id, session_id, sum(credit_units) AS attempted, sum(credit_units_earned) AS earned, count(*) AS registered,
        count(*) FILTER (is_pass) AS passed, count(*) FILTER (is_fail) AS failed, count(*) FILTER (is_absent) AS absent,
        CAST(100 * {rounded('sum(tenths * credit_units)', 'sum(credit_units) * 10', 2)} AS BIGINT) AS gpa
        FROM enrollment JOIN semester USING (semester_id) GROUP BY 1, 2""",
    "gpa": f"""SELECT g.*, CAST(100 * {rounded('sum(gpa) OVER w', 'count(*) OVER w * 100', 2)} AS BIGINT) AS cgpa FROM session_gpa g
        WINDOW w AS (PARTITION BY student_id ORDER BY session_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "gpa_fact": """SELECT g.*, semester_id, session_name, semester_name, coalesce(cgpa >= 450, false) AS is_first_class,
        coalesce(cgpa BETWEEN 350 AND 449, false) AS is_second_class_upper, coalesce(cgpa BETWEEN 240 AND 349, false) AS is_second_class_lower,
        coalesce(cgpa BETWEEN 150 AND 239, false) AS is_third_class, coalesce(cgpa < 150, false) AS is_at_risk
        FROM gpa g JOIN period p USING (session_id) WHERE p.semester_name = 'Second'""",
    "event": """SELECT r.student_id, r.course_id, r.semester_id, CAST(registration_date AS DATE) AS day, start_date, reg_deadline,
            CAST(registration_date AS DATE) > reg_deadline AS was_late, false AS was_rejected, 0 AS prereqs_failed,
            registration_status, NULL AS rejection_reason FROM registration r JOIN semester USING (semester_id) JOIN student USING (student_id)
            JOIN course USING (course_id)
        UNION ALL SELECT a.student_id, a.course_id, a.semester_id, CAST(attempt_time AS DATE), start_date, reg_deadline, was_late, true,
            prereqs_failed, 'Rejected', CASE WHEN was_late THEN 'Registration deadline passed' ELSE 'Prerequisites not satisfied' END
            FROM audit a JOIN semester USING (semester_id) JOIN student USING (student_id) JOIN course USING (course_id)""",
    "calendar": """SELECT CAST(d AS DATE) AS full_date FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (
        SELECT CAST(make_date(year(min(m)), 1, 1) AS TIMESTAMP) AS lo, CAST(make_date(year(max(m)), 12, 31) AS TIMESTAMP) AS hi
        FROM (SELECT o_orderdate AS m FROM orders UNION ALL SELECT ts FROM events)))""",
    "run_log": """SELECT CAST(strftime(hour, '%Y%m%d%H') AS BIGINT) AS etl_run_id, lo AS run_started_at,
        CASE WHEN status <> 'RUNNING' THEN hi END AS run_finished_at, status, rows_inserted, rows_updated, scd2_rows_closed, dq_errors, dq_warnings,
        CASE WHEN status = 'FAILED' THEN dq_errors || ' DQ errors blocked the load.' END AS error_message, 'scheduler' AS triggered_by
        FROM (SELECT *, CASE WHEN date_part('hour', hour) = 0 THEN 'RUNNING' WHEN dq_errors > 0 THEN 'FAILED'
                WHEN n % 7 = 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
              FROM (SELECT date_trunc('hour', ts) AS hour, min(ts) AS lo, max(ts) AS hi, count(*) AS n,
                    count(*) FILTER (event_type = 'purchase') AS rows_inserted, count(*) FILTER (event_type = 'click') AS rows_updated,
                    count(*) FILTER (event_type = 'signup') AS scd2_rows_closed,
                    count(*) FILTER (event_type = 'error' AND value > 200) AS dq_errors,
                    count(*) FILTER (event_type = 'view' AND value > 100) AS dq_warnings FROM events GROUP BY 1))""",
    "watermark": """SELECT 'student' AS entity, max(updated_at) AS seen FROM student UNION ALL SELECT 'course', max(updated_at) FROM course
        UNION ALL SELECT 'staff', max(updated_at) FROM staff UNION ALL SELECT 'course_registration', max(registration_date) FROM registration
        UNION ALL SELECT 'course_result', max(l_shipdate) FROM result UNION ALL SELECT 'semester', CAST(max(start_date) AS TIMESTAMP) FROM semester
        UNION ALL SELECT 'academic_session', CAST(make_date(max(session_id), 1, 1) AS TIMESTAMP) FROM semester""",
    "snapshot_1": """SELECT student_id, programme_name, enrollment_status FROM change WHERE changed_on <= DATE '1997-12-31'
        QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY changed_on DESC) = 1""",
    "snapshot_2": """SELECT student_id, programme_name, enrollment_status FROM change WHERE changed_on <= DATE '1999-12-31'
        QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY changed_on DESC) = 1""",
    "scd2": """SELECT student_id, 1 AS version, a.programme_name, a.enrollment_status, DATE '1997-12-31' AS effective_date,
            CASE WHEN b.programme_name <> a.programme_name OR b.enrollment_status <> a.enrollment_status THEN DATE '1999-12-31' ELSE DATE '9999-12-31' END AS expiry_date,
            NOT (b.programme_name <> a.programme_name OR b.enrollment_status <> a.enrollment_status) AS is_current
            FROM snapshot_1 a JOIN snapshot_2 b USING (student_id)
        UNION ALL SELECT student_id, CASE WHEN a.student_id IS NULL THEN 1 ELSE 2 END, b.programme_name, b.enrollment_status, DATE '1999-12-31',
            DATE '9999-12-31', true FROM snapshot_2 b LEFT JOIN snapshot_1 a USING (student_id)
            WHERE a.student_id IS NULL OR b.programme_name <> a.programme_name OR b.enrollment_status <> a.enrollment_status""",
    "request": f"""SELECT event_id AS request_id, user_id AS student_id, CAST(floor(value) AS BIGINT) AS course_id,
        CASE event_id % 10 WHEN 0 THEN 20012 WHEN 1 THEN 20999 ELSE {sem_of('ts')} END AS semester_id, ts FROM events""",
}

_WORD = re.compile(r"[a-z_0-9]+")


def with_base(sql: str, recursive: bool = False) -> str:
    """The statement with the common table expressions it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in _WORD.findall(re.sub(r"'[^']*'", "", text)):
            if word in BASE and word not in needed and re.search(rf"(FROM|JOIN)\s+{word}\b", text):
                visit(BASE[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS MATERIALIZED ({BASE[name]})" for name in needed)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return f"{head}{parts}\n{',' if sql.lstrip().startswith(',') else ''}{sql.lstrip().lstrip(',')}"


def iso(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column.split('.')[-1]}"


def iso_ts(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column.split('.')[-1]}"


def n(expression: str, name: str) -> str:
    """A whole number as BIGINT."""
    return f"CAST({expression} AS BIGINT) AS {name}"


def count_if(condition: str, name: str) -> str:
    return f"count(*) FILTER ({condition}) AS {name}"


def mean(units: str, counted: str, scale: int, digits: int, name: str) -> str:
    """Mean of a column given in units of 10^-scale."""
    return f"{rounded(f'sum({units})', f'count({counted}) * {10 ** scale}', digits)} AS {name}"


def pct(part: str, whole: str, name: str) -> str:
    return f"{rounded(f'100 * {part}', whole, 1)} AS {name}"


FACT = "enrollment JOIN flat USING (student_id) JOIN period USING (semester_id)"
GPA = "gpa_fact JOIN flat USING (student_id)"
ENROLLMENT_FLAGS = ("is_pass", "is_distinction", "is_credit", "is_fail", "is_absent", "is_late_registration", "is_major_course", "is_elective_course", "is_compulsory_se")
STANDING = ("is_first_class", "is_second_class_upper", "is_second_class_lower", "is_third_class", "is_at_risk")
DEGREE = "CASE WHEN cgpa >= 450 THEN '1st Class' WHEN cgpa >= 350 THEN '2nd Class Upper' WHEN cgpa >= 240 THEN '2nd Class Lower' WHEN cgpa >= 150 THEN '3rd Class' ELSE 'Pass / Probation' END"
RISK = "CASE WHEN cgpa < 150 THEN 'Critical — Probation Risk' WHEN cgpa < 240 THEN 'Warning — Third Class Range' WHEN failed >= 3 THEN 'Warning — Multiple Failures' ELSE 'Monitor' END"

FACULTY_PERFORMANCE = f"""SELECT faculty_name, session_name, semester_name, count(DISTINCT student_id) AS total_students, count(*) AS total_enrollments,
    {mean(SCORE, 'total_score', 2, 1, 'avg_total_score')}, {mean('tenths', 'tenths', 1, 2, 'avg_grade_point')},
    {count_if('is_pass', 'total_passes')}, {count_if('is_fail', 'total_failures')}, {count_if('is_distinction', 'total_distinctions')},
    {pct('count(*) FILTER (is_pass)', 'count(*)', 'pass_rate_pct')}, {pct('count(*) FILTER (is_fail)', 'count(*)', 'failure_rate_pct')},
    {pct('count(*) FILTER (is_distinction)', 'count(*)', 'distinction_rate_pct')}
    FROM {FACT} GROUP BY 1, 2, 3"""

FAILURES = f"""SELECT course_code, course_title, faculty_name, department_name, level_name, credit_units, session_name, semester_name,
    count(*) AS total_enrolled, {count_if('is_pass', 'passed')}, {count_if('is_fail', 'failed')},
    {pct('count(*) FILTER (is_fail)', 'count(*)', 'failure_rate_pct')}, {mean(SCORE, 'total_score', 2, 1, 'avg_score')},
    CASE WHEN 100 * count(*) FILTER (is_fail) > 40 * count(*) THEN 'HIGH RISK'
         WHEN 100 * count(*) FILTER (is_fail) > 25 * count(*) THEN 'ELEVATED' ELSE 'NORMAL' END AS risk_flag
    FROM enrollment e JOIN (SELECT course_id, course_code, course_title, faculty_name, department_name, level_name FROM dim_course) d USING (course_id)
    JOIN period USING (semester_id) GROUP BY course_id, course_code, course_title, faculty_name, department_name, level_name, credit_units,
    session_name, semester_name HAVING count(*) >= 5"""

AT_RISK = f"""SELECT student_matric_no, full_name, faculty_name, department_name, programme_name, level_name, cgpa / 100.0 AS cgpa,
    failed AS courses_failed, registered AS courses_registered, {n('earned', 'total_credits_earned')}, {RISK} AS risk_level, session_name AS latest_session
    FROM {GPA} WHERE is_at_risk OR failed >= 3 OR cgpa < 240"""

BEHAVIOUR = f"""SELECT faculty_name, level_name, session_name, semester_name, count(*) AS total_registrations, {count_if('was_late', 'late_registrations')},
    {count_if('was_rejected', 'rejected_registrations')},
    {rounded("sum(date_diff('day', day, e.reg_deadline))", 'count(*)', 1)} AS avg_days_before_deadline, {pct('count(*) FILTER (was_late)', 'count(*)', 'late_rate_pct')}
    FROM event e JOIN flat USING (student_id) JOIN period USING (semester_id) GROUP BY 1, 2, 3, 4"""

RANKING = f"""SELECT *, {pct('first_class_count', 'student_count', 'first_class_pct')}, rank() OVER (PARTITION BY session_name ORDER BY avg_cgpa DESC NULLS LAST) AS cgpa_rank
    FROM (SELECT faculty_name, department_name, session_name, {mean('gpa', 'gpa', 2, 2, 'avg_session_gpa')}, {mean('cgpa', 'cgpa', 2, 2, 'avg_cgpa')},
        count(DISTINCT student_id) AS student_count, {count_if('is_first_class', 'first_class_count')},
        {count_if('is_second_class_upper', 'sc_upper_count')}, {count_if('is_at_risk', 'at_risk_count')} FROM {GPA} GROUP BY 1, 2, 3)"""

PROGRESSION = f"""SELECT student_matric_no, full_name, faculty_name, programme_name, session_name, semester_name, gpa / 100.0 AS session_gpa, cgpa / 100.0 AS cgpa,
    (cgpa - lag(cgpa) OVER (PARTITION BY student_id ORDER BY session_id, semester_name)) / 100.0 AS cgpa_delta, registered AS courses_registered,
    passed AS courses_passed, failed AS courses_failed, {n('earned', 'total_credits_earned')}, {DEGREE} AS class_of_degree, CAST(is_at_risk AS BIGINT) AS is_at_risk
    FROM {GPA}"""

TIMELINE = f"""SELECT session_name, semester_name, {iso('day', 'registration_date')}, strftime(day, '%A') AS day_name,
    date_diff('day', start_date, day) AS day_of_semester, date_diff('day', day, reg_deadline) AS days_until_deadline, daily_registrations,
    {n('sum(daily_registrations) OVER (PARTITION BY semester_id ORDER BY day)', 'cumulative_registrations')}, late_registrations, rejected_attempts
    FROM (SELECT e.semester_id, session_name, semester_name, day, p.start_date, p.reg_deadline, count(*) AS daily_registrations,
        {count_if('was_late', 'late_registrations')}, {count_if('was_rejected', 'rejected_attempts')}
        FROM event e JOIN period p ON p.semester_id = e.semester_id GROUP BY ALL)"""

HEALTH = f"""SELECT etl_run_id, {iso_ts('run_started_at')}, {iso_ts('run_finished_at')}, status,
    date_diff('second', run_started_at, run_finished_at) AS duration_seconds, rows_inserted, rows_updated, scd2_rows_closed, dq_errors, dq_warnings, triggered_by,
    CASE WHEN status = 'SUCCESS' AND dq_warnings = 0 THEN 'Healthy' WHEN status = 'SUCCESS' THEN 'Healthy with Warnings'
         WHEN status = 'PARTIAL' THEN 'Partial — Check Logs' WHEN status = 'FAILED' THEN 'FAILED — Action Required' ELSE 'Unknown' END AS health_status,
    error_message FROM run_log"""

LOADS = """SELECT faculty_name, level_name, session_name, semester_name, CAST(1 AS BIGINT) AS students, CAST(min(units) OVER w AS BIGINT) AS min_credits,
    CAST(max(units) OVER w AS BIGINT) AS max_credits, {mean} AS avg_credits
    FROM (SELECT student_id, faculty_name, level_name, semester_id, session_name, semester_name, sum(credit_units) AS units
        FROM enrollment JOIN flat USING (student_id) JOIN period USING (semester_id) GROUP BY ALL)
    WINDOW w AS (PARTITION BY faculty_name, level_name, semester_id)"""

TRANSCRIPT = f"""SELECT student_matric_no, first_name || ' ' || last_name AS student_name, session_name, semester_name, level_name, course_code, course_title,
    credit_units, course_type_taken, CAST(ca_score AS DOUBLE) AS ca_score, CAST(exam_score AS DOUBLE) AS exam_score, CAST(total_score AS DOUBLE) AS total_score,
    grade, tenths / 10.0 AS grade_point, {n('credit_units_earned', 'credit_units_earned')}, remark
    FROM registration r JOIN student USING (student_id) JOIN course c USING (course_id) JOIN period USING (semester_id)
    JOIN student_level l ON l.level_id = c.level_id LEFT JOIN result x ON x.l_orderkey = r.l_orderkey AND x.l_partkey = r.l_partkey"""

COMPLIANCE = """SELECT student_matric_no, first_name || ' ' || last_name AS student_name, level_name, faculty_name, department_name,
    CASE WHEN r.student_id IS NOT NULL THEN 'Registered' ELSE 'NOT Registered' END AS ser001_status
    FROM flat f LEFT JOIN (SELECT student_id FROM registration WHERE course_id = (SELECT course_id FROM course WHERE course_code = 'SER001')) r USING (student_id)
    WHERE level_number = 100"""

DQ_TEXT = {
    "DQ-01": ("Students with NULL programme_id", "STUDENT", "ERROR", "students have no programme assigned."),
    "DQ-02": ("Results with total_score > 100", "RESULTS", "ERROR", "results have total_score exceeding 100."),
    "DQ-03": ("Registrations after semester end date", "REGISTRATION", "WARNING", "registrations have dates after semester end."),
    "DQ-04": ("100L students not registered for SER001", "REGISTRATION", "WARNING", "active 100L students have not registered SER001 this semester."),
    "DQ-05": ("Students exceeding 24 credit unit limit", "REGISTRATION", "ERROR", "student-semester combinations exceed 24 credit unit maximum."),
    "DQ-06": ("Results exist for Dropped registrations", "RESULTS", "WARNING", "results found for registrations with status=Dropped."),
    "DQ-07": ("Duplicate matric numbers", "STUDENT", "ERROR", "matric numbers appear more than once."),
    "DQ-08": ("Closed semesters with zero registrations", "COURSE", "WARNING", "past semesters have no course registrations at all."),
    "DQ-09": ("Grade does not match total score range", "RESULTS", "ERROR", "results have a grade that does not match the score-to-grade mapping."),
    "DQ-10": ("Registrations with no result after semester ended", "RESULTS", "WARNING", "past-semester registrations have no result entered."),
}

DQ_COUNT = {
    "DQ-01": "SELECT count(*) FROM student WHERE programme_id IS NULL",
    "DQ-02": "SELECT count(*) FROM result WHERE total_score > 100",
    "DQ-03": "SELECT count(*) FROM registration JOIN semester USING (semester_id) WHERE CAST(registration_date AS DATE) > end_date",
    "DQ-04": """SELECT count(*) FROM student s JOIN semester m ON m.is_current WHERE current_level_id = 1 AND enrollment_status = 'Active'
        AND NOT EXISTS (SELECT 1 FROM registration r WHERE r.student_id = s.student_id AND r.semester_id = m.semester_id AND r.course_id = 0)""",
    "DQ-05": """SELECT count(*) FROM (SELECT student_id, semester_id FROM registration JOIN course USING (course_id) GROUP BY 1, 2
        HAVING sum(credit_units) > 24)""",
    "DQ-06": """SELECT count(*) FROM result x JOIN registration r ON r.l_orderkey = x.l_orderkey AND r.l_partkey = x.l_partkey
        WHERE registration_status = 'Dropped'""",
    "DQ-07": "SELECT count(*) FROM (SELECT student_matric_no FROM student GROUP BY 1 HAVING count(*) > 1)",
    "DQ-08": """SELECT count(*) FROM semester s WHERE end_date < DATE '2025-01-01'
        AND NOT EXISTS (SELECT 1 FROM registration r WHERE r.semester_id = s.semester_id)""",
    "DQ-09": "SELECT count(*) FROM result JOIN grade_scale USING (grade) WHERE total_score NOT BETWEEN min_score AND max_score",
    "DQ-10": """SELECT count(*) FROM registration r JOIN semester USING (semester_id) WHERE end_date < DATE '2025-01-01'
        AND registration_status = 'Registered'
        AND NOT EXISTS (SELECT 1 FROM result x WHERE x.l_orderkey = r.l_orderkey AND x.l_partkey = r.l_partkey)""",
}


def one(count: str) -> str:
    return f"SELECT n AS records_flagged FROM ({count.replace('SELECT count(*)', 'SELECT count(*) AS n', 1)})"


def dq_row(check: str) -> str:
    name, category, severity, text = DQ_TEXT[check]
    return f"""SELECT '{check}' AS check_id, '{name}' AS check_name, '{category}' AS check_category, '{severity}' AS severity,
        n AS records_flagged, n || ' {text}' AS detail FROM ({DQ_COUNT[check].replace('SELECT count(*)', 'SELECT count(*) AS n', 1)})"""


DQ_ALL = " UNION ALL ".join(dq_row(c) for c in DQ_TEXT)

CHECK_DATES = ("1996-01-01", "1999-01-01", "2025-01-01")


def dq_log() -> str:
    """The checks that flag something at each of the dates."""
    of = lambda d: DQ_ALL.replace("2025-01-01", d)
    return " UNION ALL ".join(f"SELECT *, CAST(TIMESTAMP '{d} 00:00:00' AS VARCHAR) AS checked_at, {n} AS etl_run_id FROM ({of(d)}) WHERE records_flagged > 0" for n, d in enumerate(CHECK_DATES, 1))


def outcome(source: str, run: int, day: str, passed: str = "") -> str:
    """The log row of a load at a day; `passed` lists checks that the source satisfies."""
    return f"""SELECT '{source}' AS source, {run} AS etl_run_id, CASE WHEN count(*) FILTER (severity = 'ERROR') = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
        count(*) FILTER (severity = 'ERROR') AS dq_errors, count(*) FILTER (severity = 'WARNING') AS dq_warnings
        FROM ({DQ_ALL.replace("2025-01-01", day)}) WHERE records_flagged > 0 AND check_id NOT IN ('none'{passed})"""


VISIBLE = "SELECT student_id, student_matric_no FROM student"
TAUGHT = "SELECT student_id FROM registration WHERE course_id IN (SELECT course_id FROM assignment WHERE staff_id = 5)"

REQUEST_RULES = """ruled AS (
    SELECT q.request_id, q.student_id, q.course_id, q.semester_id, s.reg_deadline, CAST(q.ts AS DATE) > s.reg_deadline AS late, c.credit_units AS units,
        EXISTS (SELECT 1 FROM registration r WHERE r.student_id = q.student_id AND r.course_id = q.course_id AND r.semester_id = q.semester_id) AS held_course,
        coalesce((SELECT sum(rc.credit_units) FROM registration r JOIN course rc ON rc.course_id = r.course_id
            WHERE r.student_id = q.student_id AND r.semester_id = q.semester_id), 0) AS held,
        (SELECT count(*) FROM prerequisite p LEFT JOIN registration r ON r.course_id = p.required_course_id AND r.student_id = q.student_id
            LEFT JOIN result x ON x.l_orderkey = r.l_orderkey AND x.l_partkey = r.l_partkey
            WHERE p.course_id = q.course_id AND (x.grade IS NULL OR x.grade > p.min_grade)) AS unmet
    FROM request q LEFT JOIN semester s ON s.semester_id = q.semester_id LEFT JOIN course c ON c.course_id = q.course_id)"""

MESSAGE = """CASE WHEN reg_deadline IS NULL THEN 'ERROR: Invalid semester.' WHEN late THEN 'ERROR: Registration deadline has passed.'
    WHEN held_course OR repeated THEN 'ERROR: Already registered for this course.'
    WHEN over THEN 'ERROR: Registration would exceed 24 credit unit maximum.'
    WHEN unmet > 0 THEN 'ERROR: ' || unmet || ' prerequisite(s) not satisfied.'
    WHEN units IS NULL THEN 'ERROR: Unknown course.' ELSE 'SUCCESS: Course registered successfully.' END"""

AUDITED = """SELECT request_id, message,
    CASE WHEN message LIKE '%deadline%' THEN 'Registration deadline passed' WHEN message LIKE '%prerequisite%' THEN 'Prerequisites not satisfied' END AS rejection_reason,
    CAST(CASE WHEN message LIKE '%deadline%' THEN 1 WHEN message LIKE '%prerequisite%' THEN 0 END AS BIGINT) AS was_late,
    CAST(CASE WHEN message LIKE '%deadline%' THEN 0 WHEN message LIKE '%prerequisite%' THEN unmet END AS BIGINT) AS prereqs_failed"""

CAN_PASS = "reg_deadline IS NOT NULL AND NOT late AND NOT held_course AND unmet = 0 AND units IS NOT NULL"

VALIDATION = f""", {REQUEST_RULES}, judged AS (
    SELECT *, false AS over, ({CAN_PASS}) AND row_number() OVER (PARTITION BY student_id, course_id, semester_id, ({CAN_PASS}) ORDER BY request_id) > 1 AS repeated FROM ruled)
    {AUDITED} FROM (SELECT *, {MESSAGE} AS message FROM judged)"""

# The requests of a (student, semester) taken one by one, in order.
GREEDY = f""", {REQUEST_RULES},
    lined AS (SELECT *, row_number() OVER (PARTITION BY student_id, semester_id ORDER BY request_id) AS turn FROM ruled
        WHERE reg_deadline IS NOT NULL AND NOT late AND NOT held_course),
    walk AS (
        SELECT student_id, semester_id, CAST(0 AS BIGINT) AS turn, CAST(held AS BIGINT) AS load, CAST([] AS BIGINT[]) AS courses,
            CAST(NULL AS BIGINT) AS request_id, false AS repeated, false AS over FROM (SELECT DISTINCT student_id, semester_id, held FROM lined)
        UNION ALL
        SELECT student_id, semester_id, turn, CASE WHEN accepted THEN load + units ELSE load END,
            CASE WHEN accepted THEN list_append(courses, course_id) ELSE courses END, request_id, repeated, over
        FROM (SELECT w.student_id, w.semester_id, l.turn, w.load, w.courses, l.request_id, l.course_id, CAST(l.units AS BIGINT) AS units,
                list_contains(w.courses, l.course_id) AS repeated, coalesce(w.load + l.units > 24, false) AS over,
                NOT list_contains(w.courses, l.course_id) AND coalesce(w.load + l.units <= 24, false) AND l.unmet = 0 AS accepted
              FROM walk w JOIN lined l ON l.student_id = w.student_id AND l.semester_id = w.semester_id AND l.turn = w.turn + 1))
    {AUDITED} FROM (SELECT *, {MESSAGE} AS message FROM (
        SELECT r.*, coalesce(w.repeated, false) AS repeated, coalesce(w.over, false) AS over FROM ruled r LEFT JOIN walk w ON w.request_id = r.request_id))"""

PROMOTION = f"""SELECT student_id, CAST(2000 AS BIGINT) AS session_id, {n('level_number', 'level_number')},
    {n('CASE WHEN current_level_id < 7 THEN current_level_id + 1 END', 'new_level_id')}, gpa / 100.0 AS gpa, {n('coalesce(earned, 0)', 'total_credits_earned')},
    CASE WHEN current_level_id < 7 THEN 'SUCCESS: Promoted to ' || (level_number + 100) || 'L. GPA: '
        || coalesce(printf('%d.%02d', gpa // 100, gpa % 100), '') ELSE 'INFO: Student at maximum level — eligible for graduation.' END AS message
    FROM student s JOIN student_level l ON l.level_id = s.current_level_id
    LEFT JOIN (SELECT student_id, gpa, earned FROM session_gpa WHERE session_id = 2000) g USING (student_id)"""

EVENT_VERSIONS = """SELECT user_id, event_type, count(*) AS versions, count(*) FILTER (nxt IS NULL) AS open,
    CAST(sum(CAST(floor((epoch_us(nxt) - epoch_us(ts)) / 1000000) AS BIGINT)) AS BIGINT) AS seconds
    FROM (SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt
          FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)) GROUP BY 1, 2"""

HISTORY = f"SELECT student_id, programme_name, enrollment_status, {iso('valid_from')}, {iso('valid_to')} FROM history"

ROW_COUNTS = {
    "academic_session": "session", "semester": "semester", "student_level": "student_level", "degree_type": "degree_type",
    "grade_scale": "grade_scale", "college": "(SELECT 1)", "faculty": "faculty", "department": "department", "programme": "programme",
    "course_category": "category", "course": "course", "course_prerequisite": "prerequisite",
    "programme_course": "(SELECT 1 FROM programme JOIN course USING (department_id) WHERE is_compulsory_se)", "student": "student",
    "course_registration": "registration", "registration_audit": "audit", "course_result": "result", "staff": "staff",
    "course_assignment": "assignment", "security_user_map": "range(4)", "etl_watermark": "watermark", "etl_log": "run_log",
    "dim_date": "calendar", "dim_student": "flat", "dim_course": "dim_course", "dim_academic_period": "period", "dim_staff": "dim_staff",
    "dim_geography": "geography", "fact_enrollment": "enrollment", "fact_student_gpa": "gpa_fact", "fact_registration_event": "event",
}

HALF = "TIMESTAMP '1998-06-30'"
HALF_GPA = f"""SELECT g.*, CAST(100 * {rounded('sum(gpa) OVER w', 'count(*) OVER w * 100', 2)} AS BIGINT) AS cgpa
    FROM (SELECT student_id, session_id, sum(credit_units) AS attempted, sum(credit_units_earned) AS earned, count(*) AS registered,
        CAST(100 * {rounded('sum(tenths * credit_units)', 'sum(credit_units) * 10', 2)} AS BIGINT) AS gpa
        FROM enrollment JOIN semester USING (semester_id) WHERE entered_at <= {HALF} GROUP BY 1, 2) g
    WINDOW w AS (PARTITION BY student_id ORDER BY session_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

STATEMENTS = {
    # sources
    "seed_key_resolution": """SELECT CAST(department_id AS BIGINT) AS department_id, category_id, title,
        (SELECT count(*) FROM course c WHERE c.department_id = d.department_id AND c.category_code = v.category) AS courses
        FROM (VALUES ('NATION_3','LARGE','Engines'),('NATION_10','PROMO','Posters'),('NATION_21','SMALL','Models'),('NOWHERE','SMALL','None')) v(dept, category, title)
        JOIN department d ON department_name = dept JOIN category ON p_type = v.category""",
    "calendar_attributes": """SELECT CASE WHEN month(day) >= 9 THEN year(day) || '/' || (year(day) + 1) ELSE (year(day) - 1) || '/' || year(day) END AS academic_year,
        CASE WHEN month(day) IN (9,10,11,12,1) THEN 'First Semester' WHEN month(day) BETWEEN 2 AND 6 THEN 'Second Semester' ELSE 'Vacation' END AS season,
        'Q' || quarter(day) AS quarter_name, CAST(isodow(day) >= 6 AS BIGINT) AS is_weekend, CAST(sum(n) AS BIGINT) AS registrations, count(*) AS days
        FROM (SELECT CAST(registration_date AS DATE) AS day, count(*) AS n FROM registration GROUP BY 1) GROUP BY 1, 2, 3, 4""",
    "dim_date": f"""SELECT {day_key('full_date')} AS date_key, {iso('full_date')}, strftime(full_date, '%A') AS day_name, day(full_date) AS day_num,
        weekofyear(full_date) AS week_num, month(full_date) AS month_num, strftime(full_date, '%B') AS month_name, quarter(full_date) AS quarter_num,
        'Q' || quarter(full_date) AS quarter_name, year(full_date) AS year_num,
        CASE WHEN month(full_date) >= 9 THEN year(full_date) || '/' || (year(full_date) + 1) ELSE (year(full_date) - 1) || '/' || year(full_date) END AS academic_year,
        CAST(NULL AS BIGINT) AS academic_week, CAST(dayofweek(full_date) IN (0, 6) AS BIGINT) AS is_weekend, CAST(0 AS BIGINT) AS is_holiday,
        CASE WHEN month(full_date) IN (9,10,11,12,1) THEN 'First Semester' WHEN month(full_date) BETWEEN 2 AND 6 THEN 'Second Semester' ELSE 'Vacation' END AS season
        FROM calendar""",
    "zone_distribution": "SELECT geopolitical_zone, count(*) AS students FROM student JOIN geography ON state_name = state_of_origin GROUP BY 1",
    "incremental_extract": f"""SELECT CAST(CAST(l_orderkey AS HUGEINT) * 10000000000000000000 + l_partkey AS VARCHAR) AS registration_id,
        CAST(total_score AS DOUBLE) AS total_score, {iso_ts('l_shipdate', 'updated_at')} FROM result
        WHERE l_shipdate > TIMESTAMP '2000-01-01' AND l_shipdate <= TIMESTAMP '2001-06-30'""",
    "watermark_pivot": "SELECT " + ", ".join(
        f"strftime(max(seen) FILTER (entity = '{e}'), '%Y-%m-%d %H:%M:%S') AS wm_{e}"
        for e in ("student", "course", "course_registration", "course_result", "academic_session", "semester", "staff")) + " FROM watermark",
    "type1_upsert": f"""SELECT course_id, course_code, CASE WHEN updated_at > TIMESTAMP '1998-01-01' THEN upper(course_title) ELSE course_title END AS course_title,
        credit_units, {iso_ts('updated_at')} FROM course""",
    "replace_affected_keys": """SELECT CAST(CAST(l_orderkey AS HUGEINT) * 10000000000000000000 + l_partkey AS VARCHAR) AS registration_id,
        CAST(CASE WHEN l_shipdate > TIMESTAMP '1999-01-01' THEN total_score + 1 ELSE total_score END AS DOUBLE) AS total_score FROM result""",
    "idempotent_append": f"SELECT {day_key('full_date')} AS date_key, {iso('full_date')}, strftime(full_date, '%A') AS day_name FROM calendar",
    # dimensions
    "dim_academic_period": f"""SELECT semester_id, session_name, semester_name, session_name || ' - ' || semester_name || ' Semester' AS full_period_name,
        year(start_date) AS academic_year, {iso('start_date')}, {iso('end_date')}, {iso('reg_deadline')}, date_diff('day', start_date, reg_deadline) AS reg_duration_days,
        date_diff('day', start_date, end_date) AS semester_duration_days, CAST(is_current AS BIGINT) AS is_current FROM period""",
    "dim_course": """SELECT course_id, course_code, course_title, course_description, credit_units, category_code, category_code AS category_name, department_name,
        faculty_name, faculty_abbreviation, level_name, level_number, semester_offered, CAST(is_compulsory_se AS BIGINT) AS is_compulsory_se, CAST(1 AS BIGINT) AS is_active,
        CAST(prerequisite_count > 0 AS BIGINT) AS has_prerequisites, prerequisite_count FROM dim_course""",
    "dim_staff": "SELECT staff_id, staff_no, full_name, department_name, faculty_name, designation, CAST(is_active AS BIGINT) AS is_active FROM dim_staff",
    "prereq_counts": "SELECT course_code, CAST(prerequisite_count > 0 AS BIGINT) AS has_prerequisites, prerequisite_count FROM dim_course",
    "snowflake_flatten": "SELECT * EXCLUDE (updated_at) FROM flat",
    "snowflake_changed": "SELECT student_id, faculty_name, level_name FROM flat WHERE updated_at > TIMESTAMP '1999-01-01'",
    "dim_student": """SELECT * EXCLUDE (updated_at), '2002-01-01' AS effective_date, '9999-12-31' AS expiry_date, CAST(1 AS BIGINT) AS is_current FROM flat""",
    "scd2_first_load": "SELECT student_id, programme_name, enrollment_status, '1997-12-31' AS effective_date, '9999-12-31' AS expiry_date, CAST(1 AS BIGINT) AS is_current FROM snapshot_1",
    "scd2_second_load": f"""SELECT student_id, CAST(version AS BIGINT) AS version, programme_name, enrollment_status, {iso('effective_date')}, {iso('expiry_date')},
        CAST(is_current AS BIGINT) AS is_current FROM scd2""",
    "scd2_counts": """SELECT count(*) FILTER (version = 1 AND effective_date = DATE '1999-12-31') AS rows_inserted, count(*) FILTER (version = 2) AS rows_updated,
        count(*) FILTER (NOT is_current) AS rows_closed FROM scd2""",
    "scd2_current": f"SELECT student_id, programme_name, enrollment_status, {iso('effective_date')} FROM scd2 WHERE is_current",
    "version_history": f"""SELECT student_id, programme_name, enrollment_status, {iso('effective_date')}, {iso('expiry_date')}, CAST(is_current AS BIGINT) AS is_current
        FROM scd2 WHERE student_id = 7""",
    "version_by_surrogate": """SELECT programme_name, year(day) AS year, count(*) AS orders FROM (
        SELECT CAST(o_orderdate AS DATE) AS day, programme_name FROM orders JOIN snapshot_1 ON student_id = o_custkey WHERE CAST(o_orderdate AS DATE) <= DATE '1997-12-31'
        UNION ALL SELECT CAST(o_orderdate AS DATE), programme_name FROM orders JOIN scd2 ON student_id = o_custkey AND is_current
            WHERE CAST(o_orderdate AS DATE) > DATE '1997-12-31') GROUP BY 1, 2""",
    "asof_dim_lookup": f"""SELECT r.student_id, course_id, semester_id, {iso('registration_date', 'day')}, programme_name, enrollment_status
        FROM registration r LEFT JOIN history h ON h.student_id = r.student_id AND valid_from <= CAST(registration_date AS DATE)
        AND CAST(registration_date AS DATE) < valid_to""",
    "faculty_performance_at_registration": f"""SELECT programme_name, count(*) AS results, {rounded('sum(tenths)', 'count(tenths) * 10', 4)} AS avg_grade_point
        FROM result x JOIN history h ON h.student_id = x.o_custkey AND valid_from <= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < valid_to GROUP BY 1""",
    # facts
    "fact_enrollment": f"""SELECT student_id, course_id, semester_id, staff_id, state_name, {day_key('registration_date')} AS reg_date_key, {day_key('entered_at')} AS result_date_key,
        course_type_taken, registration_status, CAST(ca_score AS DOUBLE) AS ca_score, CAST(exam_score AS DOUBLE) AS exam_score, CAST(total_score AS DOUBLE) AS total_score,
        grade, tenths / 10.0 AS grade_point, {n('credit_units', 'credit_units')}, {n('credit_units_earned', 'credit_units_earned')},
        {', '.join(f'CAST({f} AS BIGINT) AS {f}' for f in ENROLLMENT_FLAGS)} FROM enrollment""",
    "fact_enrollment_fanout": """SELECT e.semester_id, count(*) AS rows, count(a.staff_id) AS with_lecturer, CAST(sum(a.staff_id) AS BIGINT) AS staff_sum
        FROM enrollment e LEFT JOIN assignment a ON a.course_id = e.course_id AND a.semester_id = e.semester_id GROUP BY 1""",
    "enrollment_flags": f"SELECT semester_id, {', '.join(count_if(f, f) for f in ENROLLMENT_FLAGS)} FROM enrollment GROUP BY 1",
    "optional_dim_lookup": """SELECT geopolitical_zone, CAST(staff_id IS NOT NULL AS BIGINT) AS has_lecturer, count(*) AS enrollments
        FROM enrollment LEFT JOIN geography USING (state_name) GROUP BY 1, 2""",
    "weighted_gpa": f"SELECT student_id, session_id, gpa / 100.0 AS session_gpa, {n('attempted', 'credits_attempted')}, {n('earned', 'credits_earned')} FROM session_gpa",
    "running_cgpa": "SELECT student_id, session_id, gpa / 100.0 AS session_gpa, cgpa / 100.0 AS cgpa FROM gpa",
    "running_cgpa_weighted": f"""SELECT student_id, session_id, {rounded('sum(gpa * attempted) OVER w', 'sum(attempted) OVER w * 100', 2)} AS cgpa
        FROM session_gpa WINDOW w AS (PARTITION BY student_id ORDER BY session_id)""",
    "fact_student_gpa": f"""SELECT student_id, semester_id, state_name, gpa / 100.0 AS session_gpa, cgpa / 100.0 AS cgpa, {n('attempted', 'total_credits_attempted')},
        {n('earned', 'total_credits_earned')}, registered AS courses_registered, passed AS courses_passed, failed AS courses_failed, absent AS courses_absent,
        {', '.join(f'CAST({f} AS BIGINT) AS {f}' for f in STANDING)}
        FROM gpa_fact JOIN student USING (student_id) LEFT JOIN geography ON state_name = state_of_origin""",
    "fact_registration_event": f"""SELECT student_id, course_id, semester_id, {day_key('day')} AS attempt_date_key, date_diff('day', start_date, day) AS days_from_sem_start,
        date_diff('day', day, reg_deadline) AS days_before_deadline, CAST(was_late AS BIGINT) AS was_late, CAST(was_rejected AS BIGINT) AS was_rejected,
        {n('prereqs_failed', 'prereqs_failed')}, registration_status, rejection_reason FROM event""",
    "anti_join_orphans": """SELECT student_id, course_id, semester_id, registration_status FROM registration r
        WHERE NOT EXISTS (SELECT 1 FROM result x WHERE x.l_orderkey = r.l_orderkey AND x.l_partkey = r.l_partkey)""",
    # reports
    "faculty_performance": FACULTY_PERFORMANCE,
    "faculty_performance_durable": FACULTY_PERFORMANCE,
    "latest_session_filter": FACULTY_PERFORMANCE.replace("GROUP BY", "WHERE session_name = (SELECT session_name FROM period WHERE start_date <= DATE '2001-12-31' ORDER BY session_id DESC LIMIT 1) GROUP BY"),
    "at_risk_students": AT_RISK,
    "critical_students": f"SELECT * FROM ({AT_RISK}) WHERE risk_level = 'Critical — Probation Risk'",
    "case_bands": f"SELECT {DEGREE} AS class_of_degree, {RISK} AS risk_level, count(*) AS n FROM gpa_fact GROUP BY 1, 2",
    "ser001_compliance_rate": f"""SELECT f.faculty_name, p.session_name, count(DISTINCT f.student_id) AS "total_100L_students", CAST(sum(CAST(e.is_compulsory_se AS INTEGER)) AS BIGINT) AS ser001_registered,
        count(DISTINCT f.student_id) - count(DISTINCT e.student_id) AS ser001_missing, {pct('count(DISTINCT e.student_id)', 'count(DISTINCT f.student_id)', 'compliance_rate_pct')}
        FROM flat f JOIN period p ON true LEFT JOIN (SELECT student_id, semester_id, is_compulsory_se FROM enrollment WHERE is_compulsory_se) e
        ON e.student_id = f.student_id AND e.semester_id = p.semester_id WHERE f.level_name = '100L' GROUP BY 1, 2""",
    "course_failure_rate": FAILURES,
    "flagged_courses": f"""SELECT course_code, course_title, faculty_name, session_name, semester_name, failure_rate_pct, risk_flag FROM ({FAILURES})
        WHERE risk_flag IN ('HIGH RISK', 'ELEVATED')""",
    "high_failure_courses": f"SELECT * FROM ({FAILURES}) WHERE failure_rate_pct > 30",
    "registration_behaviour": BEHAVIOUR,
    "latest_registering_faculties": f"SELECT faculty_name, level_name, session_name, semester_name, avg_days_before_deadline, late_rate_pct FROM ({BEHAVIOUR})",
    "credit_load_distribution": LOADS.format(mean="CAST(sum(units) OVER w // count(*) OVER w AS DOUBLE)"),
    "credit_load_exact": LOADS.format(mean=rounded("sum(units) OVER w", "count(*) OVER w", 1)),
    "student_diversity": f"""SELECT geopolitical_zone, region, faculty_name, p.session_name, count(DISTINCT e.student_id) AS student_count,
        {rounded('sum(cgpa)', 'count(cgpa) * 100', 2)} AS avg_cgpa
        FROM enrollment e JOIN flat USING (student_id) JOIN geography USING (state_name) JOIN period p ON p.semester_id = e.semester_id
        LEFT JOIN (SELECT student_id, semester_id, cgpa FROM gpa_fact) g ON g.student_id = e.student_id AND g.semester_id = e.semester_id GROUP BY 1, 2, 3, 4""",
    "department_gpa_ranking": RANKING,
    "topk_departments": f"SELECT * FROM ({RANKING}) WHERE session_name = '2000/2001' ORDER BY cgpa_rank, faculty_name, department_name LIMIT 10",
    "student_progression": PROGRESSION,
    "student_trend": f"SELECT * FROM ({PROGRESSION}) WHERE student_matric_no = 'Customer#000000007'",
    "prereq_compliance_audit": """SELECT student_matric_no, full_name, faculty_name, c.course_code AS registered_course, c.course_title AS registered_title,
        q.course_code AS missing_prereq_code, q.course_title AS missing_prereq_title, session_name, semester_name, registration_status
        FROM enrollment e JOIN flat USING (student_id) JOIN period m ON m.semester_id = e.semester_id JOIN course c ON c.course_id = e.course_id
        JOIN prerequisite p ON p.course_id = e.course_id JOIN course q ON q.course_id = p.required_course_id
        WHERE NOT EXISTS (SELECT 1 FROM enrollment b JOIN semester s ON s.semester_id = b.semester_id WHERE b.student_id = e.student_id
            AND b.course_id = p.required_course_id AND b.grade <= p.min_grade AND s.start_date < m.start_date)""",
    "registration_timeline": TIMELINE,
    "semester_timeline": f"SELECT * FROM ({TIMELINE}) WHERE session_name = '2000/2001' AND semester_name = 'First'",
    "lecturer_performance": f"""SELECT full_name AS lecturer_name, s.department_name, s.faculty_name, designation, session_name, semester_name, course_code, course_title, level_name,
        credit_units, count(*) AS students_enrolled, {mean(SCORE, 'total_score', 2, 1, 'avg_score')}, {mean('tenths', 'tenths', 1, 2, 'avg_grade_point')},
        {count_if('is_pass', 'students_passed')}, {count_if('is_fail', 'students_failed')}, {count_if('is_distinction', 'distinctions')},
        {pct('count(*) FILTER (is_pass)', 'count(*)', 'pass_rate_pct')}
        FROM enrollment e JOIN dim_staff s USING (staff_id) JOIN (SELECT course_id, course_code, course_title, level_name FROM dim_course) c USING (course_id)
        JOIN period USING (semester_id) GROUP BY staff_id, full_name, s.department_name, s.faculty_name, designation, session_name, semester_name, course_id,
        course_code, course_title, level_name, credit_units""",
    "credit_completion_rate": f"""SELECT faculty_name, level_name, session_name, count(DISTINCT student_id) AS students, {n('sum(attempted)', 'total_credits_attempted')},
        {n('sum(earned)', 'total_credits_earned')}, {pct('sum(earned)', 'sum(attempted)', 'completion_rate_pct')}, {mean('gpa', 'gpa', 2, 2, 'avg_gpa')}
        FROM {GPA} GROUP BY 1, 2, 3""",
    "yoy_gpa_trend": f"SELECT faculty_name, session_name, {mean('gpa', 'gpa', 2, 2, 'avg_gpa')} FROM {GPA} GROUP BY 1, 2",
    "faculty_avg_point": f"SELECT faculty_name, {mean('tenths', 'tenths', 1, 4, 'avg_grade_point')} FROM enrollment JOIN flat USING (student_id) GROUP BY 1",
    "etl_health": HEALTH,
    "last_runs": f"SELECT * FROM ({HEALTH}) ORDER BY etl_run_id DESC LIMIT 10",
    "run_history": f"""SELECT etl_run_id, run_started_at, run_finished_at, status, rows_inserted, rows_updated, scd2_rows_closed, dq_errors, dq_warnings,
        duration_seconds FROM ({HEALTH})""",
    "run_status_histogram": "SELECT status, count(*) AS runs FROM run_log GROUP BY 1",
    "row_counts": " UNION ALL ".join(f"SELECT '{k}' AS table_name, count(*) AS rows FROM {v}" for k, v in ROW_COUNTS.items()),
    "run_incremental": """SELECT * FROM (SELECT 'dim_academic_period' AS table_name, count(*) AS rows FROM period
        UNION ALL SELECT 'dim_course', count(*) FROM dim_course UNION ALL SELECT 'dim_staff', count(*) FROM dim_staff
        UNION ALL SELECT 'dim_student', count(*) + count(*) FILTER (enrollment_status = 'Suspended' AND updated_at > TIMESTAMP '1998-06-30') FROM flat
        UNION ALL SELECT 'fact_enrollment', count(*) FROM enrollment UNION ALL SELECT 'fact_student_gpa', count(*) FROM gpa_fact
        UNION ALL SELECT 'fact_registration_event', count(*) FROM event UNION ALL SELECT 'current students', count(*) FROM flat
        UNION ALL SELECT 'runs SUCCESS', 2
        UNION ALL SELECT 'closed by the last run', count(*) FROM flat WHERE enrollment_status = 'Suspended' AND updated_at > TIMESTAMP '1998-06-30')""",
    "fact_student_gpa_as_of": f"""SELECT student_id, semester_id, gpa / 100.0 AS session_gpa, cgpa / 100.0 AS cgpa, {n('attempted', 'total_credits_attempted')},
        {n('earned', 'total_credits_earned')}, registered AS courses_registered FROM ({HALF_GPA}) JOIN period p USING (session_id) WHERE p.semester_name = 'Second'""",
    "update_by_keys": """SELECT r.semester_id, CASE WHEN x.remark = 'Fail' AND registration_status <> 'Dropped' THEN 'Repeat' ELSE registration_status END AS registration_status,
        count(*) AS registrations FROM registration r LEFT JOIN result x ON x.l_orderkey = r.l_orderkey AND x.l_partkey = r.l_partkey GROUP BY 1, 2""",
    "with_defaults": """SELECT CASE WHEN remark <> 'Absent' THEN remark ELSE 'Pending' END AS remark, 'registry' AS entered_by, count(*) AS results,
        CAST(sum(credit_units_earned) AS BIGINT) AS units FROM result GROUP BY 1, 2""",
    "watermark_advance": """SELECT '2030-01-01' AS mark, count(*) AS entities FROM watermark
        UNION ALL SELECT '1900-01-01', count(*) FROM (VALUES ('student_level_history'), ('programme'), ('department'), ('faculty')) never_loaded""",
    "run_counters": f"""SELECT what, CAST((SELECT count(*) FROM flat) + (SELECT count(*) FROM dim_course) + (SELECT count(*) FROM dim_staff) + (SELECT count(*) FROM period)
        + (SELECT count(*) FROM enrollment WHERE entered_at <= {HALF})
        + (SELECT count(*) FROM ({HALF_GPA}) JOIN period p USING (session_id) WHERE p.semester_name = 'Second')
        + (SELECT count(*) FROM registration JOIN semester USING (semester_id) JOIN student USING (student_id) JOIN course USING (course_id) WHERE registration_date <= {HALF})
        + (SELECT count(*) FROM audit JOIN semester USING (semester_id) JOIN student USING (student_id) JOIN course USING (course_id) WHERE attempt_time <= {HALF}) AS BIGINT) AS inserted
        FROM (VALUES ('counted'), ('stored')) v(what)""",
    # source views
    "student_registration_summary": f"""SELECT student_matric_no, full_name AS student_name, level_name AS current_level, programme_name, department_name, faculty_name,
        semester_name, session_name, {iso('reg_deadline')}, count(*) AS total_courses_registered, {n('sum(credit_units)', 'total_credit_units')},
        CASE WHEN DATE '2001-08-01' > reg_deadline THEN 'Closed' ELSE 'Open' END AS reg_window_status
        FROM registration JOIN flat USING (student_id) JOIN course USING (course_id) JOIN period USING (semester_id) WHERE is_current
        GROUP BY student_id, student_matric_no, full_name, level_name, programme_name, department_name, faculty_name, semester_name, session_name, reg_deadline""",
    "student_transcript": TRANSCRIPT,
    "transcript": f"{TRANSCRIPT} WHERE student_matric_no = 'Customer#000000007'",
    "ser001_compliance": COMPLIANCE,
    "noncompliant_students": f"SELECT * FROM ({COMPLIANCE}) WHERE ser001_status = 'NOT Registered'",
    "prereq_chain": """SELECT c.course_code, c.course_title, a.level_name AS course_level, q.course_code AS prerequisite_code, q.course_title AS prerequisite_title,
        b.level_name AS prereq_level, min_grade AS required_min_grade FROM prerequisite p JOIN course c ON c.course_id = p.course_id
        JOIN course q ON q.course_id = p.required_course_id JOIN student_level a ON a.level_id = c.level_id JOIN student_level b ON b.level_id = q.level_id""",
    "student_courses": f"""SELECT course_type_taken, course_code, course_title, credit_units, registration_status, {iso_ts('registration_date')}
        FROM registration JOIN student USING (student_id) JOIN course USING (course_id)
        WHERE student_matric_no = 'Customer#000000007' AND semester_id = 19981""",
    # checks
    "dq_checks": DQ_ALL,
    "dq_gate": f"""SELECT count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARNING') AS warnings,
        CAST(count(*) FILTER (severity = 'ERROR') = 0 AS BIGINT) AS passes FROM ({DQ_ALL}) WHERE records_flagged > 0""",
    "dq01": one("SELECT count(*) FROM student WHERE enrollment_status = 'Suspended'"),
    "dq02": one("SELECT count(*) FROM result WHERE total_score + 10 > 100"),
    "dq03": one("SELECT count(*) FROM registration JOIN semester USING (semester_id) WHERE CAST(registration_date AS DATE) > start_date + 180"),
    "dq04": one(DQ_COUNT["DQ-04"]),
    "dq05": one(DQ_COUNT["DQ-05"]),
    "dq06": one(DQ_COUNT["DQ-06"]),
    "dq07_duplicates": one("SELECT count(*) FROM (SELECT state_of_origin, programme_id FROM student GROUP BY 1, 2 HAVING count(*) > 1)"),
    "dq07_case_insensitive": one("SELECT count(*) FROM (SELECT lower(state_of_origin), programme_id FROM student GROUP BY 1, 2 HAVING count(*) > 1)"),
    "dq08": one(DQ_COUNT["DQ-08"]),
    "dq09_grade_range": one(DQ_COUNT["DQ-09"]),
    "dq10": one(DQ_COUNT["DQ-10"]),
    "raw_constraint_violations": """SELECT 'check:customer.balance' AS rule, count(*) AS keys, count(*) AS violations FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'check:orders.status', count(DISTINCT o_orderkey), count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F') HAVING count(*) > 0
        UNION ALL SELECT 'unique:lineitem.l_orderkey,l_linenumber', count(*), CAST(sum(n) AS BIGINT)
            FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'unique:customer.c_nationkey,c_mktsegment', count(*), CAST(sum(n) AS BIGINT)
            FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1)
        UNION ALL SELECT 'reference:orders.o_custkey->recent', count(DISTINCT o_custkey), count(*) FROM orders
            WHERE o_custkey NOT IN (SELECT user_id FROM events)""",
    "constraint_violations": """SELECT 'unique:student.email' AS rule, count(*) AS keys, CAST(sum(n) AS BIGINT) AS violations
            FROM (SELECT count(*) AS n FROM student GROUP BY state_of_origin HAVING count(*) > 1)
        UNION ALL SELECT 'check:student.gender', count(*), count(*) FROM student WHERE enrollment_status = 'Suspended' HAVING count(*) > 0
        UNION ALL SELECT 'reference:student.programme_id->programme', count(DISTINCT programme_id), count(*) FROM student WHERE current_level_id = 1
            AND programme_id + 1000 NOT IN (SELECT programme_id FROM programme)
        UNION ALL SELECT 'reference:course.level_id->student_level', 1, count(*) FROM course WHERE level_id + 3 > 7
        UNION ALL SELECT 'not_null:course.course_title', count(*), count(*) FROM course WHERE is_compulsory_se
        UNION ALL SELECT 'check:semester.reg_deadline', count(*), count(*) FROM semester WHERE is_current
        UNION ALL SELECT 'check:course_registration.registration_status', count(*), count(*) FROM registration WHERE registration_status = 'Dropped'
        UNION ALL SELECT 'check:course_prerequisite.no_self_prereq', count(*), count(*) FROM prerequisite
        UNION ALL SELECT 'not_null:course_result.remark', count(*), count(*) FROM result WHERE remark = 'Absent'""",
    "failed_checks": f"SELECT checked_at, etl_run_id, check_name, severity, records_flagged, detail FROM ({dq_log()})",
    "check_log_violations": f"""SELECT 'check:dq_check_log.dq_severity' AS rule, count(DISTINCT check_name) AS keys, count(*) AS violations
        FROM ({dq_log()}) WHERE severity = 'WARNING' HAVING count(*) > 0""",
    "violations_of_run": """SELECT 'check:course_prerequisite.no_self_prereq' AS rule, count(*) AS keys, count(*) AS before, 0 AS after
            FROM prerequisite WHERE course_id % 2 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'check:course_registration.registration_status', count(*), 0, count(*) FROM registration WHERE registration_status = 'Dropped' HAVING count(*) > 0
        UNION ALL SELECT 'not_null:course_result.remark', count(*), 0, count(*) FROM result WHERE remark = 'Absent' HAVING count(*) > 0
        UNION ALL SELECT 'reference:student.programme_id->programme', count(DISTINCT programme_id), 0, count(*) FROM student WHERE programme_id % 10 = 3 HAVING count(*) > 0
        UNION ALL SELECT 'reference:programme_course.programme_id->programme', count(DISTINCT programme_id), 0, count(*)
            FROM programme JOIN course USING (department_id) WHERE is_compulsory_se AND programme_id % 10 = 3 HAVING count(*) > 0
        UNION ALL SELECT 'unique:staff.' || c, count(*), 0, 2 * count(*) FROM staff CROSS JOIN (VALUES ('staff_no'), ('email')) AS v(c) WHERE staff_id % 10 = 0 GROUP BY c""",
    "load_outcomes": f"""{outcome('as it is', 1, '2030-01-01')}
        UNION ALL {outcome('cleaned', 1, '1998-06-30', ", 'DQ-05', 'DQ-09'")} UNION ALL {outcome('cleaned', 2, '2030-01-01', ", 'DQ-05', 'DQ-09'")}""",
    # history
    "versions_from_changes": HISTORY,
    "versions_from_timestamps": EVENT_VERSIONS,
    "system_time_as_of": f"{HISTORY} WHERE valid_from <= DATE '1998-06-01' AND valid_to > DATE '1998-06-01'",
    "system_time_between": f"{HISTORY} WHERE valid_from <= DATE '1998-03-01' AND valid_to > DATE '1998-01-01'",
    "system_time_all": HISTORY,
    # visibility
    "rls_student": f"{VISIBLE} WHERE student_id = 7",
    "rls_lecturer": f"{VISIBLE} WHERE student_id IN ({TAUGHT})",
    "rls_faculty_admin": "SELECT student_id, student_matric_no FROM flat JOIN faculty USING (faculty_name) WHERE faculty_id = 2",
    "rls_registry": VISIBLE,
    "rls_unmapped": f"{VISIBLE} WHERE false",
    "rls_child_rows": f"SELECT semester_id, count(*) AS registrations, count(DISTINCT student_id) AS students FROM registration WHERE student_id IN ({TAUGHT}) GROUP BY 1",
    "rls_block": "SELECT student_id FROM flat JOIN faculty USING (faculty_name) WHERE enrollment_status = 'Active' AND faculty_id <> 2",
    # registration
    "registration_validation": VALIDATION,
    "registration_cap_greedy": GREEDY,
    "promote_students": PROMOTION,
    "promoted_levels": f"""SELECT a.level_id, students, records, credits FROM (
            SELECT CAST(CASE WHEN current_level_id < 7 THEN current_level_id + 1 ELSE current_level_id END AS BIGINT) AS level_id, count(*) AS students FROM student GROUP BY 1) a
        LEFT JOIN (SELECT new_level_id AS level_id, count(*) AS records, CAST(sum(total_credits_earned) AS BIGINT) AS credits FROM ({PROMOTION})
            WHERE new_level_id IS NOT NULL GROUP BY 1) b USING (level_id)""",
}


# Two increments leave what one load does; their scores are whole.
STATEMENTS["incremental_equals_full_enrollment"] = STATEMENTS["fact_enrollment"].replace("CAST(total_score AS DOUBLE)", "CAST(floor(total_score) AS DOUBLE)")
STATEMENTS["versions_from_late_changes"] = STATEMENTS["versions_from_timestamps"]
STATEMENTS["running_cgpa_after_late_results"] = STATEMENTS["running_cgpa"]
STATEMENTS["distinct_students"] = """SELECT department_name, semester_id, count(DISTINCT student_id) AS students FROM enrollment JOIN dim_course USING (course_id)
    GROUP BY GROUPING SETS ((department_name, semester_id), (department_name), ())"""
STATEMENTS["incremental_equals_full_events"] = STATEMENTS["fact_registration_event"]


def oracle_sql() -> dict[str, str]:
    return {name: with_base(sql, recursive=name == "registration_cap_greedy") for name, sql in STATEMENTS.items()}
