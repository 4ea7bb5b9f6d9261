"""A small university with answers worked out by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from matricula.schemas import schema_of
from matricula.sources import reference_data as ref

BORN = datetime(2020, 1, 1)
AS_OF = datetime(2025, 3, 15)

# Departments (name, faculty) of the courses, by code prefix.
DEPARTMENTS = {
    "SER": ("English", 3), "GST": ("English", 3), "CSC": ("Computer Science", 14), "AIT": ("Artificial Intelligence", 14),
    "SWE": ("Software Engineering", 14), "CYB": ("Cybersecurity", 14), "ECO": ("Economics", 12), "ACC": ("Accounting", 1),
    "LAW": ("Private and Property Law", 9), "MEE": ("Mechanical Engineering", 13), "BCH": ("Biochemistry", 11), "MAT": ("Mathematics", 11),
}
NAMES = list(dict.fromkeys(name for name, _ in DEPARTMENTS.values()))
FACULTY_OF = dict(DEPARTMENTS.values())

# Sessions 1-4 and semesters 1-8 (session, name, start, end, deadline).
SESSIONS = ["2021/2022", "2022/2023", "2023/2024", "2024/2025"]
SEMESTERS = [
    (1, "First", "2021-09-13", "2022-01-28", "2021-10-01"),
    (1, "Second", "2022-02-14", "2022-06-30", "2022-03-04"),
    (2, "First", "2022-09-12", "2023-01-27", "2022-09-30"),
    (2, "Second", "2023-02-13", "2023-06-30", "2023-03-03"),
    (3, "First", "2023-09-11", "2024-01-26", "2023-09-29"),
    (3, "Second", "2024-02-12", "2024-06-28", "2024-03-01"),
    (4, "First", "2024-09-09", "2025-01-31", "2024-09-27"),
    (4, "Second", "2025-02-10", "2025-07-11", "2025-03-01"),
]

# Prerequisites (course, required course, lowest grade).
PREREQUISITES = [
    ("CSC201", "CSC102", "E"), ("CSC202", "CSC102", "E"), ("CSC301", "CSC201", "E"), ("CSC302", "CSC201", "E"),
    ("CSC401", "CSC302", "E"), ("CSC401", "CSC303", "E"), ("AIT301", "AIT202", "D"), ("AIT302", "AIT301", "D"),
    ("ECO301", "ECO201", "C"), ("ECO401", "ECO301", "C"), ("LAW201", "LAW102", "E"), ("LAW301", "LAW201", "E"),
    ("BCH202", "BCH201", "E"), ("BCH301", "BCH202", "E"), ("MEE202", "MEE201", "E"), ("SWE301", "SWE201", "E"),
    ("CYB301", "CYB201", "E"), ("MAT202", "MAT201", "E"), ("ACC301", "ACC201", "E"),
]

# Students (number, department, level, state, admission session).
STUDENTS = [
    ("CST/2024/001", "Computer Science", 100, "Oyo", 4), ("CST/2024/002", "Artificial Intelligence", 100, "Anambra", 4),
    ("CST/2022/001", "Computer Science", 300, "Osun", 2), ("SOC/2024/001", "Economics", 100, "Kano", 4),
    ("ADMIN/2024/001", "Accounting", 100, "Enugu", 4), ("LAW/2020/001", "Private and Property Law", 400, "Lagos", 1),
    ("TECH/2023/001", "Mechanical Engineering", 200, "Plateau", 3), ("SCI/2024/001", "Biochemistry", 100, "Kaduna", 4),
    ("CST/2023/001", "Software Engineering", 200, "Imo", 3), ("CST/2021/001", "Cybersecurity", 400, "Ogun", 1),
]

# Courses of each student in semester 7, and those of the third student in semester 5.
TAKEN = {
    "CST/2024/001": "SER001 CSC101 CSC103 GST101 GST111", "CST/2024/002": "SER001 AIT101 CSC101 CSC103",
    "SOC/2024/001": "SER001 ECO101 MAT101 GST101", "ADMIN/2024/001": "SER001 ACC101 ECO101 MAT101",
    "SCI/2024/001": "SER001 BCH101 MAT101 GST101",
}
EARLIER = ("CST/2022/001", "CSC301 CSC302 CSC304 CSC306 CSC305")

# Results of semester 5 (course, continuous, exam, grade), as entered and as corrected.
RESULTS = [("CSC301", 35, 45, "B"), ("CSC302", 38, 40, "A"), ("CSC304", 30, 32, "C"), ("CSC306", 28, 30, "D"), ("CSC305", 20, 22, "E")]
CORRECTED = {"CSC301": "A", "CSC304": "B", "CSC306": "C"}

# Lecturers (number, department) and their courses in semester 7.
STAFF = [
    ("CST/STA/001", "Computer Science"), ("CST/STA/002", "Computer Science"), ("CST/STA/003", "Artificial Intelligence"),
    ("CST/STA/004", "Cybersecurity"), ("SOC/STA/001", "Economics"), ("SOC/STA/002", "Economics"), ("ADMIN/STA/001", "Accounting"),
    ("ARTS/STA/001", "English"), ("LAW/STA/001", "Private and Property Law"), ("TECH/STA/001", "Mechanical Engineering"), ("SCI/STA/001", "Biochemistry"),
]
ASSIGNED = {"CSC101": 1, "CSC102": 2, "AIT101": 3, "CYB101": 4, "SER001": 8, "ECO101": 5, "ACC101": 7, "BCH101": 11}

USERS = [
    ("student_one", "student", 1, None), ("student_two", "student", 2, None), ("lecturer_one", "lecturer", 1, None),
    ("lecturer_eight", "lecturer", 8, None), ("fadmin_14", "faculty_admin", None, 14), ("fadmin_12", "faculty_admin", None, 12),
    ("registry_admin", "registry_admin", None, None),
]

CODES = list(dict.fromkeys(
    " ".join(TAKEN.values()).split() + EARLIER[1].split() + [c for p in PREREQUISITES for c in p[:2]] + list(ASSIGNED)
))
TWO_UNITS = {"SER001", "GST101", "CSC103"}
POINTS = {band[0]: band[3] for band in ref.GRADE_SCALE}


def day(text: str) -> date:
    return date.fromisoformat(text)


def course_id(code: str) -> int:
    return CODES.index(code) + 1


def rows(corrected: bool) -> dict[str, list[tuple]]:
    level = {n: i for i, n in enumerate(ref.LEVEL_NUMBERS, 1)}
    department = {name: i for i, name in enumerate(NAMES, 1)}
    numbers = [s[0] for s in STUDENTS]
    registered = [(m, c, 7) for m, codes in TAKEN.items() for c in codes.split()] + [(EARLIER[0], c, 5) for c in EARLIER[1].split()]
    when = {7: datetime(2024, 9, 20), 5: datetime(2023, 9, 20)}
    registrations, results = [], []
    for i, (matric, code, semester) in enumerate(registered, 1):
        kind = "COMPULSORY_SE" if code == "SER001" else "ELECTIVE" if code == "CSC305" else "MAJOR"
        registrations.append((Decimal(i), numbers.index(matric) + 1, course_id(code), semester, when[semester], "Registered", kind, when[semester]))
        for result, ca, exam, grade in RESULTS:
            if result == code:
                grade = CORRECTED.get(code, grade) if corrected else grade
                entered = datetime(2024, 2, 1)
                results.append((
                    Decimal(len(results) + 1), Decimal(i), Decimal(ca), Decimal(exam), Decimal(ca + exam), grade, POINTS[grade],
                    2 if code in TWO_UNITS else 3, "Pass", entered, entered,
                ))
    return {
        "academic_session": [(i, n, date(2020 + i, 9, 1), date(2021 + i, 7, 31), i == 4, BORN, BORN) for i, n in enumerate(SESSIONS, 1)],
        "semester": [(i, s, n, day(a), day(b), day(c), i == 8, BORN, BORN) for i, (s, n, a, b, c) in enumerate(SEMESTERS, 1)],
        "college": [],
        "faculty": [(f, None, f"Faculty {f}", f"F{f}", None, BORN) for f in sorted(set(FACULTY_OF.values()))],
        "department": [(department[n], FACULTY_OF[n], n, n, None, BORN) for n in NAMES],
        "programme": [(department[n], department[n], 1, f"B.Sc {n}", 4, BORN) for n in NAMES],
        "course_category": [(i, c, c, None) for i, c in enumerate(ref.COURSE_CATEGORIES, 1)],
        "course": [
            (course_id(c), department[DEPARTMENTS[c[:3]][0]], 3 if c == "SER001" else 1, c, f"Course {c}", None, 2 if c in TWO_UNITS else 3,
             level[100 if c == "SER001" else int(c[3]) * 100], "First", True, c == "SER001", BORN, BORN)
            for c in CODES
        ],
        "course_prerequisite": [(i, course_id(c), course_id(r), g) for i, (c, r, g) in enumerate(PREREQUISITES, 1)],
        "programme_course": [(i, department[n], course_id("SER001"), "COMPULSORY_SE", True) for i, n in enumerate(NAMES, 1)],
        "student": [
            (i, m, f"First{i}", f"Last{i}", None, None, "Male", f"s{i}@students.example", None, None, state, department[d], level[n], a, "Active", BORN, BORN)
            for i, (m, d, n, state, a) in enumerate(STUDENTS, 1)
        ],
        "student_level_history": [],
        "course_registration": registrations,
        "registration_audit": [],
        "course_result": results,
        "staff": [(i, no, f"Lect{i}", "Urer", department[d], "Professor", f"l{i}@staff.example", True, BORN) for i, (no, d) in enumerate(STAFF, 1)],
        "course_assignment": [(course_id(c), 7, s) for c, s in ASSIGNED.items()],
        "security_user_map": USERS,
    }


def source(spark, corrected: bool = True, **changed):
    """Source tables as DataFrames; ``changed`` replaces the rows of tables."""
    made = {t: ref.literal_table(spark, r, schema_of(t)) for t, r in {**rows(corrected), **changed}.items()}
    fixed = {"grade_scale": ref.grade_scale(spark), "student_level": ref.student_level(spark), "degree_type": ref.degree_type(spark)}
    return {**made, **fixed}
