"""Explicit schemas of the source and warehouse tables.

Identifiers are BIGINT; a registration's identifier is DECIMAL(38,0), so that
one built from two BIGINT keys stays exact.  Surrogate keys: a dimension that
keeps one row per natural key uses that key; a student version adds its
version number (see ``operators.scd2``).
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

REGISTRATION_ID = "decimal(38,0)"

SOURCE = {
    "academic_session": """session_id BIGINT, session_name STRING, start_date DATE, end_date DATE,
        is_current BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "semester": """semester_id BIGINT, session_id BIGINT, semester_name STRING, start_date DATE, end_date DATE,
        reg_deadline DATE, is_current BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "student_level": "level_id BIGINT, level_name STRING, level_number INT, description STRING",
    "degree_type": "degree_type_id BIGINT, degree_code STRING, degree_name STRING",
    "grade_scale": """grade_scale_id BIGINT, grade STRING, min_score INT, max_score INT,
        grade_point DECIMAL(3,1), remark STRING""",
    "college": "college_id BIGINT, college_name STRING, abbreviation STRING, updated_at TIMESTAMP_NTZ",
    "faculty": """faculty_id BIGINT, college_id BIGINT, faculty_name STRING, abbreviation STRING,
        established_year INT, updated_at TIMESTAMP_NTZ""",
    "department": """department_id BIGINT, faculty_id BIGINT, department_name STRING, abbreviation STRING,
        hod_name STRING, updated_at TIMESTAMP_NTZ""",
    "programme": """programme_id BIGINT, department_id BIGINT, degree_type_id BIGINT, programme_name STRING,
        duration_years INT, updated_at TIMESTAMP_NTZ""",
    "course_category": "category_id BIGINT, category_code STRING, category_name STRING, description STRING",
    "course": """course_id BIGINT, department_id BIGINT, category_id BIGINT, course_code STRING, course_title STRING,
        course_description STRING, credit_units INT, level_id BIGINT, semester_offered STRING, is_active BOOLEAN,
        is_compulsory_se BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "course_prerequisite": "prerequisite_id BIGINT, course_id BIGINT, required_course_id BIGINT, min_grade STRING",
    "programme_course": """programme_course_id BIGINT, programme_id BIGINT, course_id BIGINT, course_type STRING,
        is_compulsory BOOLEAN""",
    "student": """student_id BIGINT, student_matric_no STRING, first_name STRING, last_name STRING,
        middle_name STRING, date_of_birth DATE, gender STRING, email STRING, phone STRING, address STRING,
        state_of_origin STRING, programme_id BIGINT, current_level_id BIGINT, admission_session_id BIGINT,
        enrollment_status STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "student_history": """student_id BIGINT, programme_name STRING, enrollment_status STRING,
        valid_from DATE, valid_to DATE""",
    "student_level_history": """student_id BIGINT, session_id BIGINT, level_id BIGINT, gpa DECIMAL(4,2),
        cgpa DECIMAL(4,2), total_credits_earned BIGINT, recorded_at TIMESTAMP_NTZ""",
    "course_registration": f"""registration_id {REGISTRATION_ID}, student_id BIGINT, course_id BIGINT,
        semester_id BIGINT, registration_date TIMESTAMP_NTZ, registration_status STRING, course_type_taken STRING,
        updated_at TIMESTAMP_NTZ""",
    "registration_audit": """audit_id BIGINT, student_id BIGINT, course_id BIGINT, semester_id BIGINT,
        attempt_time TIMESTAMP_NTZ, was_late BOOLEAN, prereqs_failed INT, rejection_reason STRING""",
    "course_result": f"""result_id {REGISTRATION_ID}, registration_id {REGISTRATION_ID}, ca_score DECIMAL(5,2),
        exam_score DECIMAL(5,2), total_score DECIMAL(6,2), grade STRING, grade_point DECIMAL(3,1),
        credit_units_earned INT, remark STRING, entered_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    "staff": """staff_id BIGINT, staff_no STRING, first_name STRING, last_name STRING, department_id BIGINT,
        designation STRING, email STRING, is_active BOOLEAN, updated_at TIMESTAMP_NTZ""",
    "course_assignment": "course_id BIGINT, semester_id BIGINT, staff_id BIGINT",
    "security_user_map": "db_username STRING, role_name STRING, entity_id BIGINT, faculty_id BIGINT",
    "etl_watermark": """entity_name STRING, last_extracted_at TIMESTAMP_NTZ, last_row_count BIGINT,
        updated_at TIMESTAMP_NTZ""",
    "dq_check_log": """check_name STRING, check_category STRING, severity STRING, records_flagged BIGINT,
        detail STRING, checked_at TIMESTAMP_NTZ, etl_run_id BIGINT""",
}

WAREHOUSE = {
    "etl_log": """etl_run_id BIGINT, run_started_at TIMESTAMP_NTZ, run_finished_at TIMESTAMP_NTZ, status STRING,
        rows_inserted BIGINT, rows_updated BIGINT, scd2_rows_closed BIGINT, dq_errors BIGINT, dq_warnings BIGINT,
        error_message STRING, triggered_by STRING""",
    "dim_date": """date_key INT, full_date DATE, day_name STRING, day_num INT, week_num INT, month_num INT,
        month_name STRING, quarter_num INT, quarter_name STRING, year_num INT, academic_year STRING,
        academic_week INT, is_weekend BOOLEAN, is_holiday BOOLEAN, season STRING""",
    "dim_student": """student_sk BIGINT, student_id BIGINT, student_matric_no STRING, full_name STRING,
        first_name STRING, last_name STRING, gender STRING, state_of_origin STRING, programme_name STRING,
        faculty_name STRING, department_name STRING, level_name STRING, level_number INT, degree_type STRING,
        admission_year STRING, enrollment_status STRING, effective_date DATE, expiry_date DATE, is_current BOOLEAN,
        dw_created_at TIMESTAMP_NTZ, dw_updated_at TIMESTAMP_NTZ, etl_run_id BIGINT""",
    "dim_course": """course_sk BIGINT, course_id BIGINT, course_code STRING, course_title STRING,
        course_description STRING, credit_units INT, category_code STRING, category_name STRING,
        department_name STRING, faculty_name STRING, faculty_abbreviation STRING, level_name STRING,
        level_number INT, semester_offered STRING, is_compulsory_se BOOLEAN, is_active BOOLEAN,
        has_prerequisites BOOLEAN, prerequisite_count BIGINT, dw_created_at TIMESTAMP_NTZ,
        dw_updated_at TIMESTAMP_NTZ""",
    "dim_academic_period": """period_sk BIGINT, semester_id BIGINT, session_name STRING, semester_name STRING,
        full_period_name STRING, academic_year INT, start_date DATE, end_date DATE, reg_deadline DATE,
        reg_duration_days INT, semester_duration_days INT, is_current BOOLEAN""",
    "dim_staff": """staff_sk BIGINT, staff_id BIGINT, staff_no STRING, full_name STRING, department_name STRING,
        faculty_name STRING, designation STRING, is_active BOOLEAN, dw_created_at TIMESTAMP_NTZ""",
    "dim_geography": "geo_sk BIGINT, state_name STRING, geopolitical_zone STRING, region STRING",
    "fact_enrollment": f"""student_sk BIGINT, course_sk BIGINT, period_sk BIGINT, staff_sk BIGINT, geo_sk BIGINT,
        reg_date_key INT, result_date_key INT, registration_id {REGISTRATION_ID}, course_type_taken STRING,
        registration_status STRING, ca_score DECIMAL(5,2), exam_score DECIMAL(5,2), total_score DECIMAL(6,2),
        grade STRING, grade_point DECIMAL(3,1), credit_units INT, credit_units_earned INT, is_pass BOOLEAN,
        is_distinction BOOLEAN, is_credit BOOLEAN, is_fail BOOLEAN, is_absent BOOLEAN, is_late_registration BOOLEAN,
        is_major_course BOOLEAN, is_elective_course BOOLEAN, is_compulsory_se BOOLEAN,
        dw_inserted_at TIMESTAMP_NTZ, etl_run_id BIGINT""",
    "period_students": "period_sk BIGINT, department_name STRING, bucket BIGINT, ids BINARY",
    "registration_period": f"registration_id {REGISTRATION_ID}, period_sk BIGINT",
    "fact_student_gpa": """student_sk BIGINT, period_sk BIGINT, geo_sk BIGINT, session_gpa DECIMAL(4,2),
        cgpa DECIMAL(4,2), total_credits_attempted BIGINT, total_credits_earned BIGINT, courses_registered BIGINT,
        courses_passed BIGINT, courses_failed BIGINT, courses_absent BIGINT, is_first_class BOOLEAN,
        is_second_class_upper BOOLEAN, is_second_class_lower BOOLEAN, is_third_class BOOLEAN, is_at_risk BOOLEAN,
        dw_inserted_at TIMESTAMP_NTZ, etl_run_id BIGINT""",
    "fact_registration_event": """student_sk BIGINT, course_sk BIGINT, period_sk BIGINT, attempt_date_key INT,
        days_from_sem_start INT, days_before_deadline INT, was_late BOOLEAN, was_rejected BOOLEAN,
        prereqs_failed INT, registration_status STRING, rejection_reason STRING, audit_id BIGINT,
        dw_inserted_at TIMESTAMP_NTZ, etl_run_id BIGINT""",
}


@cache
def schema_of(table: str) -> StructType:
    return StructType.fromDDL(SOURCE.get(table) or WAREHOUSE[table])


def conform(df: DataFrame, table: str, *also: str) -> DataFrame:
    """Columns of the table in order and type, then ``also``; a column the frame lacks becomes NULL."""
    have = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema_of(table).fields
    ]
    return df.select(*columns, *also)
