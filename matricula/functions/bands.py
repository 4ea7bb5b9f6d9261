"""Banding rules: classes of degree, risk labels, run health, yes/no flags."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Lower CGPA bounds of the classes, best first.
FIRST_CLASS = Decimal("4.50")
SECOND_UPPER = Decimal("3.50")
SECOND_LOWER = Decimal("2.40")
THIRD_CLASS = Decimal("1.50")

# Other thresholds of the reports.
MANY_FAILURES = 3
HIGH_FAILURE_PCT = 40
ELEVATED_FAILURE_PCT = 25
MIN_GROUP = 5
MAX_UNITS = 24


def flag(condition: Column) -> Column:
    """True where the condition holds, False where it does not or is NULL."""
    return F.coalesce(condition, F.lit(False))


def class_of_degree(cgpa: Column) -> Column:
    return (
        F.when(cgpa >= FIRST_CLASS, "1st Class")
        .when(cgpa >= SECOND_UPPER, "2nd Class Upper")
        .when(cgpa >= SECOND_LOWER, "2nd Class Lower")
        .when(cgpa >= THIRD_CLASS, "3rd Class")
        .otherwise("Pass / Probation")
    )


def standing_flags(cgpa: Column) -> dict[str, Column]:
    """The five mutually exclusive standing flags of a two-decimal CGPA."""
    step = Decimal("0.01")
    return {
        "is_first_class": flag(cgpa >= FIRST_CLASS),
        "is_second_class_upper": flag(cgpa.between(SECOND_UPPER, FIRST_CLASS - step)),
        "is_second_class_lower": flag(cgpa.between(SECOND_LOWER, SECOND_UPPER - step)),
        "is_third_class": flag(cgpa.between(THIRD_CLASS, SECOND_LOWER - step)),
        "is_at_risk": flag(cgpa < THIRD_CLASS),
    }


def risk_level(cgpa: Column, failed: Column) -> Column:
    return (
        F.when(cgpa < THIRD_CLASS, "Critical — Probation Risk")
        .when(cgpa < SECOND_LOWER, "Warning — Third Class Range")
        .when(failed >= MANY_FAILURES, "Warning — Multiple Failures")
        .otherwise("Monitor")
    )


def failure_flag(failed: Column, total: Column, high=HIGH_FAILURE_PCT, elevated=ELEVATED_FAILURE_PCT) -> Column:
    """Compares the unrounded rate with the thresholds."""
    return (
        F.when(failed * 100 > total * high, "HIGH RISK")
        .when(failed * 100 > total * elevated, "ELEVATED")
        .otherwise("NORMAL")
    )


def run_health(status: Column, warnings: Column) -> Column:
    return (
        F.when((status == "SUCCESS") & (warnings == 0), "Healthy")
        .when((status == "SUCCESS") & (warnings > 0), "Healthy with Warnings")
        .when(status == "PARTIAL", "Partial — Check Logs")
        .when(status == "FAILED", "FAILED — Action Required")
        .otherwise("Unknown")
    )


def folded(column: Column, case_insensitive: bool = True) -> Column:
    """A text to compare: as is, or without case and trailing blanks."""
    return F.lower(F.rtrim(column)) if case_insensitive else column


def full_name(first: Column, last: Column) -> Column:
    """First and last name around one blank; a missing part counts as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
