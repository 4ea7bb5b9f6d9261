"""Type-2 history: one open version per key, changed versions closed and reopened."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import OPEN_END
from .load import unmatched

# A version's surrogate is its natural key followed by six digits of version
# number: exact, assigned without ordering all rows, distinct even for two
# changes on one day.  A version or key past the space stops the load.
VERSION_SPACE = 1_000_000

VALIDITY = ("effective_date", "expiry_date", "is_current")


def first_version(key: Column) -> Column:
    return key.cast("bigint") * VERSION_SPACE + 1


def next_version(surrogate: Column) -> Column:
    """The surrogate of the version after this one; an error if the key's numbers are used up."""
    used_up = version_number(surrogate) == VERSION_SPACE - 1
    return F.when(used_up, F.raise_error(F.concat(F.lit("no version number left after "), surrogate.cast("string")))).otherwise(surrogate + 1)


def natural_key(surrogate: Column) -> Column:
    """The key a version belongs to, without a lookup."""
    return F.call_function("div", surrogate, F.lit(VERSION_SPACE))


def version_number(surrogate: Column) -> Column:
    return surrogate % VERSION_SPACE


def differs(left: Column, right: Column, tracked: Sequence[str]) -> Column:
    """Any tracked field changed; a change from or to NULL counts."""
    return reduce(lambda a, b: a | b, [~left[c].eqNullSafe(right[c]) for c in tracked])


def scd2_merge(
    current: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: date,
    surrogate: str,
    known_keys: DataFrame | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Apply a snapshot of changed keys to the open versions.

    Returns every row of ``current`` (kept or now closed) and every version
    opened, with the column ``action``: kept, closed, opened or created.  All
    are decided in one pass before anything is written.  ``known_keys`` holds
    the keys with any version (default: those of ``current``); ``extra``
    gives further columns of opened versions, such as the run id.
    """
    extra = extra or {}
    columns = current.columns
    today = F.lit(as_of).cast("date")

    def opened(source, surrogate_key, action):
        fixed = {
            surrogate: surrogate_key,
            "effective_date": today,
            "expiry_date": F.lit(OPEN_END),
            "is_current": F.lit(True),
            **extra,
        }
        typed = lambda c: (fixed[c] if c in fixed else source(c)).cast(current.schema[c].dataType)
        return [*[typed(c).alias(c) for c in columns], F.lit(action).alias("action")]

    def existing(action, **replaced):
        return F.struct(*[replaced.get(c, F.col(c)).alias(c) for c in columns], F.lit(action).alias("action"))

    missing = [c for c in columns if c not in snapshot.columns and c not in extra and c not in VALIDITY and c != surrogate]
    snapshot = snapshot.withColumns({c: F.lit(None) for c in missing})

    new = F.col("_new")
    changed = new.isNotNull() & differs(F.struct(*tracked), new, tracked)
    stamped = {"dw_updated_at": extra["dw_updated_at"].cast(current.schema["dw_updated_at"].dataType)} if "dw_updated_at" in extra else {}
    closed_row = existing("closed", expiry_date=today, is_current=F.lit(False), **stamped)
    opened_row = F.struct(*opened(lambda c: new[c], next_version(F.col(surrogate)), "opened"))
    versions = F.when(changed, F.array(closed_row, opened_row)).otherwise(F.array(existing("kept")))
    carried = (
        current.join(snapshot.select(key, F.struct(*snapshot.columns).alias("_new")), key, "left")
        .select(F.explode(versions).alias("v"))
        .select("v.*")
    )
    created = unmatched(snapshot, known_keys if known_keys is not None else current, [key]).select(
        *opened(F.col, first_version(F.col(key)), "created")
    )
    return carried.unionByName(created)


def scd2_counts(merged: DataFrame) -> DataFrame:
    """Rows inserted, updated and closed by one merge."""
    by = lambda a: F.count_if(F.col("action") == a)
    return merged.agg(
        by("created").alias("rows_inserted"), by("opened").alias("rows_updated"), by("closed").alias("rows_closed")
    )


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))
