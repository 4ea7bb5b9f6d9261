"""Incremental extraction by high-water mark, and the watermark table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, functions as F

from ..functions.dates import FIRST_WATERMARK
from ..sources.reference_data import LOADED_ENTITIES


def changed_since(df: DataFrame, watermark: datetime, until: datetime | None = None, column: str = "updated_at") -> DataFrame:
    """Rows with ``watermark < column <= until``; literal bounds, so the filter reaches the Parquet scan."""
    bound = F.col(column) > F.lit(watermark).cast("timestamp_ntz")
    if until is not None:
        bound = bound & (F.col(column) <= F.lit(until).cast("timestamp_ntz"))
    return df.where(bound)


def pivot_watermarks(watermarks: DataFrame, entities=LOADED_ENTITIES) -> DataFrame:
    """One row, one ``wm_<entity>`` column per entity."""
    mark = lambda e: F.max(F.when(F.col("entity_name") == e, F.col("last_extracted_at")))
    return watermarks.agg(*[mark(e).alias(f"wm_{e}") for e in entities])


def read_watermarks(watermarks: DataFrame, force_full: bool = False, entities=LOADED_ENTITIES) -> dict[str, datetime]:
    """Marks by entity; the first watermark for all on a full reload, and where none is stored."""
    if force_full:
        return dict.fromkeys(entities, FIRST_WATERMARK)
    row: Row = pivot_watermarks(watermarks, entities).first()
    return {e: row[f"wm_{e}"] or FIRST_WATERMARK for e in entities}


def advance_watermarks(watermarks: DataFrame, until: datetime, entities=LOADED_ENTITIES) -> DataFrame:
    """The watermark table with the loaded entities set to ``until``; the others stay."""
    loaded = F.col("entity_name").isin(*entities)
    now = F.lit(until).cast("timestamp_ntz")
    moved: Column = lambda c: F.when(loaded, now).otherwise(F.col(c)).alias(c)
    return watermarks.select(
        *[moved(c) if c in ("last_extracted_at", "updated_at") else F.col(c) for c in watermarks.columns]
    )
