"""Write-side operators over immutable tables: upsert, replace by key, append once, close by key.

Each returns the new content of the target.  The target is joined to the
incoming rows from its own side, so that a small batch is broadcast by Spark
and the large target is not shuffled; a large batch falls back to a
sort-merge join on a unique key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unmatched(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the target lacks."""
    keys = list(keys)
    present = target.select(*keys).join(rows.select(*keys).distinct(), keys, "left_semi").distinct()
    return rows.join(present, keys, "left_anti")


def type1_upsert(target: DataFrame, source: DataFrame, key: str, update: Sequence[str] | None = None) -> DataFrame:
    """Overwrite on match, insert otherwise.

    ``update`` names the columns refreshed on a match (default: all the source
    has); columns only the target has keep their value, NULL on insert.
    """
    refreshed = set(source.columns if update is None else update) - {key}
    incoming = source.select(F.col(key), F.struct(*source.columns).alias("_new"))
    is_match = F.col("_new").isNotNull()
    updated = target.join(incoming, key, "left").select(
        *[
            F.when(is_match, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in refreshed else F.col(c)
            for c in target.columns
        ]
    )
    inserted = unmatched(source, target, [key])
    return updated.unionByName(inserted, allowMissingColumns=True).select(*target.columns)


def replace_affected_keys(target: DataFrame, rows: DataFrame, affected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the target's rows with an affected key, add the new rows."""
    keys = list(keys)
    kept = target.join(affected.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(rows.select(*target.columns))


def idempotent_append(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows whose key the target lacks; a second run adds nothing."""
    return target.unionByName(unmatched(rows, target, keys), allowMissingColumns=True)


def update_by_keys(target: DataFrame, affected: DataFrame, keys: Sequence[str], values: dict[str, Column], where: Column) -> DataFrame:
    """Set columns on the rows that have an affected key and satisfy ``where``."""
    keys = list(keys)
    hits = affected.select(*keys).distinct().withColumn("_hit", F.lit(True))
    chosen = F.col("_hit").isNotNull() & where
    return target.join(hits, keys, "left").select(
        *[F.when(chosen, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns]
    )


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill missing or NULL columns with their default."""
    have = set(df.columns)
    filled = {c: F.coalesce(F.col(c), F.lit(v)) if c in have else F.lit(v) for c, v in defaults.items()}
    return df.withColumns(filled)


def latest_runs(log: DataFrame, order: Sequence[str] = ("run_finished_at",)) -> DataFrame:
    """Last state of each run in an append-only log; an entry without an end precedes one with."""
    state = [c for c in log.columns if c != "etl_run_id"]
    newest = F.max_by(F.struct(*state), F.struct(*[F.col(c) for c in order]))
    return log.groupBy("etl_run_id").agg(newest.alias("s")).select("etl_run_id", "s.*")
