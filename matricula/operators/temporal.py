"""Versions with half-open validity: building, time travel, point-in-time lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DateType

from ..functions.dates import OPEN_END
from ..session import stored


def next_in_key(df: DataFrame, keys: Sequence[str], at: str, out: str, bucket: str = "hour") -> DataFrame:
    """Add the next ``at`` of the same key, NULL on the last; rows are unique on (keys, at).

    With dates a key has at most one row per calendar day.  With timestamps a
    key may hold any number of rows, so it is ordered within buckets of time
    and only the first moment of each bucket crosses to the one before.
    """
    keys = list(keys)
    if isinstance(df.schema[at].dataType, DateType):
        return df.withColumn(out, F.lead(at).over(Window.partitionBy(*keys).orderBy(at)))
    bucketed = df.withColumn("_bucket", F.date_trunc(bucket, F.col(at)))
    group = [*keys, "_bucket"]
    following = (
        bucketed.groupBy(*group)
        .agg(F.min(at).alias("_first"))
        .withColumn("_later", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bucket")))
        .drop("_first")
    )
    within = F.lead(at).over(Window.partitionBy(*group).orderBy(at))
    return (
        bucketed.withColumn("_within", within)
        .join(following, group)
        .withColumn(out, F.coalesce("_within", "_later"))
        .select(*df.columns, out)
    )


def versions_from_changes(
    changes: DataFrame, key: str, at: str, attributes: Sequence[str], sequence: str | None = None
) -> DataFrame:
    """One version per (key, moment): the last change of the moment, valid until the next one.

    Changes overtaken in the same moment would be versions of no length and
    are left out.  ``sequence`` orders the changes of one moment.
    """
    attributes = list(attributes)
    last = F.max(F.struct(*([sequence] if sequence else []), *attributes)).alias("_last")
    one = changes.groupBy(key, at).agg(last).select(key, F.col(at).alias("valid_from"), *[F.col(f"_last.{c}") for c in attributes])
    end = F.lit(OPEN_END).cast(one.schema["valid_from"].dataType)
    return next_in_key(one, [key], "valid_from", "valid_to").withColumn("valid_to", F.coalesce("valid_to", end))


def merge_changes(versions: DataFrame, changes: DataFrame, key: str, at: str, attributes: Sequence[str], sequence: str) -> DataFrame:
    """Stored versions (with their ``sequence``) after changes that come late and in any order.

    Only the versions of keys with a change are taken apart: each gives back the change that opened it, the late ones
    are put between them, intervals are split where they fall, and a change that another one of the same moment
    overtakes leaves no version.  All other keys' versions stay as they are.
    """
    columns = [key, "valid_from", "valid_to", *attributes, sequence]
    late = changes.select(key, F.col(at).alias("valid_from"), *attributes, sequence)
    touched = late.select(key).distinct()
    opened = versions.join(touched, key, "left_semi").select(*late.columns)
    last = F.max(F.struct(sequence, *attributes)).alias("_last")
    one = opened.unionByName(late).groupBy(key, "valid_from").agg(last).select(key, "valid_from", F.col("_last")[sequence].alias(sequence), *[F.col(f"_last.{c}") for c in attributes])
    end = F.lit(OPEN_END).cast(one.schema["valid_from"].dataType)
    again = next_in_key(one, [key], "valid_from", "valid_to").withColumn("valid_to", F.coalesce("valid_to", end))
    return versions.select(*columns).join(touched, key, "left_anti").unionByName(again.select(*columns))


def system_time(versions: DataFrame, mode: str, start=None, end=None, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Time travel: ``as_of`` a moment, ``between`` two moments (both included), or ``all`` versions."""
    opens, closes = F.col(valid_from), F.col(valid_to)
    if mode == "all":
        return versions
    if mode == "as_of":
        return versions.where((opens <= F.lit(start)) & (closes > F.lit(start)))
    if mode == "between":
        return versions.where((opens <= F.lit(end)) & (closes > F.lit(start)))
    raise ValueError(f"unknown mode {mode!r}")


def asof_lookup(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    attributes: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
) -> DataFrame:
    """Attach to each fact the version of its key valid at the fact's date; versions of a key do not overlap.

    Facts and versions are put in one order of key and time, dealt by range, so a busy key spreads over as many
    partitions as its rows need.  A first pass carries the last version along within a partition; a second one carries
    it over the borders, for which only each partition's last version per key moves.
    """
    spark = facts.sparkSession
    columns = [f"f{i}" for i in range(len(facts.columns))]
    # A day meets moments as its first moment.
    kind = versions.schema[valid_from].dataType if isinstance(facts.schema[at].dataType, DateType) else facts.schema[at].dataType
    fact = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(facts.columns, columns, strict=True)])
    version = F.struct(F.col(valid_to).alias("_to"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(attributes)])
    known = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    opened = known.select(F.col(key).alias("_key"), F.col(valid_from).cast(kind).alias("_at"), F.lit(0).alias("_side"), version.alias("_version"), F.col(valid_to).alias("_end"))
    asked = facts.select(F.col(key).alias("_key"), F.col(at).cast(kind).alias("_at"), F.lit(1).alias("_side"), fact.alias("_fact"))
    order = ["_key", "_at", "_side", "_end"]
    both = opened.unionByName(asked, allowMissingColumns=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(both.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "as-of")
    here = Window.partitionBy("_part", "_key").orderBy("_at", "_side", "_end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = dealt.withColumn("_seen", F.last("_version", ignorenulls=True).over(here))
    last = dealt.where("_side = 0").groupBy("_part", "_key").agg(F.max_by("_version", F.struct("_at", "_end")).alias("_last"))
    # One row per key and partition that holds it: few rows a key, and no more than partitions and keys together.
    present = dealt.groupBy("_part", "_key").agg(F.lit(1).alias("_one")).drop("_one").join(last, ["_part", "_key"], "left")
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    border = present.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)).where("_before IS NOT NULL").select("_part", "_key", "_before")
    joined = carried.where("_side = 1").join(border, ["_part", "_key"], "left").withColumn("_seen", F.coalesce("_seen", "_before"))
    valid = F.col("_seen").isNotNull() & (F.col("_at") < F.col("_seen._to"))
    found = joined.withColumn("_seen", F.when(valid, F.col("_seen")))
    if how == "inner":
        found = found.where("_seen IS NOT NULL")
    return found.select(
        *[F.col(f"_fact.{n}").alias(c) for c, n in zip(facts.columns, columns, strict=True)], *[F.col(f"_seen.v{i}").alias(c) for i, c in enumerate(attributes)]
    )
