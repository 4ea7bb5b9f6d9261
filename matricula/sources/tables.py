"""Named tables stored as Parquet below the shared folder, read back with explicit schemas.

A table that takes a join or an aggregate to build is written the first time
it is asked for; a plain projection of another table stays a view.  Stored
tables give Spark true sizes, so it can tell which join sides are small enough
to broadcast, and cut the lineage of everything built on them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SOURCE, WAREHOUSE, conform, schema_of
from ..session import buckets, fresh_folder

Builder = Callable[["Tables"], DataFrame]

# Facts are stored by period: loads rewrite, and reports read, only the periods concerned.
PARTITIONED = {"fact_enrollment": "period_sk", "fact_registration_event": "period_sk"}
# Registrations (a view of first lines) and results meet by this key in most plans: dealt into buckets by it once, they
# meet without a shuffle.
BUCKETED = {"first_line": "registration_id", "course_result": "registration_id"}


class Tables(Mapping):
    """Read access to raw, source and warehouse tables by name."""

    def __init__(self, spark: SparkSession, raw_dir: str, builders: dict[str, Builder], views: frozenset[str] = frozenset()):
        self.spark = spark
        self.raw_dir = raw_dir.rstrip("/")
        self._builders = builders
        self._views = views
        self._frames: dict[str, DataFrame] = {}
        self._folder = fresh_folder(spark, "tables")
        self._building = RLock()  # loads ask for tables side by side

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.raw_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        with self._building:
            if name not in self._frames:
                if name in self._views:
                    self._frames[name] = typed(self._builders[name](self), name)
                else:
                    path = f"{self._folder}/{name}"
                    write_table(self._builders[name](self), name, path)
                    self._frames[name] = self.spark.table(stored_name(path)) if name in BUCKETED else read_table(self.spark, name, path)
            return self._frames[name]

    def __contains__(self, name) -> bool:
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def create_views(self, names=None) -> None:
        """Register the tables as temporary views."""
        for name in names or self:
            self[name].createOrReplaceTempView(name)


def typed(df: DataFrame, name: str) -> DataFrame:
    return conform(df, name) if name in SOURCE or name in WAREHOUSE else df


def stored_name(path: str) -> str:
    """The name under which the session knows a bucketed table; its files are below ``path``."""
    return re.sub(r"\W", "_", "_".join(path.rsplit("/", 2)[-2:]))


def write_table(df: DataFrame, name: str, path: str) -> None:
    df = typed(df, name)
    partition, key = PARTITIONED.get(name), BUCKETED.get(name)
    if partition:
        # A task writes a file per period: periods are few, and gathering them would move every row once more.
        df.write.partitionBy(partition).parquet(path)
    elif key:
        # The builder deals the rows by this key.
        df.write.format("parquet").bucketBy(buckets(df.sparkSession), key).option("path", path).saveAsTable(stored_name(path))
    else:
        df.write.parquet(path)


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    if name in SOURCE or name in WAREHOUSE:
        return spark.read.schema(schema_of(name)).parquet(path)
    return spark.read.parquet(path)
