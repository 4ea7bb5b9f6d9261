"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans rely on.  Broadcasts are left to Spark's own
# size check (autoBroadcastJoinThreshold on file and shuffle statistics);
# joins past it run sort-merge and split hot keys at run time, also where the
# split costs one more shuffle.  Rows dealt by some of a join's keys are not
# dealt again by all of them.  Files are compressed: their rows are taken to be
# this many times as large, since a side sent to all tasks is built in the
# driver from rows, not from files.
RUNTIME_SETTINGS = {
    "spark.sql.sources.fileCompressionFactor": "32",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}

# spark.checkpoint.dir is fixed when the application starts, so a folder made
# here (local mode only) is remembered per application.
_LOCAL_FOLDERS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "matricula", cpus: str = "*", memory: str = "8g") -> SparkSession:
    """Local session for tests and bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder for written tables: the one the cluster names, else a local one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="matricula-")
    return _LOCAL_FOLDERS[app]


def buckets(spark: SparkSession) -> int:
    """Into how many buckets tables are dealt that are stored by key."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/matricula/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, of known size, and kept when executors are lost."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
