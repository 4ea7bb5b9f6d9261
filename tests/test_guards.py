"""What stops a run, and a session that names no shared folder."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from matricula.operators import scd2
from matricula.plans.pipeline import refuse_repeated
from matricula.sources.reference_data import literal_table
from matricula.sources.store import Store
from matricula.schemas import schema_of


def test_repeated_keys_are_refused(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "k int, v string")
    refuse_repeated(rows.where("v <> 'c'"), ["k"], "t")
    with pytest.raises(ValueError, match="more than one incoming row"):
        refuse_repeated(rows, ["k"], "t")


def test_version_numbers_run_out(spark):
    at = lambda n: spark.createDataFrame([(7 * scd2.VERSION_SPACE + n,)], "sk long").select(scd2.next_version(F.col("sk")).alias("sk"))
    assert at(3).first()[0] == 7 * scd2.VERSION_SPACE + 4
    with pytest.raises(Exception, match="no version number left"):
        at(scd2.VERSION_SPACE - 1).collect()


def test_two_runs_at_once(spark, tmp_path):
    marks = literal_table(spark, [], schema_of("etl_watermark"))
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    first, second = one.write("etl_watermark", marks, 1), two.write("etl_watermark", marks, 1)
    assert set(first.values()).isdisjoint(second.values())
    one.publish(1, {"etl_watermark": first})
    with pytest.raises(RuntimeError, match="published meanwhile"):
        two.publish(1, {"etl_watermark": second})
    Store(spark, str(tmp_path)).publish(2, {"etl_watermark": second})


def test_session_without_a_named_folder(tmp_path):
    """Works in local mode with an empty configuration folder; the setting itself stays unset."""
    code = (
        "from matricula.session import build_session, stored\n"
        "spark = build_session(cpus='1', memory='1g')\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert stored(spark.range(5), 'a').count() + stored(spark.range(4), 'b').count() == 9\n"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
