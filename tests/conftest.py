import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from matricula.session import build_session

    return build_session("matricula-tests", os.environ.get("TEST_CPUS", "8"), "6g")


@pytest.fixture(scope="session")
def raw_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, raw_dir):
    from matricula.plans.warehouse import open_tables

    return open_tables(spark, raw_dir)
