from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from spanvec.session import local_session, ship_package

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session


@pytest.fixture
def rng():
    return np.random.default_rng(7)


@pytest.fixture
def collection(spark, rng):
    """200 vectors of dimension 8 with exact copies, so that ties occur."""
    base = rng.normal(size=(150, 8))
    block = np.vstack([base, base[:50]])
    rows = [(i, [float(x) for x in v], i % 4, "ABC"[i % 3]) for i, v in enumerate(block)]
    return spark.createDataFrame(rows, "id bigint, vector array<double>, label int, category string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
