"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from conftest import SMALL, plan_of

import __spark_entry__ as entry
from tools.check_queries import rows

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    got = rows(df.columns, df.collect())
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Python runs on Arrow batches only.
    assert "BatchEvalPython" not in plan
    if name not in ORACLES:
        assert got
        return
    cur = db.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 50


def test_compact_report_of_a_table_in_parts(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/embeddings.parquet").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    df = QUERIES["compact_report"](spark, str(tmp_path))
    assert rows(df.columns, df.collect()) == rows(df.columns, db.execute(ORACLES["compact_report"]).fetchall())
