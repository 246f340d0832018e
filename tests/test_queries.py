"""Every registered query against its SQL in another engine, on whole tables."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_file
from labelgrain.plans import table_queries as Q

TABLES = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_file.queries(), entry_file.oracle_sql()
BASE = sorted(set(ORACLES) & set(Q.QUERIES))

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return con


def canonical(columns, rows):
    def cell(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_names_agree():
    assert set(ORACLES) <= set(QUERIES)
    assert set(Q.QUERIES) - set(ORACLES) == {"classifier_scores", "epoch_log", "trial_log"}


@pytest.mark.parametrize("name", BASE)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


def test_every_trial_has_a_loss(spark):
    log = QUERIES["trial_log"](spark, TABLES).collect()
    assert len(log) == 2 and all(r["train_loss"] > 0 for r in log)
