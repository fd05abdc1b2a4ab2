"""Every registered query against its DuckDB SQL, and its plan, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_module
from check import differences, duck
from tests.conftest import SMALL

# The queries of the training-data subpackage have tests of their own.
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in entry_module.queries().items() if not OWN.match(name)}
STATEMENTS = {name: sql for name, sql in entry_module.oracle_sql().items() if not OWN.match(name)}


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    got = df.toPandas()
    assert len(got)
    if name in STATEMENTS:
        assert differences(got, connection.execute(STATEMENTS[name]).df()) is None


def test_only_trained_models_lack_sql():
    assert {name for name in QUERIES if name not in STATEMENTS} == {
        "als_factors",
        "als_predict",
        "als_topk_unseen",
        "als_evaluation",
        "als_evaluation_preprocessed",
    }
    assert set(STATEMENTS) <= set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["movieId", "title", "genres", "average_rating_per_movie"]
    assert df.count() > 0


def test_scan_reads_only_needed_columns(spark):
    # Another folder than the one whose ratings other tests hold in memory.
    plan = QUERIES["ratings_per_item"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan and "o_orderdate" not in plan


def test_large_tables_are_read_once(spark, monkeypatch):
    """Branches of one query share the stored ratings: the order lines are scanned by a single execution."""
    from rankwell import skew

    scanned = []
    plain = skew.checkpoint

    def watched(df):
        scanned.append(df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet"))
        return plain(df)

    for module in (entry_module, entry_module.report, entry_module.neighbors, skew):
        monkeypatch.setattr(module, "checkpoint", watched)
    for name in ("preprocess_ratings", "rating_metrics", "novelty", "unseen_candidates", "item_pairs", "catalog_coverage", "evaluation_report"):
        scanned.clear()
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert sum(scanned) + plan.count("lineitem.parquet") == 1, name
