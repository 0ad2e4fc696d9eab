"""Registered queries against their SQL counterparts, and the plans behind them."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from rollcall.demo import derived as d
from rollcall.demo import queries as q
from rollcall.operators import matching as m

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in glob.glob(FOLDER + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    found = contract.queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    result = database.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    wanted = [tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()]
    rows = [tuple(plain(row[c]) for c in columns) for row in found.collect()]
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)
    assert rows


def test_phonetic_queries_only_add_to_the_edit_scores(spark):
    edit = {r["finder_number"]: r for r in q.match_best(spark, FOLDER).collect()}
    both = {r["finder_number"]: r for r in q.match_phonetic(spark, FOLDER).collect()}
    low = q.match_phonetic_low(spark, FOLDER).count()
    assert set(edit) == set(both) and low >= len(both)
    for key, row in both.items():
        assert row["match_type"] == edit[key]["match_type"]
    assert contract.entry(spark).columns == q.match_best(spark, FOLDER).columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_match_plan(spark):
    text = plan(q.match_best(spark, FOLDER))
    assert "WindowGroupLimit" in text
    # One evaluation of the address score, one of both name scores; nothing row by row.
    assert text.count("ArrowEvalPython") == 2 and "BatchEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_large_tables_join_by_block_with_one_shuffle_each(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = m.blocked_list(d.people(spark, FOLDER), d.MAPPING), m.blocked_consumers(d.consumers(spark, FOLDER))
        text = plan(m.candidate_pairs(*sides, d.MAPPING, m.MatchRules()))
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_state_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "consumers")
    d.consumers(spark, FOLDER).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("unused", F.lit(1))
    exact = plan(m.blocked_consumers(stored, "OH", state_exact=True))
    assert "EqualTo(state,OH)" in exact and "unused" not in exact.split("ReadSchema")[1]


def test_geo_plan_shuffles_cells_by_band(spark):
    text = plan(q._tiers(spark, FOLDER).flat)
    assert "Generate" in text and "SinglePartition" not in text
