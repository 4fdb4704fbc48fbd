import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, as_rows
from tallyworks import plans
from tallyworks.plans.registry import Query, query

SAMPLE = [
    "covers_all", "last_within_cap", "dense_rank_many_values", "category_pairs", "consecutive_runs",
    "asof_row_join", "row_fingerprint", "change_log_latest", "metric_union", "weekday_gap",
    "pivot_with_total", "allocate_fifo", "document_numbers", "profile", "session_windows",
]
NAMES = sorted(plans.queries()) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def db(data_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())
    assert len(plans.queries()) > 100 and set(plans.queries()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, db, data_dir, name):
    df = entry.queries()[name](spark, data_dir)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert as_rows(df.columns, df.collect()) == as_rows(columns, cursor.fetchall())


def test_registry_refuses_a_second_query_of_the_same_name():
    def covers_all(t):
        return t

    with pytest.raises(ValueError):
        query("a BIGINT")(covers_all)


def test_query_without_sql_has_no_oracle():
    assert Query("q", lambda t: t, (("a", "BIGINT"),), None).oracle() is None


def explained(spark, data_dir, name):
    df = entry.queries()[name](spark, data_dir)
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_rows_are_cut_before_the_shuffle(spark, data_dir):
    plan = explained(spark, data_dir, "last_n_increasing")
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert "Partial" in plan[partial : partial + 300]


@pytest.mark.parametrize("name", ["conditional_summary", "signed_sum", "category_pairs", "metric_union", "top_degree"])
def test_no_cartesian_product(spark, data_dir, name):
    plan = explained(spark, data_dir, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_needed_columns_are_read(spark, data_dir):
    plan = explained(spark, data_dir, "signed_sum")
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_returnflag:string>" in plan
