"""Every query of the subpackage has SQL, or a test file that compares it with something exact."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, as_rows
from tallyworks.llm.queries import QUERIES, SQL

# Queries that SQL cannot say, and the test that holds them against brute force, a library or held-out rows.
OTHERWISE = {
    "op1_pii": "test_llm_models.py", "op2_line_dedup": "test_llm_duplicates.py", "op3_quality": "test_llm_models.py",
    "op4_language_model": "test_llm_models.py", "op5_simhash": "test_llm_duplicates.py", "op7_packing": "test_llm_search.py",
    "op10_license_scan": "test_llm_search.py", "op11_word_bpe": "test_llm_word_bpe.py", "op12_spelling_variants": "test_llm_spelling.py",
    "pipeline": "test_llm_pipeline.py",
}


def test_every_query_is_held_against_something():
    assert set(QUERIES) | {"pipeline"} == set(SQL) | set(OTHERWISE) and not set(SQL) & set(OTHERWISE)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    for name in OTHERWISE.values():
        assert os.path.exists(os.path.join(os.path.dirname(__file__), name))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, data_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data_dir}/{table}.parquet'")
    df = QUERIES[name](spark, data_dir)
    cursor = db.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert as_rows(df.columns, df.collect()) == as_rows(columns, cursor.fetchall())
