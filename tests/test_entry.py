import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
# One query per kind of work; tools/check.py runs all of them.
CHECKED = [
    "i4_linear_interpolation", "f7_f11_f12_financial_features", "a6_column_stats", "a10_correlation_matrix",
    "e4_rank_by_mutual_information", "v2_class_report", "s10_split_segments", "m10_j5_density_clusters",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 3 and df.columns[0] == "reod"


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None
