"""Every query of the subpackage that has SQL, against it on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from plumbline.llm import queries

TINY = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TINY}/{name}.parquet'")
    return con


def ordered(frame):
    columns = sorted(frame.columns)
    return frame[columns].sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    ours = ordered(queries.QUERIES[name](spark, TINY).toPandas())
    theirs = ordered(duck.execute(queries.SQL[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-12)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
