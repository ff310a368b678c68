"""Every query against its SQL on the smallest tables, and checks of the others."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

TINY = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels"
QUERIES = entry_points.queries()
# Queries of the corpus operators have tests of their own.
SQL = {n: s for n, s in entry_points.oracle_sql().items() if n != "pipeline" and not n.startswith("op")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TINY}/{name}.parquet'")
    return con


def ordered(frame):
    columns = sorted(frame.columns)
    return frame[columns].sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ours = ordered(QUERIES[name](spark, TINY).toPandas())
    theirs = ordered(duck.execute(SQL[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)


def test_entry(spark):
    assert entry_points.entry(spark).first().n_rows == 100


def test_every_query_of_the_library_has_sql():
    own = {n for n in QUERIES if n != "pipeline" and not n.startswith("op")}
    assert own <= set(SQL)


@pytest.mark.parametrize("name", ["rf_accuracy", "rf_fit_predict"])
def test_forest_on_more_rows(spark, name):
    found = QUERIES[name](spark, "/root/testdata/sf0.01").toPandas()
    assert len(found) and found.iloc[:, -1].all()


def test_forest_finds_both_classes_of_rows_it_has_not_seen(spark):
    model, test = entry_points._forest(spark, "/root/testdata/sf0.01")
    found = model.predict(test).groupBy("label").agg({"*": "count"}).collect()
    right = model.predict(test).filter("label = prediction").groupBy("label").agg({"*": "count"}).collect()
    right = {r[0]: r[1] for r in right}
    assert len(found) == 2 and all(right.get(r[0], 0) > 0.6 * r[1] for r in found)
