import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import labels as labels_module
from plumbline.operators import order
from plumbline.operators.split import train_size


@pytest.fixture
def small_steps(monkeypatch):
    monkeypatch.setattr(order, "SORT_ROWS", 5)
    monkeypatch.setattr(order, "HISTOGRAM_BINS", 4)
    monkeypatch.setattr(order, "ROWS_PER_PART", 20)


@pytest.fixture
def keys(spark):
    values = random.Random(1).sample(range(-(10**12), 10**12), 150) + list(range(50))
    return spark.createDataFrame([(v,) for v in values], "k long"), sorted(values)


def test_key_at_every_position(small_steps, keys):
    table, ordered = keys
    for position in (0, 1, 7, 74, 75, 76, 120, 198, 199):
        assert order.key_at(table, "k", position) == ordered[position]
    assert order.key_at(table, "k", 200) is None


def test_row_id_is_dense(small_steps, keys):
    table, ordered = keys
    found = {r.k: r.row_id for r in pl.with_row_id(table, "k").collect()}
    assert found == {k: i for i, k in enumerate(ordered)}


def test_cap(small_steps, keys):
    table, ordered = keys
    assert sorted(r.k for r in pl.cap_rows(table, 33, "k").collect()) == ordered[:33]
    assert pl.cap_rows(table, -1, "k").count() == pl.cap_rows(table, 500, "k").count() == 200


def test_cap_inside_copies_of_a_key_fails(spark):
    table = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k long")
    with pytest.raises(ValueError, match="not unique"):
        pl.cap_rows(table, 2, "k")
    assert pl.cap_rows(table, 3, "k").count() == 3


@pytest.mark.parametrize("kind", ["string", "date", "decimal(20,3)", "smallint"])
def test_any_ordered_key(spark, monkeypatch, kind):
    monkeypatch.setattr(order, "SORT_ROWS", 3)
    monkeypatch.setattr(order, "SPLITTERS", 4)
    rng = random.Random(2)
    numbers = rng.sample(range(-20_000, 20_000), 120)
    made = {
        "string": lambda n: chr(0x61 + n % 1000) + str(n) + "é",
        "date": lambda n: datetime.date(2000, 1, 1) + datetime.timedelta(days=n),
        "decimal(20,3)": lambda n: decimal.Decimal(n) / 8 + decimal.Decimal(10) ** 12,
        "smallint": int,
    }[kind]
    values = [made(n) for n in numbers]
    table = spark.createDataFrame([(v,) for v in values], f"k {kind}").repartition(4)
    ordered = sorted(values, key=lambda v: v.encode() if kind == "string" else v)
    for position in (0, 1, 59, 118, 119):
        assert order.key_at(table, "k", position) == ordered[position]
    assert order.key_at(table, "k", 120) is None
    parts = pl.split_by_key(table, "k")
    assert sorted(r.k for r in parts.train.collect()) == sorted(ordered[:96])
    assert {r.k: r.row_id for r in pl.with_row_id(table, "k").collect()} == {v: i for i, v in enumerate(ordered)}


def test_copies_of_any_key_are_refused(spark, monkeypatch):
    monkeypatch.setattr(order, "SORT_ROWS", 3)
    table = spark.createDataFrame([("a",)] + [("hot",)] * 50 + [("z",)], "k string")
    with pytest.raises(ValueError, match="not unique"):
        pl.cap_rows(table, 20, "k")
    assert pl.cap_rows(table, 1, "k").count() == 1 and pl.cap_rows(table, 51, "k").count() == 51
    long = spark.createDataFrame([(1,)] + [(2,)] * 50 + [(3,)], "k long")
    with pytest.raises(ValueError, match="not unique"):
        pl.cap_rows(long, 20, "k")
    with pytest.raises(ValueError, match="null"):
        pl.cap_rows(spark.createDataFrame([("a",), (None,)], "k string"), 1, "k")


def test_order_needs_an_ordered_key_without_nulls(spark):
    with pytest.raises(TypeError):
        pl.cap_rows(spark.createDataFrame([(1.5,)], "k double"), 1, "k")
    with pytest.raises(ValueError, match="null"):
        pl.split_by_key(spark.createDataFrame([(1,), (None,)], "k long"), "k")


@pytest.mark.parametrize("rows, train", [(0, 0), (1, 0), (4, 3), (5, 4), (9, 7), (10, 8)])
def test_split_sizes(spark, rows, train):
    assert train_size(rows) == train
    parts = pl.split_by_key(spark.range(rows).withColumnRenamed("id", "row_id"))
    assert (parts.train_rows, parts.test_rows) == (train, rows - train)
    assert [r.row_id for r in parts.train.orderBy("row_id").collect()] == list(range(train))
    assert parts.test.count() == rows - train


def test_split_of_sorted_classes_tests_on_one_class_only(points):
    parts = pl.split_by_key(points([(i, [0.0], i // 5) for i in range(15)]))
    assert {r.label for r in parts.test.collect()} == {2}


def test_split_is_pushed_into_the_scan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = pl.split_by_key(table, "c_custkey").train._jdf.queryExecution().toString()
    assert "LessThan(c_custkey" in plan and "Exchange" not in plan


def test_large_label_dictionary_is_joined(spark, monkeypatch):
    monkeypatch.setattr(labels_module, "BROADCAST_CLASSES", 3)
    rows = [(i, f"c{(i * 7) % 10}") for i in range(50)]
    encoded, names = pl.encode_first_seen(spark.createDataFrame(rows, "row_id long, kind string"), "kind")
    first = {}
    for _, kind in rows:
        first.setdefault(kind, len(first))
    assert {r.class_name: r.class_id for r in names.collect()} == first
    assert sorted((r.row_id, r.label) for r in encoded.collect()) == [(i, first[k]) for i, k in rows]


def test_every_row_keeps_its_columns(spark):
    table = spark.range(30).withColumn("x", F.col("id") * 2)
    assert pl.with_row_id(table, "id").columns == ["id", "x", "row_id"]


@pytest.mark.parametrize("rows_per_part", [2, 500_000])
def test_row_id_refuses_nulls_and_copies_at_every_size(spark, monkeypatch, rows_per_part):
    monkeypatch.setattr(order, "ROWS_PER_PART", rows_per_part)
    for keys, message in ([(1, None, 3, 4, 5), "null"], [(1, 2, 2, 4, 5), "not unique"]):
        table = spark.createDataFrame([(k,) for k in keys], "k long")
        with pytest.raises(ValueError, match=message):
            pl.with_row_id(table, "k")
