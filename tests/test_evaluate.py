from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import evaluate
from plumbline.plans import jobs

START = datetime(2024, 1, 1)
RUNS = "run_id int, started_at timestamp, stopped_at timestamp"
SAMPLES = "run_id int, ts timestamp, util double"


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.mark.parametrize("limits", [(1 << 20, 10), (0, 10), (0, 2)])
def test_utilization(spark, monkeypatch, limits):
    monkeypatch.setattr(evaluate, "BROADCAST_BYTES", limits[0])
    monkeypatch.setattr(evaluate, "SALT_ROWS", limits[1])
    runs = spark.createDataFrame([(i, at(10), at(20)) for i in (1, 2, 3)], RUNS)
    samples = spark.createDataFrame(
        [(1, at(9), 99.0), (1, at(10), 10.0), (1, at(20), 30.0), (1, at(21), 99.0), (2, at(15), -5.0)],
        SAMPLES,
    )
    found = pl.utilization_summary(runs, samples).orderBy("run_id").collect()
    assert [(r.util_avg, r.util_peak, r.n_samples) for r in found] == [
        (20.0, 30.0, 2),
        (-5.0, 0.0, 1),
        (0.0, 0.0, 0),
    ]


def test_labels_and_profile(points, spark):
    table = points([(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 2), (2, [0.0, 0.0], 5)])
    profile = pl.dataset_profile(table).first()
    assert (profile.n_rows, profile.n_features, profile.n_classes) == (3, 2, 3)
    for count in (pl.num_classes, pl.num_classes_max):
        with pytest.raises(ValueError, match="empty labels"):
            count(points([]))


def test_accuracy_of_rows_paired_by_id(points):
    truth = points([(i, [0.0], i % 2) for i in range(10)]).select("row_id", "label")
    predicted = truth.select("row_id", F.lit(1).alias("prediction"))
    found = pl.accuracy(pl.pair_with_truth(predicted, truth)).first()
    assert (found.n_rows, found.n_correct, found.accuracy) == (10, 5, 0.5)


@pytest.fixture(scope="module")
def report(spark):
    table = spark.range(60).select(
        F.col("id").alias("row_id"),
        F.array((F.col("id") % 3).cast("float"), F.lit(1.0).cast("float")).alias("features"),
        (F.col("id") % 3).cast("int").alias("label"),
    )
    return pl.sweep(table, budgets=(30, -1)).cache()


def test_report(report):
    rows = report.orderBy("run_id").collect()
    assert [(r.model, r.train_rows, r.test_rows) for r in rows] == [
        (model, train, test)
        for train, test in ((24, 6), (48, 12))
        for model in ("Random Forest", "KNN", "KMeans")
    ]
    for r in rows:
        predict_ms = r.total_time_ms - r.train_time_ms
        assert r.prediction_throughput == pytest.approx(r.test_rows / (predict_ms / 1000))
        assert r.accuracy == (None if r.model == "KMeans" else 1.0)
        assert (r.util_avg, r.util_peak) == (0.0, 0.0)


def test_report_csv(report, spark, tmp_path):
    path = str(tmp_path / "report")
    pl.write_report(report, path)
    lines = spark.read.text(path).collect()
    assert lines[0].value == (
        "Model,TrainRows,TestRows,TrainTime(ms),PredictionThroughput(ops),TotalTime(ms),"
        "Accuracy,GPUAvg,GPUPeak"
    )
    back = {(r.model, r.train_rows): r for r in pl.read_report(spark, path).collect()}
    for r in report.collect():
        b = back[r.model, r.train_rows]
        assert b.train_time_ms == pytest.approx(r.train_time_ms, abs=5e-4)
        assert b.accuracy == r.accuracy


def test_report_summary(report):
    texts = {r.run_id: r.summary for r in pl.report_summary(report).collect()}
    assert texts[0].startswith("=== Random Forest ===\nTrain Rows            : 24\n")
    assert "Accuracy              : 100.00%" in texts[1]
    assert "Accuracy" not in texts[2] and texts[2].endswith("samples/sec")


def test_sweep_with_samples(spark, points):
    table = points([(i, [float(i % 2)], i % 2) for i in range(20)])
    now = datetime.now()
    taken = spark.createDataFrame(
        [(now + timedelta(milliseconds=20 * i), float(i % 7)) for i in range(-50, 3000)],
        "ts timestamp, util double",
    )
    found = pl.sweep(table, samples=taken, jobs=(jobs.knn_job,)).first()
    assert found.util_peak == 6.0 and 2.0 < found.util_avg < 4.0
