"""Whole jobs: split, fit, predict, evaluate, and the report over them."""

import time
from datetime import datetime, timezone

from pyspark.sql import functions as F

from plumbline.operators.evaluate import accuracy, num_classes, utilization_summary
from plumbline.operators.forest import fit_random_forest
from plumbline.operators.kmeans import fit_kmeans
from plumbline.operators.knn import DEFAULT_K, fit_knn
from plumbline.operators.order import cap_rows
from plumbline.operators.split import split_by_key
from plumbline.session import scratch, written_table

# The parameters the jobs run with.
JOB_TREES = 100
JOB_DEPTH = 10
JOB_ITERATIONS = 300
JOB_TOLERANCE = 1e-4

REPORT = (
    "run_id int, model string, train_rows long, test_rows long, train_time_ms double, "
    "prediction_throughput double, total_time_ms double, accuracy double, "
    "started_at timestamp, stopped_at timestamp"
)


def _clock():
    return time.perf_counter() * 1000.0, datetime.now(timezone.utc)


def _run(name, df, key, parts, fit, predict, score):
    """One report row. Predicting and scoring are one pass over the test rows."""
    parts = parts or split_by_key(df, key)
    begun, started_at = _clock()
    model = fit(parts.train)
    fitted, _ = _clock()
    quality = score(predict(model, parts.test))
    ended, stopped_at = _clock()
    predict_ms = ended - fitted
    return {
        "model": name,
        "train_rows": parts.train_rows,
        "test_rows": parts.test_rows,
        "train_time_ms": fitted - begun,
        "prediction_throughput": parts.test_rows / (predict_ms / 1000.0),
        "total_time_ms": ended - begun,
        "accuracy": quality,
        "started_at": started_at,
        "stopped_at": stopped_at,
    }


def _accuracy(predicted):
    return accuracy(predicted).first()["accuracy"]


def _predict_only(predicted):
    predicted.agg(F.count("prediction")).first()


def forest_job(df, key="row_id", trees=JOB_TREES, max_depth=JOB_DEPTH, parts=None):
    """Random forest on the first 80 % of the rows, scored on the rest."""

    def fit(train):
        return fit_random_forest(train, trees, max_depth, row_id=key)

    return _run("Random Forest", df, key, parts, fit, lambda m, test: m.predict(test), _accuracy)


def knn_job(df, key="row_id", k=DEFAULT_K, parts=None):
    """Nearest neighbours on the first 80 % of the rows, scored on the rest."""

    def fit(train):
        return fit_knn(train, k, row_id=key)

    return _run("KNN", df, key, parts, fit, lambda m, test: m.predict(test, row_id=key), _accuracy)


def kmeans_job(df, key="row_id", max_iter=JOB_ITERATIONS, parts=None):
    """As many clusters as classes on the first 80 % of the rows; no accuracy."""
    clusters = num_classes(df)

    def fit(train):
        return fit_kmeans(train, clusters, max_iter, JOB_TOLERANCE, row_id=key)

    return _run("KMeans", df, key, parts, fit, lambda m, test: m.predict(test, row_id=key), _predict_only)


JOBS = (forest_job, knn_job, kmeans_job)


def sweep(df, budgets=(-1,), key="row_id", samples=None, jobs=JOBS):
    """The report of all jobs for each row budget, zero or less being all rows.

    ``samples`` are utilisation readings ``(ts, util)`` that a monitor has
    written; those between start and stop of a run give its average and peak.
    """
    spark = df.sparkSession
    rows = []
    with scratch(spark):
        # Each job passes over the rows many times; they are computed once.
        df = written_table(df.select(key, "features", "label"), "sweep")
        for budget in budgets:
            capped = cap_rows(df, budget, key)
            parts = split_by_key(capped, key)
            for job in jobs:
                rows.append({"run_id": len(rows), **job(capped, key, parts=parts)})
    names = [part.split()[0] for part in REPORT.split(", ")]
    report = spark.createDataFrame([tuple(row[n] for n in names) for row in rows], REPORT)
    if samples is None:
        zero = F.lit(0.0)
        return report.withColumn("util_avg", zero).withColumn("util_peak", zero)
    # Runs follow one another, so each reading falls into one of them at most.
    run = F.coalesce(
        *[
            F.when(F.col("ts").between(F.lit(r["started_at"]), F.lit(r["stopped_at"])), r["run_id"])
            for r in rows
        ]
    )
    return utilization_summary(report, samples.withColumn("run_id", run)).drop("n_samples")
