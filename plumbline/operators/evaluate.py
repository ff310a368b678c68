"""Checks before a fit, and summaries of labels, predictions and runs."""

from pyspark.sql import functions as F

from plumbline.session import scratch, written_table

BROADCAST_BYTES = 16 << 20
# Readings of one run that are summed in one task, about.
SALT_ROWS = 1_000_000


def training_shape(df, features="features", label=None):
    """Rows and width of a training table; fails where a fit cannot go on."""
    column = F.col(features)
    checks = [
        F.count("*").alias("rows"),
        F.min(F.size(column)).alias("low"),
        F.max(F.size(column)).alias("high"),
        F.count_if(column.isNull() | F.exists(column, lambda x: x.isNull())).alias("holes"),
        (F.count_if(F.col(label).isNull()) if label else F.lit(0)).alias("unlabelled"),
    ]
    found = df.agg(*checks).first()
    if found["rows"] == 0:
        raise ValueError("empty matrix")
    if found["holes"] or found["low"] != found["high"] or found["low"] < 1:
        raise ValueError("ragged matrix")
    if found["unlabelled"]:
        raise ValueError("number of labels does not match number of rows")
    return found["rows"], found["high"]


def num_classes(df, label="label"):
    """Number of distinct labels."""
    found = df.agg(F.count_distinct(label).alias("n")).first()["n"]
    if found == 0:
        raise ValueError("empty labels")
    return found


def num_classes_max(df, label="label"):
    """Highest label plus one, which counts ids that never occur."""
    found = df.agg(F.max(label).alias("top")).first()["top"]
    if found is None:
        raise ValueError("empty labels")
    return found + 1


def dataset_profile(df, features="features", label="label"):
    """One row: number of rows, features and classes."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.max(F.size(features)).alias("n_features"),
        F.count_distinct(label).alias("n_classes"),
    )


def pair_with_truth(predicted, truth, row_id="row_id"):
    """Predictions and true labels of the same rows side by side."""
    return predicted.join(truth, row_id)


def accuracy(df, label="label", prediction="prediction"):
    """One row: test rows, right predictions and their share."""
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(hit), F.lit(0)).alias("n_correct"),
        F.avg(hit.cast("double")).alias("accuracy"),
    )


def cluster_sizes(df, prediction="prediction"):
    """Rows of each cluster that holds any."""
    return df.groupBy(prediction).agg(F.count("*").alias("n_rows"))


def utilization_summary(runs, samples, run="run_id", ts="ts", value="util"):
    """Average and peak of the samples taken between start and stop of each run.

    ``runs`` holds one row per run with ``started_at`` and ``stopped_at``. A run
    without samples has average and peak 0, and no peak is below 0. Samples are
    summed before the shuffle; when the runs are too many bytes to broadcast, the
    samples of a run that has many are spread over as many tasks as they need.
    """
    with scratch(runs.sparkSession) as keep:
        return keep(_summary(written_table(runs, "runs"), samples, run, ts, value), "utilization")


def _summary(runs, samples, run, ts, value):
    spans = runs.select(run, "started_at", "stopped_at")
    taken = samples.select(run, F.col(ts).alias("_ts"), F.col(value).alias("_value"))
    size = spans.agg(F.sum(F.octet_length(F.col(run).cast("string")) + 16)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = taken.join(F.broadcast(spans), run)
    else:
        counts = taken.groupBy(run).agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("_salts"))
        # One run for each SALT_ROWS readings at most; Spark broadcasts the table if it is small.
        hot = written_table(counts.filter("_salts > 1"), "hot-runs")
        salt = F.pmod(F.xxhash64("_ts", "_value"), F.col("_salts")).cast("int")
        salted = taken.join(hot, run).withColumn("_salt", salt).drop("_salts")
        each = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
        spread = spans.join(hot, run).withColumn("_salt", each).drop("_salts")
        joined = taken.join(hot, run, "left_anti").join(spans, run)
        joined = joined.unionByName(salted.join(spread, [run, "_salt"]).drop("_salt"))
    inside = joined.filter(F.col("_ts").between(F.col("started_at"), F.col("stopped_at")))
    found = inside.groupBy(run).agg(
        F.avg("_value").alias("_avg"), F.max("_value").alias("_max"), F.count("_value").alias("_n")
    )
    none = F.lit(0.0)
    return runs.join(found, run, "left").select(
        *runs.columns,
        F.coalesce("_avg", none).alias("util_avg"),
        F.greatest(F.coalesce("_max", none), none).alias("util_peak"),
        F.coalesce("_n", F.lit(0)).alias("n_samples"),
    )
