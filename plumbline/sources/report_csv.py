"""Benchmark report as CSV."""

from pyspark.sql import functions as F

# The report's file header, by the name of the column in the table.
CSV_HEADER = {
    "model": "Model",
    "train_rows": "TrainRows",
    "test_rows": "TestRows",
    "train_time_ms": "TrainTime(ms)",
    "prediction_throughput": "PredictionThroughput(ops)",
    "total_time_ms": "TotalTime(ms)",
    "accuracy": "Accuracy",
    "util_avg": "GPUAvg",
    "util_peak": "GPUPeak",
}
COUNTS = {"train_rows", "test_rows"}


def write_report(report, path, mode="errorifexists"):
    """One CSV file with a header; measures are written with three decimals."""

    def cell(name):
        if name == "model":
            return F.col(name)
        if name in COUNTS:
            return F.col(name).cast("string")
        return F.format_string("%.3f", F.col(name).cast("double"))

    lines = report.select(
        *[
            F.when(F.col(name).isNotNull(), cell(name)).alias(title)
            for name, title in CSV_HEADER.items()
        ]
    )
    lines.coalesce(1).write.mode(mode).option("header", True).csv(path)


def read_report(spark, path):
    """A written report, typed and named as in the table."""
    lines = spark.read.option("header", True).csv(path)

    def typed(name):
        kind = "string" if name == "model" else "long" if name in COUNTS else "double"
        return F.col(f"`{CSV_HEADER[name]}`").cast(kind).alias(name)

    return lines.select(*[typed(name) for name in CSV_HEADER])


# Title, column, factor and format of the printed summary.
SUMMARY = [
    ("Train Rows", "train_rows", 1, "%d"),
    ("Test Rows", "test_rows", 1, "%d"),
    ("Training Time", "train_time_ms", 1, "%.3f ms"),
    ("Total Time", "total_time_ms", 1, "%.3f ms"),
    ("Accuracy", "accuracy", 100, "%.2f%%"),
    ("Prediction Throughput", "prediction_throughput", 1, "%.2f samples/sec"),
]


def report_summary(report):
    """The report as ``(run_id, summary)`` rows of readable text; no accuracy, no line."""
    width = max(len(title) for title, *_ in SUMMARY)
    lines = [F.concat(F.lit("=== "), F.col("model"), F.lit(" ==="))]
    for title, name, factor, form in SUMMARY:
        value = F.col(name) if form == "%d" else F.col(name) * float(factor)
        text = F.format_string(f"{title:<{width}} : {form}", value)
        lines.append(F.when(F.col(name).isNotNull(), text))
    return report.select("run_id", F.concat_ws("\n", *lines).alias("summary"))
