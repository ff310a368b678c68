"""Queries over the given tables, and the SQL each of them must agree with."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.functions.parse import parse_feature, parse_label
from plumbline.functions.vectors import numeric_features, squared_distance


def _corpus():
    """Queries and SQL of the corpus operators, where that subpackage is there."""
    try:
        import corpus_pipeline
        from plumbline.llm import queries
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "plumbline.llm", "plumbline.llm.queries"):
            raise
        return {}, {}
    found = {"pipeline": corpus_pipeline.run} | queries.QUERIES
    sql = queries.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return found, sql


K = 5
WIDTH = 64
SEED_CENTERS = 4
STEPS = 3
ASSIGN_CENTERS = 10

# Limits that send even the small test tables down the large-table path.
BLOCKED = {"broadcast_bytes": 0, "block_bytes": 200_000}


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _embeddings(spark, sf_dir):
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), "label"
    )


def _one_row(spark, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


# --- sources -----------------------------------------------------------------

CSV_NUMBERS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def csv_load_labelled(spark, sf_dir):
    line = _table(spark, sf_dir, "lineitem")
    path = pl.shared_folder(spark, "lineitem-csv")
    flag = F.when(F.col("l_returnflag") == "R", "True").otherwise("False")
    malicious = F.when(F.col("l_linestatus") == "O", "True").otherwise("False")
    cells = line.select(
        *CSV_NUMBERS,
        flag.alias("returned"),
        malicious.alias("is_malicious"),
        F.col("l_linestatus").alias("attack_type"),
    )
    cells.orderBy(*cells.columns).write.option("header", True).csv(path)
    loaded = pl.load_labelled_csv(spark, path, "is_malicious")
    values = [
        F.round(F.col("features")[i].cast("double"), 2).alias(n)
        for i, n in enumerate(loaded.feature_names)
    ]
    return loaded.rows.select("row_id", *values, "label")


def csv_load_text_label(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    path = pl.shared_folder(spark, "documents-csv")
    docs.select("doc_id", "n_chars", "source").orderBy("doc_id").write.option("header", True).csv(path)
    loaded = pl.load_labelled_csv(spark, path, "source", text_label=True)
    chars = F.col("features")[1].cast("long").alias("n_chars")
    return loaded.rows.select("row_id", chars, "label")


def csv_rejects(spark, sf_dir):
    """Bad cells of a CSV copy of ``lineitem`` with their rows, and how many rows are left."""
    line = _table(spark, sf_dir, "lineitem")
    path = pl.shared_folder(spark, "lineitem-csv")
    price = F.when(F.col("l_linenumber") == 7, F.concat(F.col("l_linenumber"), F.lit(" euro")))
    tax = F.when((F.col("l_linenumber") >= 6) & (F.col("l_returnflag") == "R"), "n/a")
    label = F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 5), "?")
    cells = line.select(
        "l_orderkey",
        "l_linenumber",
        F.coalesce(price, F.col("l_extendedprice").cast("string")).alias("price"),
        F.coalesce(tax, F.col("l_tax").cast("string")).alias("tax"),
        F.coalesce(label, F.col("l_linenumber").cast("string")).alias("is_malicious"),
        *[c.isNotNull().alias(f"bad_{i}") for i, c in enumerate((price, tax, label))],
    )
    marks = [f"bad_{i}" for i in range(3)]
    cells.orderBy("l_orderkey", "l_linenumber", *marks).drop(*marks).write.option("header", True).csv(path)
    loaded = pl.load_labelled_csv(spark, path, "is_malicious", rejects=True)
    nothing = F.lit(None).cast("string")
    left = loaded.rows.select("row_id", nothing.alias("name"), nothing.alias("cell"))
    return loaded.rejects.select("row_id", F.col("column").alias("name"), "cell").unionByName(left)


def row_identity(spark, sf_dir):
    return pl.with_row_id(_table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def row_cap(spark, sf_dir):
    return pl.cap_rows(_table(spark, sf_dir, "orders").select("o_orderkey"), 1000, "o_orderkey")


def parse_features(spark, sf_dir):
    line = _table(spark, sf_dir, "lineitem")
    cells = line.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("string").alias("price"),
        F.when(F.col("l_returnflag") == "R", "True").otherwise("False").alias("returned"),
        F.when(F.col("l_linestatus") == "O", "True")
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("mark"),
    )
    return cells.select(
        "l_orderkey",
        "l_linenumber",
        F.round(parse_feature("price").cast("double"), 2).alias("price"),
        parse_feature("returned").cast("double").alias("returned"),
        parse_label("mark").alias("mark"),
    )


# --- labels, splits, profile ---------------------------------------------------


def _encoded_sources(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return pl.encode_first_seen(docs, "source", "doc_id")


def label_encode_first_seen(spark, sf_dir):
    return _encoded_sources(spark, sf_dir)[0].select("doc_id", "label")


def class_names(spark, sf_dir):
    return _encoded_sources(spark, sf_dir)[1]


def dataset_profile(spark, sf_dir):
    return pl.dataset_profile(_embeddings(spark, sf_dir))


def num_classes_distinct(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    return _one_row(spark, n_classes=pl.num_classes(part, "p_size"))


def num_classes_max(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    return _one_row(spark, n_classes=pl.num_classes_max(part, "p_size"))


def train_test_split(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").select("c_custkey")
    parts = pl.split_by_key(customers, "c_custkey")
    return parts.train.withColumn("part", F.lit("train")).unionByName(
        parts.test.withColumn("part", F.lit("test"))
    )


def split_by_text_key(spark, sf_dir):
    """A split by a key without arithmetic: the MD5 of id and text as a string."""
    digest = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.coalesce("text", F.lit("")))).alias("digest")
    docs = _table(spark, sf_dir, "documents").select("doc_id", digest)
    parts = pl.split_by_key(docs, "digest")
    return parts.train.withColumn("part", F.lit("train")).unionByName(parts.test.withColumn("part", F.lit("test")))


def pair_distance(spark, sf_dir):
    rows = _embeddings(spark, sf_dir)
    left = rows.select(F.col("row_id").alias("vec_id"), F.col("features").alias("a"))
    right = rows.select((F.col("row_id") - 1).alias("vec_id"), F.col("features").alias("b"))
    gap = F.round(squared_distance("a", "b", WIDTH), 6)
    return left.join(right, "vec_id").select("vec_id", gap.alias("distance"))


# --- nearest neighbours --------------------------------------------------------


def _knn(spark, sf_dir, **limits):
    parts = pl.split_by_key(_embeddings(spark, sf_dir))
    return pl.fit_knn(parts.train, K, **limits), parts.test


def _neighbor_rows(found):
    return found.select(
        F.col("row_id").alias("vec_id"),
        F.col("rank").cast("long").alias("rank"),
        "train_id",
        F.round("distance", 6).alias("distance"),
        "label",
    )


def knn_neighbors(spark, sf_dir):
    model, test = _knn(spark, sf_dir)
    return _neighbor_rows(model.neighbors(test))


def knn_neighbors_blocked(spark, sf_dir):
    model, test = _knn(spark, sf_dir, **BLOCKED)
    return _neighbor_rows(model.neighbors(test))


def knn_predict(spark, sf_dir):
    model, test = _knn(spark, sf_dir)
    return model.predict(test).select(F.col("row_id").alias("vec_id"), "prediction")


def knn_predict_blocked(spark, sf_dir):
    model, test = _knn(spark, sf_dir, **BLOCKED)
    return model.predict(test).select(F.col("row_id").alias("vec_id"), "prediction")


def _shared_ids(spark, sf_dir):
    """Embeddings whose ids repeat or are missing; the first coordinate tells them apart."""
    rows = _embeddings(spark, sf_dir)
    shared = F.when(F.col("row_id") % 7 > 0, F.col("row_id") % 50)
    return rows.withColumns({"vec_id": F.col("row_id"), "row_id": shared})


def _predict_shared_ids(spark, sf_dir, **limits):
    model = pl.fit_knn(_embeddings(spark, sf_dir), K, **limits)
    return model.predict(_shared_ids(spark, sf_dir)).select("vec_id", "prediction")


def knn_predict_repeated_ids(spark, sf_dir):
    return _predict_shared_ids(spark, sf_dir)


def knn_predict_repeated_ids_blocked(spark, sf_dir):
    return _predict_shared_ids(spark, sf_dir, **BLOCKED)


def knn_predict_one(spark, sf_dir):
    parts = pl.split_by_key(_embeddings(spark, sf_dir))
    return pl.fit_knn(parts.train, 1).predict(parts.test).select(F.col("row_id").alias("vec_id"), "prediction")


def knn_accuracy(spark, sf_dir):
    model, test = _knn(spark, sf_dir)
    predicted = model.predict(test).select("row_id", "prediction")
    paired = pl.pair_with_truth(predicted, test.select("row_id", "label"))
    return pl.accuracy(paired).withColumn("accuracy", F.round("accuracy", 6))


def knn_train_set(spark, sf_dir):
    rows = _embeddings(spark, sf_dir)
    predicted = pl.fit_knn(rows, K).predict(rows)
    return predicted.select(F.col("row_id").alias("vec_id"), "prediction")


# --- k-means ---------------------------------------------------------------------


def _first_rows(rows, n):
    """Starting centres: the first rows of the table."""
    found = rows.filter(F.col("row_id") < n).orderBy("row_id").select("features").collect()
    return np.array([r["features"] for r in found], dtype=np.float64)


def _given_centers(spark, sf_dir):
    rows = _embeddings(spark, sf_dir)
    return pl.lloyd(rows, _first_rows(rows, ASSIGN_CENTERS), 0), rows


def _lloyd(spark, sf_dir):
    rows = _embeddings(spark, sf_dir)
    return pl.lloyd(rows, _first_rows(rows, SEED_CENTERS), STEPS, 0.0), rows


def kmeans_assign(spark, sf_dir):
    model, rows = _given_centers(spark, sf_dir)
    return model.assign(rows).select(
        F.col("row_id").alias("vec_id"), "prediction", F.round("distance", 6).alias("distance")
    )


def kmeans_inertia(spark, sf_dir):
    model, _ = _given_centers(spark, sf_dir)
    return _one_row(spark, inertia=round(model.inertia, 4))


def kmeans_lloyd(spark, sf_dir):
    model, rows = _lloyd(spark, sf_dir)
    return model.predict(rows).select(F.col("row_id").alias("vec_id"), "prediction")


def kmeans_centers(spark, sf_dir):
    model, _ = _lloyd(spark, sf_dir)
    return model.center_rows(spark).select(
        "cluster_id", F.posexplode("center").alias("axis", "value")
    ).select("cluster_id", "axis", F.round("value", 6).alias("value"))


def cluster_sizes(spark, sf_dir):
    model, rows = _lloyd(spark, sf_dir)
    return pl.cluster_sizes(model.predict(rows))


def kmeans_fit_predict(spark, sf_dir):
    """Facts of a seeded fit that hold whatever centres it finds."""
    rows = _embeddings(spark, sf_dir)
    model = pl.fit_kmeans(rows, pl.num_classes(rows))
    centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.centers])
    gaps = F.transform(
        centers,
        lambda c: F.aggregate(
            F.zip_with("features", c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda n, g: n + g
        ),
    )
    found = model.assign(rows).withColumn("gap", F.array_min(gaps))
    mean = np.array(pl.lloyd(rows, np.zeros((1, WIDTH)), 1, 0.0).centers)
    total = pl.lloyd(rows, mean, 0).inertia
    return found.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("prediction").alias("n_clusters"),
        F.bool_and(F.abs(F.col("distance") - F.col("gap")) < 1e-6).alias("all_at_nearest"),
        (F.abs(F.sum("distance") - model.inertia) < 1e-3 * total).alias("inertia_is_sum"),
        (F.sum("distance") < total).alias("inertia_below_total"),
    )


def _line_flags(spark, sf_dir):
    return _flags(_table(spark, sf_dir, "lineitem"))


def _flags(line):
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    flags = line.select(
        key.alias("row_id"),
        "l_orderkey",
        "l_linenumber",
        *[(F.col("l_returnflag") == f).cast("int").alias(f"is_{f.lower()}") for f in "ANR"],
        F.when(F.col("l_returnflag") == "A", 0)
        .when(F.col("l_returnflag") == "N", 2)
        .otherwise(5)
        .alias("label"),
    )
    return flags.withColumn("features", numeric_features(["is_a", "is_n", "is_r"]))


def kmeans_separable_sizes(spark, sf_dir):
    rows = _line_flags(spark, sf_dir)
    predicted = pl.fit_kmeans(rows, 3).predict(rows)
    return predicted.groupBy("label", "prediction").agg(F.count("*").alias("n_rows")).select(
        "label", "n_rows"
    )


# --- random forest -----------------------------------------------------------------


def _document_features(spark, sf_dir):
    """Text shape of the rated documents; the text itself is never shuffled."""
    text, chars = F.col("text"), F.col("n_chars")
    words = F.array_remove(F.split(text, r"\s+"), "")
    shape = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        chars.alias("chars"),
        F.size(words).alias("words"),
        (F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))).alias("variety"),
        (chars / F.greatest(F.size(words), F.lit(1))).alias("word_length"),
        (F.regexp_count(text, F.lit("[0-9]")) / (chars + 1)).alias("digits"),
        (F.regexp_count(text, F.lit("[A-Z]")) / (chars + 1)).alias("capitals"),
    )
    columns = ["chars", "words", "variety", "word_length", "digits", "capitals"]
    rated = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_id"), F.col("quality").alias("label")
    )
    features = shape.select("row_id", numeric_features(columns).alias("features"))
    return pl.written_table(features.join(rated, "row_id"), "document-features")


def _forest(spark, sf_dir):
    parts = pl.split_by_key(_document_features(spark, sf_dir))
    return pl.fit_random_forest(parts.train, max_depth=10), parts.test


def rf_fit_predict(spark, sf_dir):
    """For each label the rows tested on, all rows, and whether most of all are predicted right.

    No predictor that names one class, or draws lots, passes for both labels.
    """
    parts = pl.split_by_key(_document_features(spark, sf_dir))
    model = pl.fit_random_forest(parts.train, max_depth=10)
    tested = [part.withColumn("tested", F.lit(t)) for part, t in ((parts.train, False), (parts.test, True))]
    right = (F.col("prediction") == F.col("label")).cast("double")
    return model.predict(tested[0].unionByName(tested[1])).groupBy("label").agg(
        F.count_if("tested").alias("n_tested"), F.count("*").alias("n_rows"), (F.avg(right) > 0.75).alias("mostly_right")
    )


def rf_accuracy(spark, sf_dir):
    """Whether the forest is at least as right as naming the most frequent label."""
    model, test = _forest(spark, sf_dir)
    found = pl.accuracy(model.predict(test))
    most = test.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"))
    return found.crossJoin(most).select("n_rows", (F.col("n_correct") >= F.col("most")).alias("majority_or_better"))


def rf_train_set(spark, sf_dir):
    rows = _document_features(spark, sf_dir)
    found = pl.accuracy(pl.fit_random_forest(rows).predict(rows))
    return found.select("n_rows", (F.col("accuracy") > 0.9).alias("above_0_9"))


def rf_separable(spark, sf_dir):
    rows = _line_flags(spark, sf_dir)
    model = pl.fit_random_forest(rows, max_depth=10)
    return model.predict(rows).select("l_orderkey", "l_linenumber", "prediction")


def rf_max_leaves(spark, sf_dir):
    """Three flags need three leaves, and three are allowed."""
    rows = _line_flags(spark, sf_dir)
    model = pl.fit_random_forest(rows, 20, max_leaves=3, max_features=1.0)
    most = max(int((tree[0] < 0).sum()) for tree in model.trees.trees)
    found = model.predict(rows).select("l_orderkey", "l_linenumber", "prediction")
    return found.withColumn("most_leaves", F.lit(most))


def rf_two_leaves(spark, sf_dir):
    """With two leaves one flag is parted off, so two classes are named at most."""
    rows = _line_flags(spark, sf_dir)
    predicted = pl.fit_random_forest(rows, 1, max_leaves=2, max_features=1.0).predict(rows)
    found = predicted.groupBy("label").agg(F.count_distinct("prediction").alias("n_predictions"), F.min("prediction").alias("named"))
    return found.agg(
        F.count("*").alias("n_labels"),
        F.max("n_predictions").alias("most_predictions"),
        F.count_distinct("named").alias("n_named"),
        F.sum((F.col("named") == F.col("label")).cast("int")).alias("n_right"),
    )


# --- utilisation, streams ------------------------------------------------------------


def _samples(events):
    return events.select(F.col("user_id").alias("run_id"), "ts", F.col("value").alias("util"))


def utilization_summary(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    runs = events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("started_at"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("stopped_at"),
    )
    return pl.utilization_summary(runs, _samples(events)).select(
        "run_id",
        F.round("util_avg", 6).alias("util_avg"),
        F.round("util_peak", 6).alias("util_peak"),
        "n_samples",
    )


def _stream(spark, sf_dir, name):
    """The table, one file or a folder of files, as a stream that ends when it is read."""
    schema = _table(spark, sf_dir, name).schema
    # A stream of a plain path must be a folder's; a pattern finds either.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _utilization(spark, sf_dir, mode):
    stream = _stream(spark, sf_dir, "events")
    # Clock readings without a zone are taken as UTC, whatever the session's zone.
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    samples = _samples(stream).withColumn("ts", instant.cast("timestamp"))
    path = pl.shared_folder(spark, "utilization")
    found = pl.utilization_stream(samples, "1 day")

    def keep(batch, batch_id):
        target = path if mode == "complete" else f"{path}/batch={batch_id}"
        batch.drop("window_end").write.mode("overwrite").parquet(target)

    query = (
        found.writeStream.outputMode(mode)
        .foreachBatch(keep)
        .option("checkpointLocation", pl.shared_folder(spark, "utilization-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    day = F.date_format(
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window_start").cast("timestamp_ntz")),
        "yyyy-MM-dd",
    )
    return spark.read.parquet(path).select(
        "run_id",
        day.alias("day"),
        F.round("util_avg", 6).alias("util_avg"),
        F.round("util_peak", 6).alias("util_peak"),
        "n_samples",
    )


def utilization_stream(spark, sf_dir):
    return _utilization(spark, sf_dir, "complete")


def utilization_stream_closed(spark, sf_dir):
    return _utilization(spark, sf_dir, "append")


def utilization_stream_runs(spark, sf_dir):
    """The summary of each run from a stream of its start, stop and readings, in any order."""
    events = _table(spark, sf_dir, "events")
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    events = events.withColumn("ts", utc)
    ends = events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("start"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("stop"),
    )
    ends = ends.filter("start <= stop")
    rows = [_samples(events).withColumn("kind", F.lit("reading"))]
    for kind in ("start", "stop"):
        rows.append(ends.select("run_id", F.col(kind).alias("ts"), F.lit(None).cast("double").alias("util"), F.lit(kind).alias("kind")))
    # A stop of no run moves the clock past all others.
    clock = events.agg(F.expr("max(ts) + INTERVAL 1 DAY").alias("ts"))
    rows.append(clock.select(F.lit(-1).cast("long").alias("run_id"), "ts", F.lit(None).cast("double").alias("util"), F.lit("stop").alias("kind")))
    folder = pl.shared_folder(spark, "run-rows")
    table = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    table.repartition(4).write.parquet(folder)
    stream = spark.readStream.schema(table.schema).parquet(folder)
    path = pl.shared_folder(spark, "runs")
    found = pl.utilization_runs(stream, salts=2)
    query = (
        found.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", pl.shared_folder(spark, "runs-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Parts are added in any order, so the mean is rounded where no mean of two decimals ties.
    return pl.merge_run_parts(spark.read.schema(found.schema).parquet(path)).select(
        "run_id", F.round("util_avg", 9).alias("util_avg"), F.round("util_peak", 6).alias("util_peak"), "n_samples"
    )


def _scored(spark, sf_dir, model):
    stream = _stream(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("features")
    )
    path = pl.shared_folder(spark, "scored")
    pl.score_stream(model, stream, path, pl.shared_folder(spark, "scored-state")).awaitTermination()
    return spark.read.parquet(path).select(F.col("row_id").alias("vec_id"), "prediction")


def kmeans_score_stream(spark, sf_dir):
    return _scored(spark, sf_dir, _lloyd(spark, sf_dir)[0])


def knn_score_stream(spark, sf_dir):
    return _scored(spark, sf_dir, pl.fit_knn(_embeddings(spark, sf_dir), K))


def knn_score_stream_blocked(spark, sf_dir):
    return _scored(spark, sf_dir, pl.fit_knn(_embeddings(spark, sf_dir), K, **BLOCKED))


def rf_score_stream(spark, sf_dir):
    model = pl.fit_random_forest(_line_flags(spark, sf_dir), max_depth=10)
    stream = _flags(_stream(spark, sf_dir, "lineitem"))
    path = pl.shared_folder(spark, "scored")
    pl.score_stream(model, stream, path, pl.shared_folder(spark, "scored-state")).awaitTermination()
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "prediction")


def csv_row_cap(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    path = pl.shared_folder(spark, "documents-csv")
    docs.select("doc_id", "n_chars", "source").orderBy("doc_id").write.option("header", True).csv(path)
    loaded = pl.load_labelled_csv(spark, path, "source", max_rows=50, text_label=True)
    chars = F.col("features")[1].cast("long").alias("n_chars")
    return loaded.rows.select("row_id", chars, "label")


# --- jobs and report -------------------------------------------------------------------

BUDGETS = (100, -1)


def benchmark_report(spark, sf_dir):
    report = pl.sweep(_document_features(spark, sf_dir), BUDGETS)
    # Times are read from one clock, start and stop of the runs from another.
    span_ms = (F.unix_micros("stopped_at") - F.unix_micros("started_at")) / 1000
    predict_ms = F.col("test_rows") / F.col("prediction_throughput") * 1000
    gap = F.abs(F.col("train_time_ms") + predict_ms - span_ms)
    times = (gap <= 20 + span_ms / 50) & (F.abs(F.col("total_time_ms") - span_ms) <= 20 + span_ms / 50)
    times = times & (F.col("train_time_ms") > 0) & (predict_ms > 0)
    return report.select(
        "run_id",
        "model",
        "train_rows",
        "test_rows",
        F.coalesce(F.col("accuracy") > 0.5, F.lit(False)).alias("mostly_right"),
        times.alias("times_agree"),
    )


def report_csv(spark, sf_dir):
    report = pl.sweep(_document_features(spark, sf_dir), jobs=(pl.knn_job, pl.kmeans_job))
    path = pl.shared_folder(spark, "report")
    pl.write_report(report, path)
    return pl.read_report(spark, path).select("model", "train_rows", "test_rows")


def entry(spark: SparkSession) -> DataFrame:
    """Accuracy of five nearest neighbours on the smallest tables."""
    return knn_accuracy(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        csv_load_labelled,
        csv_load_text_label,
        csv_row_cap,
        csv_rejects,
        row_identity,
        row_cap,
        parse_features,
        label_encode_first_seen,
        class_names,
        dataset_profile,
        num_classes_distinct,
        num_classes_max,
        train_test_split,
        split_by_text_key,
        pair_distance,
        knn_neighbors,
        knn_neighbors_blocked,
        knn_predict,
        knn_predict_blocked,
        knn_predict_repeated_ids,
        knn_predict_repeated_ids_blocked,
        knn_predict_one,
        knn_accuracy,
        knn_train_set,
        kmeans_assign,
        kmeans_inertia,
        kmeans_lloyd,
        kmeans_centers,
        cluster_sizes,
        kmeans_fit_predict,
        kmeans_separable_sizes,
        rf_fit_predict,
        rf_accuracy,
        rf_train_set,
        rf_separable,
        rf_max_leaves,
        rf_two_leaves,
        utilization_summary,
        utilization_stream,
        utilization_stream_closed,
        utilization_stream_runs,
        kmeans_score_stream,
        knn_score_stream,
        knn_score_stream_blocked,
        rf_score_stream,
        benchmark_report,
        report_csv,
    ]
    return {f.__name__: f for f in found} | _corpus()[0]


# --- SQL -------------------------------------------------------------------------------


def _gap(a, b):
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"


POINTS = "p AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings)"
PARTS = (
    f"{POINTS}, n AS (SELECT count(*) * 4 // 5 AS cut FROM p), "
    "o AS (SELECT p.*, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM p), "
    "train AS (SELECT o.* FROM o, n WHERE pos < cut), "
    "test AS (SELECT o.* FROM o, n WHERE pos >= cut)"
)


def _hits(queries, train):
    return (
        "hits AS (SELECT * FROM (SELECT q.vec_id, t.vec_id AS train_id, t.label, "
        f"{_gap('q.e', 't.e')} AS distance, "
        "row_number() OVER (PARTITION BY q.vec_id ORDER BY "
        f"{_gap('q.e', 't.e')}, t.vec_id) AS rank FROM {queries} q, {train} t) WHERE rank <= {K})"
    )


VOTES = (
    "votes AS (SELECT vec_id, label AS prediction FROM (SELECT vec_id, label, row_number() OVER "
    "(PARTITION BY vec_id ORDER BY count(*) DESC, label) AS r FROM hits GROUP BY vec_id, label) "
    "WHERE r = 1)"
)


def _nearest_center(step, centers):
    return (
        f"a{step} AS (SELECT vec_id, e, cid, d FROM (SELECT p.vec_id, p.e, c.cid, "
        f"{_gap('p.e', 'c.c')} AS d, row_number() OVER (PARTITION BY p.vec_id ORDER BY "
        f"{_gap('p.e', 'c.c')}, c.cid) AS r FROM p, {centers} c) WHERE r = 1)"
    )


def _lloyd_sql(steps=STEPS):
    parts = [POINTS, f"c0 AS (SELECT vec_id::INTEGER AS cid, e AS c FROM p WHERE vec_id < {SEED_CENTERS})"]
    for s in range(steps):
        parts.append(_nearest_center(s, f"c{s}"))
        parts.append(
            f"c{s + 1} AS (SELECT cid, list(m ORDER BY i) AS c FROM (SELECT cid, i, avg(e[i]) AS m "
            f"FROM a{s}, range(1, {WIDTH + 1}) t(i) GROUP BY cid, i) GROUP BY cid)"
        )
    parts.append(_nearest_center(steps, f"c{steps}"))
    return "WITH " + ", ".join(parts)


GIVEN = f"c0 AS (SELECT vec_id::INTEGER AS cid, e AS c FROM p WHERE vec_id < {ASSIGN_CENTERS})"

RATED = "SELECT doc_id FROM documents JOIN labels USING (doc_id)"


def _report_sql(budgets, models, numbered):
    lines = []
    for b, budget in enumerate(budgets):
        for m, model in enumerate(models):
            rows = f"least({budget}, count(*))" if budget > 0 else "count(*)"
            run = f"{b * len(models) + m}::INTEGER AS run_id, " if numbered else ""
            right = "FALSE" if model == "KMeans" else "TRUE"
            facts = f", {right} AS mostly_right, TRUE AS times_agree" if numbered else ""
            lines.append(
                f"SELECT {run}'{model}' AS model, {rows} * 4 // 5 AS train_rows, "
                f"{rows} - {rows} * 4 // 5 AS test_rows{facts} FROM ({RATED})"
            )
    return " UNION ALL ".join(lines)


def oracle_sql() -> dict[str, str]:
    predict = f"WITH {PARTS}, {_hits('test', 'train')}, {VOTES} "
    neighbors = (
        f"WITH {PARTS}, {_hits('test', 'train')} "
        "SELECT vec_id, rank, train_id, round(distance, 6) AS distance, label FROM hits"
    )
    self_votes = f"WITH {POINTS}, {_hits('p', 'p')}, {VOTES} SELECT vec_id, prediction FROM votes"
    lloyd_rows = f"{_lloyd_sql()} SELECT vec_id, cid AS prediction FROM a{STEPS}"
    source_ids = (
        "WITH f AS (SELECT source, min(doc_id) AS first FROM documents GROUP BY source), "
        "c AS (SELECT source, (row_number() OVER (ORDER BY first) - 1)::INTEGER AS id FROM f) "
    )
    windows = (
        "SELECT user_id AS run_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, "
        "round(avg(value), 6) AS util_avg, round(greatest(max(value), 0), 6) AS util_peak, "
        "count(value) AS n_samples FROM events GROUP BY user_id, date_trunc('day', ts)"
    )
    flag_code = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 ELSE 5 END"
    return _corpus()[1] | {
        "csv_load_labelled": """
            SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity,
                l_extendedprice, l_discount, l_tax, l_returnflag = 'R', l_linestatus) - 1 AS row_id,
              l_orderkey::DOUBLE AS l_orderkey, l_linenumber::DOUBLE AS l_linenumber,
              round(l_quantity::FLOAT::DOUBLE, 2) AS l_quantity,
              round(l_extendedprice::FLOAT::DOUBLE, 2) AS l_extendedprice,
              round(l_discount::FLOAT::DOUBLE, 2) AS l_discount,
              round(l_tax::FLOAT::DOUBLE, 2) AS l_tax,
              (l_returnflag = 'R')::INTEGER::DOUBLE AS returned,
              (l_linestatus = 'O')::INTEGER AS label
            FROM lineitem""",
        "csv_load_text_label": source_ids
        + """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id,
               n_chars::FLOAT::BIGINT AS n_chars, id AS label
             FROM documents JOIN c USING (source)""",
        "row_identity": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders",
        "row_cap": "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1000",
        "parse_features": """
            SELECT l_orderkey, l_linenumber,
              round(l_extendedprice::VARCHAR::FLOAT::DOUBLE, 2) AS price,
              (l_returnflag = 'R')::INTEGER::DOUBLE AS returned,
              CASE WHEN l_linestatus = 'O' THEN 1 ELSE l_linenumber END::INTEGER AS mark
            FROM lineitem""",
        "label_encode_first_seen": source_ids
        + "SELECT doc_id, id AS label FROM documents JOIN c USING (source)",
        "class_names": source_ids + "SELECT id AS class_id, source AS class_name FROM c",
        "dataset_profile": """
            SELECT count(*) AS n_rows, max(len(embedding))::INTEGER AS n_features,
              count(DISTINCT label) AS n_classes FROM embeddings""",
        "num_classes_distinct": "SELECT count(DISTINCT p_size)::INTEGER AS n_classes FROM part",
        "num_classes_max": "SELECT (max(p_size) + 1)::INTEGER AS n_classes FROM part",
        "train_test_split": """
            SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY c_custkey)
              <= count(*) OVER () * 4 // 5 THEN 'train' ELSE 'test' END AS part FROM customer""",
        "pair_distance": f"""
            WITH {POINTS} SELECT a.vec_id, round({_gap('a.e', 'b.e')}, 6) AS distance
            FROM p a JOIN p b ON b.vec_id = a.vec_id + 1""",
        "knn_neighbors": neighbors,
        "knn_neighbors_blocked": neighbors,
        "knn_predict": predict + "SELECT vec_id, prediction FROM votes",
        "knn_predict_blocked": predict + "SELECT vec_id, prediction FROM votes",
        "knn_accuracy": predict
        + """SELECT count(*) AS n_rows, sum((prediction = label)::INTEGER)::BIGINT AS n_correct,
               round(avg((prediction = label)::INTEGER), 6) AS accuracy
             FROM votes JOIN test USING (vec_id)""",
        "knn_train_set": self_votes,
        "kmeans_assign": f"""
            WITH {POINTS}, {GIVEN}, {_nearest_center(0, 'c0')}
            SELECT vec_id, cid AS prediction, round(d, 6) AS distance FROM a0""",
        "kmeans_inertia": f"""
            WITH {POINTS}, {GIVEN}, {_nearest_center(0, 'c0')}
            SELECT round(sum(d), 4) AS inertia FROM a0""",
        "kmeans_lloyd": lloyd_rows,
        "kmeans_centers": f"""
            {_lloyd_sql()} SELECT cid AS cluster_id, (i - 1)::INTEGER AS axis,
              round(c[i], 6) AS value FROM c{STEPS}, range(1, {WIDTH + 1}) t(i)""",
        "cluster_sizes": f"{_lloyd_sql()} SELECT cid AS prediction, count(*) AS n_rows FROM a{STEPS} GROUP BY cid",
        "kmeans_separable_sizes": f"SELECT {flag_code} AS label, count(*) AS n_rows FROM lineitem GROUP BY 1",
        "rf_separable": f"SELECT l_orderkey, l_linenumber, {flag_code} AS prediction FROM lineitem",
        "utilization_summary": """
            WITH r AS (SELECT user_id AS run_id, min(ts) FILTER (event_type = 'signup') AS s,
                max(ts) FILTER (event_type = 'purchase') AS e FROM events GROUP BY user_id)
            SELECT run_id, round(coalesce(avg(value), 0), 6) AS util_avg,
              round(greatest(coalesce(max(value), 0), 0), 6) AS util_peak, count(value) AS n_samples
            FROM r LEFT JOIN events ON user_id = run_id AND ts BETWEEN s AND e GROUP BY run_id""",
        "utilization_stream": windows,
        "utilization_stream_closed": windows
        + " HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE",
        "kmeans_score_stream": lloyd_rows,
        "knn_score_stream": self_votes,
        "knn_score_stream_blocked": self_votes,
        "knn_predict_repeated_ids": self_votes,
        "knn_predict_repeated_ids_blocked": self_votes,
        "knn_predict_one": f"""
            WITH {PARTS} SELECT vec_id, label AS prediction FROM (SELECT q.vec_id, t.label, row_number() OVER
              (PARTITION BY q.vec_id ORDER BY {_gap('q.e', 't.e')}, t.vec_id) AS r FROM test q, train t) WHERE r = 1""",
        "rf_score_stream": f"SELECT l_orderkey, l_linenumber, {flag_code} AS prediction FROM lineitem",
        "rf_fit_predict": """
            WITH o AS (SELECT quality AS label, row_number() OVER (ORDER BY doc_id) AS pos,
              count(*) OVER () * 4 // 5 AS cut FROM documents JOIN labels USING (doc_id))
            SELECT label, count(*) FILTER (pos > cut) AS n_tested, count(*) AS n_rows, true AS mostly_right
            FROM o GROUP BY label""",
        "rf_max_leaves": f"SELECT l_orderkey, l_linenumber, {flag_code} AS prediction, 3 AS most_leaves FROM lineitem",
        "rf_two_leaves": """
            SELECT count(DISTINCT l_returnflag) AS n_labels, 1::BIGINT AS most_predictions, 2::BIGINT AS n_named,
              2::BIGINT AS n_right FROM lineitem""",
        "utilization_stream_runs": """
            WITH r AS (SELECT user_id AS run_id, min(ts) FILTER (event_type = 'signup') AS s,
                max(ts) FILTER (event_type = 'purchase') AS e FROM events GROUP BY user_id)
            SELECT run_id, round(coalesce(avg(value), 0), 9) AS util_avg,
              round(greatest(coalesce(max(value), 0), 0), 6) AS util_peak, count(value) AS n_samples
            FROM r LEFT JOIN events ON user_id = run_id AND ts BETWEEN s AND e WHERE s <= e GROUP BY run_id""",
        "split_by_text_key": """
            SELECT doc_id, digest, CASE WHEN row_number() OVER (ORDER BY digest) <= count(*) OVER () * 4 // 5
              THEN 'train' ELSE 'test' END AS part
            FROM (SELECT doc_id, md5(doc_id::VARCHAR || ':' || coalesce(text, '')) AS digest FROM documents)""",
        "csv_rejects": """
            WITH c AS (SELECT *, l_linenumber = 7 AS bad_price, l_linenumber >= 6 AND l_returnflag = 'R' AS bad_tax,
                l_linenumber = 5 AND l_linestatus = 'F' AS bad_label FROM lineitem),
            o AS (SELECT *, row_number() OVER
              (ORDER BY l_orderkey, l_linenumber, bad_price, bad_tax, bad_label) - 1 AS row_id FROM c)
            SELECT row_id, 'price' AS name, '7 euro' AS cell FROM o WHERE bad_price
            UNION ALL SELECT row_id, 'tax', 'n/a' FROM o WHERE bad_tax
            UNION ALL SELECT row_id, 'is_malicious', '?' FROM o WHERE bad_label
            UNION ALL SELECT row_id, NULL, NULL FROM o WHERE NOT (bad_price OR bad_tax OR bad_label)""",
        "rf_accuracy": f"""
            SELECT count(*) - count(*) * 4 // 5 AS n_rows, true AS majority_or_better FROM ({RATED})""",
        "rf_train_set": f"SELECT count(*) AS n_rows, true AS above_0_9 FROM ({RATED})",
        "kmeans_fit_predict": """
            SELECT count(*) AS n_rows, count(DISTINCT label) AS n_clusters, true AS all_at_nearest,
              true AS inertia_is_sum, true AS inertia_below_total FROM embeddings""",
        "csv_row_cap": """
            WITH o AS (SELECT doc_id, n_chars, source, row_number() OVER (ORDER BY doc_id) - 1 AS row_id
              FROM documents ORDER BY doc_id LIMIT 50),
            f AS (SELECT source, min(row_id) AS first FROM o GROUP BY source),
            c AS (SELECT source, (row_number() OVER (ORDER BY first) - 1)::INTEGER AS id FROM f)
            SELECT row_id, n_chars::FLOAT::BIGINT AS n_chars, id AS label FROM o JOIN c USING (source)""",
        "benchmark_report": _report_sql(BUDGETS, ["Random Forest", "KNN", "KMeans"], True),
        "report_csv": _report_sql([-1], ["KNN", "KMeans"], False),
    }
