import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import plumbline as pl

START = datetime(2024, 1, 1)


@pytest.fixture
def drain(tmp_path):
    """Runs a stream to its end and gives the rows of every batch."""

    def run(found, mode):
        batches = []
        query = (
            found.writeStream.outputMode(mode)
            .foreachBatch(lambda batch, _: batches.append(batch.collect()))
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return batches

    return run


def samples(spark, tmp_path, rows):
    """One file per list of samples, read in that order one file at a time."""
    schema = "run_id int, ts timestamp, util double"
    for i, part in enumerate(rows):
        table = [(1, START + timedelta(minutes=m), v) for m, v in part]
        spark.createDataFrame(table, schema).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in")
        )
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(str(tmp_path / "in"))


def test_windows_close_after_the_watermark(spark, tmp_path, drain):
    parts = [[(1, 5.0), (2, 7.0)], [(30, 1.0)], [(31, 1.0)], [(3, 99.0), (32, 2.0)]]
    stream = samples(spark, tmp_path, parts)
    rows = [r for batch in drain(pl.utilization_stream(stream, "10 minutes"), "append") for r in batch]
    # The late reading of 99 comes after its window has closed.
    assert [(r.window_start, r.util_avg, r.util_peak, r.n_samples) for r in rows] == [
        (START, 6.0, 7.0, 2)
    ]


def test_complete_mode_equals_batch(spark, tmp_path, drain):
    stream = samples(spark, tmp_path, [[(1, -5.0), (2, -7.0)], [(30, 1.0)]])
    rows = drain(pl.utilization_stream(stream, "10 minutes"), "complete")[-1]
    found = {r.window_start: (r.util_avg, r.util_peak) for r in rows}
    assert found == {START: (-6.0, 0.0), START + timedelta(minutes=30): (1.0, 1.0)}


@pytest.mark.parametrize("kind", ["forest", "k-means", "k-NN", "k-NN in blocks"])
def test_scored_streams_equal_batches(spark, tmp_path, kind):
    rows = spark.range(80).select(
        F.col("id").alias("row_id"),
        F.array((F.col("id") % 4).cast("float"), (F.col("id") % 3).cast("float")).alias("features"),
        (F.col("id") % 4).cast("int").alias("label"),
    )
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    model = {
        "forest": lambda: pl.fit_random_forest(rows, 5),
        "k-means": lambda: pl.lloyd(rows, [[0.0, 0.0], [3.0, 2.0]], 2),
        "k-NN": lambda: pl.fit_knn(rows, 3),
        "k-NN in blocks": lambda: pl.fit_knn(rows, 3, broadcast_bytes=0, block_bytes=2000),
    }[kind]()
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2)
    query = pl.score_stream(
        model, reader.parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")
    )
    query.awaitTermination()
    scored = spark.read.parquet(str(tmp_path / "out"))
    assert scored.select("batch").distinct().count() == 2
    expected = model.predict(rows).select("row_id", "prediction")
    assert sorted(scored.select("row_id", "prediction").collect()) == sorted(expected.collect())


def test_narrow_models_score_a_stream_directly(spark, tmp_path, drain):
    rows = spark.range(20).select(
        F.col("id").alias("row_id"), F.array(F.col("id").cast("float")).alias("features")
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    model = pl.lloyd(rows, [[0.0], [19.0]], 1)
    batches = drain(model.predict(stream), "append")
    assert sum(len(b) for b in batches) == 20


def plain_runs(rows):
    """(run, start, stop, average, peak, readings) of all ended runs, in order of time."""
    order = {"start": 0, "reading": 1, "stop": 2}
    out = []
    for run in {r[0] for r in rows if r[0] is not None}:
        own = sorted(((m, order[k], v) for r, m, k, v in rows if r == run), key=lambda r: r[:2])
        start, held = None, []
        for minute, kind, value in own:
            if kind == 0:
                start, held = minute, []
            elif kind == 1 and start is not None and value is not None:
                held.append(value)
            elif kind == 2 and start is not None:
                mean = sum(held) / len(held) if held else 0.0
                out.append((run, start, minute, round(mean, 9), max(held + [0.0]), len(held)))
                start = None
    return sorted(out)


def runs_stream(spark, tmp_path, parts):
    schema = "run_id int, ts timestamp, kind string, util double"
    for part in parts:
        table = [(r, START + timedelta(minutes=m), k, v) for r, m, k, v in part]
        spark.createDataFrame(table, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def found_runs(spark, batches):
    rows = [r for batch in batches for r in batch]
    schema = "run_id int, part int, started_at timestamp, stopped_at timestamp, total double, peak double, n_samples long"
    merged = pl.merge_run_parts(spark.createDataFrame(rows, schema)).collect()
    minute = lambda t: int((t - START).total_seconds() // 60)
    return sorted(
        (r.run_id, minute(r.started_at), minute(r.stopped_at), round(r.util_avg, 9), r.util_peak, r.n_samples) for r in merged
    )


@pytest.mark.parametrize("salts", [1, 3])
def test_runs_of_rows_in_any_order(spark, tmp_path, drain, salts):
    rng = random.Random(4)
    rows = []
    for run in range(6):
        at = rng.randint(0, 20)
        for _ in range(rng.randint(1, 3)):
            rows.append((run, at, "start", None))
            end = at + rng.randint(0, 30)
            rows += [(run, rng.randint(at - 5, end + 5), "reading", rng.choice([None, -4.0, rng.random() * 90])) for _ in range(25)]
            rows.append((run, end, rng.choice(["stop", "stop", "start"]), None))
            at = end + rng.randint(8, 20)
    rows = [r for r in rows if not (r[2] == "reading" and r[3] is None)] + [(0, 0, "stop", None)]
    rng.shuffle(rows)
    # All rows of an hour come in three files; the last row moves the clock.
    parts = [rows[0::3], rows[1::3], rows[2::3], [(99, 10_000, "stop", None)]]
    stream = runs_stream(spark, tmp_path, parts)
    batches = drain(pl.utilization_runs(stream, late="300 minutes", salts=salts), "append")
    assert found_runs(spark, batches) == plain_runs(rows)


def test_run_rows_behind_the_watermark_are_dropped(spark, tmp_path, drain):
    parts = [
        [(1, 0, "start", None), (1, 1, "reading", 10.0), (1, 30, "reading", 20.0)],
        [(1, 2, "reading", 99.0), (1, 40, "reading", 30.0), (None, 41, "reading", 5.0), (2, 35, "stop", None)],
        [(1, 45, "stop", None), (1, 46, "reading", 77.0), (2, 500, "reading", 1.0)],
        [(2, 900, "reading", 1.0)],
    ]
    batches = drain(pl.utilization_runs(runs_stream(spark, tmp_path, parts), late="10 minutes"), "append")
    assert found_runs(spark, batches) == [(1, 0, 45, 20.0, 30.0, 3)]


def test_scoring_leaves_no_folders(spark, tmp_path):
    """Ten batches of a search in blocks: what each stored is gone, the model's table stays."""
    table = spark.createDataFrame([(i, [float(i * 37 % 101), float(i % 7)], i % 3) for i in range(200)], "row_id long, features array<float>, label int")
    model = pl.fit_knn(table, 3, broadcast_bytes=0, block_bytes=2000)
    expected = {r.row_id: r.prediction for r in model.predict(table).collect()}
    kept = len(model.points.tables)
    root = Path(model.points.folders[0]).parent

    def stored():
        return sum(any(w in p.name for w in ("queries-", "home-hits-", "visits-", "points-")) for p in root.iterdir())

    before = stored()
    for i in range(10):
        table.filter(F.col("row_id") % 10 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    pl.score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = {r.row_id: r.prediction for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == expected and stored() == before and len(model.points.tables) == kept
    model.unpersist()


@pytest.mark.parametrize("files", [1, 3])
@pytest.mark.parametrize("query", ["kmeans_score_stream", "knn_score_stream", "knn_score_stream_blocked"])
def test_tables_of_one_file_and_of_several_are_scored(spark, tmp_path, query, files):
    rows = [(i, [float((i * 37 + j) % 11) for j in range(64)], i % 3) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table.repartition(files).write.parquet(str(tmp_path / "embeddings.parquet"))
    folder = tmp_path
    if files == 1:
        folder = tmp_path / "plain"
        folder.mkdir()
        next((tmp_path / "embeddings.parquet").glob("part-*")).rename(folder / "embeddings.parquet")
    found = entry_points.queries()[query](spark, str(folder)).collect()
    assert sorted(r.vec_id for r in found) == list(range(60)) and all(r.prediction is not None for r in found)


def test_runs_share_the_state_of_their_group(spark, tmp_path):
    """Many runs take no more states than there are groups, each run with its own readings."""
    schema = "run_id string, ts timestamp, kind string, util double"
    rows = [(f"r{r}", m, k, v) for r in range(40) for m, k, v in ((r, "start", None), (r + 1, "reading", 2.0 * r), (r + 3, "stop", None))]
    rows.append(("clock", 10_000, "stop", None))
    table = [(r, START + timedelta(minutes=m), k, v) for r, m, k, v in rows]
    spark.createDataFrame(table, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    batches = []
    query = (
        pl.utilization_runs(stream, groups=3)
        .writeStream.foreachBatch(lambda batch, _: batches.extend(batch.collect()))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(held) <= 3
    assert sorted((r.run_id, r.total, r.n_samples) for r in batches) == sorted((f"r{r}", 2.0 * r, 1) for r in range(40))
