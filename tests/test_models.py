from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import plumbline as pl
from plumbline.operators import kmeans, nearest

GRID = {"broadcast_bytes": 0, "block_bytes": 2000}
PATHS = [{}, GRID]


def brute(queries, train, k):
    """Neighbour ids by plain distance, ties to the lower id."""
    found = {}
    for q, x in queries:
        gaps = sorted((sum((a - b) ** 2 for a, b in zip(x, t)), i) for i, t, _ in train)
        found[q] = [i for _, i in gaps[:k]]
    return found


def neighbor_ids(found):
    out = {}
    for r in found.orderBy("row_id", "rank").collect():
        out.setdefault(r.row_id, []).append(r.train_id)
    return out


@pytest.mark.parametrize("limits", PATHS)
@pytest.mark.parametrize("kind", ["spread", "whole numbers", "one hot point", "clusters"])
def test_neighbors_match_brute_force(points, limits, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)).astype(np.float32)
    if kind == "whole numbers":
        x = rng.integers(0, 3, (300, 4)).astype(np.float32)
    if kind == "one hot point":
        x[rng.random(300) < 0.4] = x[0]
    if kind == "clusters":
        x = (x + 100 * rng.integers(0, 5, (300, 1))).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)]
    train, test = rows[:220], rows[220:]
    model = pl.fit_knn(points(train), 4, **limits)
    found = neighbor_ids(model.neighbors(points(test)))
    assert found == brute([(i, v) for i, v, _ in test], train, 4)


def clustered(rows, width, seed=5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(40, width)) * 20
    return [(i, (centers[i % 40] + rng.normal(size=width)).tolist(), i % 3) for i in range(rows)]


def test_blocks_skip_far_cells(points):
    """At 64 columns a quarter of all pairs is compared at most."""
    table = points(clustered(3000, 64))
    model = pl.fit_knn(table, 3, broadcast_bytes=0, block_bytes=50_000)
    assert model.neighbors(table).count() == 9000
    assert 0 < model.points.compared < 3000 * 3000 / 4


def test_home_cell_first_spares_cells(points, monkeypatch):
    """With a sample that says little the home cell gives the bound."""
    monkeypatch.setattr(nearest, "SAMPLE_ROWS", 45)
    monkeypatch.setattr(nearest, "_pivots", lambda sample, rows, k: np.unique(sample, axis=0).astype(float))
    table = points(clustered(2000, 8))
    model = pl.fit_knn(table, 5, broadcast_bytes=0, block_bytes=50_000)
    found = sorted(map(tuple, model.neighbors(table).collect()))
    assert found == sorted(map(tuple, pl.fit_knn(table, 5).neighbors(table).collect()))
    assert model.points.compared < 2000 * 2000 / 4


def test_a_search_moves_no_reference_rows(points):
    """The stored blocks are read where they lie: no exchange, no search for their pivots."""
    table = points(clustered(600, 4))
    model = pl.fit_knn(table, 2, **GRID)
    model.predict(table).count()
    index = model.points.index(2)
    asked = table.select(F.col("row_id").alias("query_id"), "features", F.lit(1).alias("block"))
    plan = nearest._visited(asked, index, model.points, 2)._jdf.queryExecution().executedPlan().toString()
    own, other = plan.split("FlatMapCoGroupsInArrow")[1].split("\n      :- ", 1)[-1].split("\n      +- ", 1)
    assert "Exchange" in own and "SelectedBucketsCount" in other
    assert "Exchange" not in other and "ArrowEvalPython" not in plan


def test_more_reference_rows_take_no_more_visits(points, monkeypatch):
    """A query travels once for each block, and their number is that of the cores."""
    visited, visits = nearest._visited, []

    def counted(asked, *rest):
        visits.append(asked.count())
        return visited(asked, *rest)

    monkeypatch.setattr(nearest, "_visited", counted)
    rng = np.random.default_rng(3)
    for rows in (400, 4000):
        table = points([(i, v.tolist(), i % 3) for i, v in enumerate(rng.normal(size=(rows, 24)).astype(np.float32))])
        some = table.filter("row_id < 50")
        expected = sorted(map(tuple, pl.fit_knn(table, 3).neighbors(some).collect()))
        found = pl.fit_knn(table, 3, broadcast_bytes=0, block_bytes=4000).neighbors(some)
        assert sorted(map(tuple, found.collect())) == expected
        cores = table.sparkSession.sparkContext.defaultParallelism
        assert 0 < max(visits) <= 50 * 2 * nearest.BLOCKS_PER_CORE * cores
        visits.clear()


def test_blocks_that_many_queries_visit_are_copied(points, monkeypatch):
    table = points(clustered(400, 3))
    expected = sorted(map(tuple, pl.fit_knn(table, 3).neighbors(table).collect()))
    monkeypatch.setattr(nearest, "ASKED_ROWS", 7)
    found = pl.fit_knn(table, 3, **GRID).neighbors(table)
    assert sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("limits", PATHS)
def test_ties(points, limits):
    train = points([(7, [1.0, 0.0], 4), (3, [-1.0, 0.0], 2), (9, [5.0, 0.0], 0)])
    query = points([(0, [0.0, 0.0], 0)])
    model = pl.fit_knn(train, 2, **limits)
    assert neighbor_ids(model.neighbors(query)) == {0: [3, 7]}
    assert model.predict(query).first().prediction == 2


@pytest.mark.parametrize("limits", PATHS)
def test_fewer_rows_than_k(points, limits):
    train = points([(1, [0.0], 1), (2, [1.0], 1), (3, [2.0], 5)])
    model = pl.fit_knn(train, 10, **limits)
    query = points([(0, [1.9], 0)])
    assert neighbor_ids(model.neighbors(query)) == {0: [3, 2, 1]}
    assert model.predict(query).first().prediction == 1


def test_predict_keeps_columns_and_rows(points):
    table = points([(i, [float(i)], i) for i in range(20)]).withColumn("note", F.lit("x"))
    for limits in PATHS:
        found = pl.fit_knn(table, 1, **limits).predict(table)
        assert set(found.columns) == {"row_id", "features", "label", "note", "prediction"}
        assert found.filter("label = prediction").count() == 20


def test_k_below_one(points):
    with pytest.raises(ValueError):
        pl.fit_knn(points([(0, [0.0], 0)]), 0)


def test_predicting_nothing_gives_nothing(points):
    table = points([(i, [float(i % 2)], i % 2) for i in range(10)])
    none = table.filter("row_id < 0")
    for limits in PATHS:
        assert pl.fit_knn(table, 1, **limits).predict(none).count() == 0
    assert pl.lloyd(table, [[0.0], [1.0]], 1).predict(none).count() == 0
    assert pl.fit_random_forest(table, 3).predict(none).count() == 0


FITS = [
    lambda df: pl.fit_knn(df, 1),
    lambda df: pl.fit_kmeans(df, 2),
    lambda df: pl.fit_random_forest(df, 3),
]


@pytest.mark.parametrize("fit", FITS)
def test_bad_training_tables(points, fit):
    with pytest.raises(ValueError, match="empty matrix"):
        fit(points([]))
    with pytest.raises(ValueError, match="ragged matrix"):
        fit(points([(0, [1.0, 2.0], 0), (1, [1.0], 1)]))
    with pytest.raises(ValueError, match="ragged matrix"):
        fit(points([(0, [1.0, None], 0), (1, [1.0, 2.0], 1)]))


@pytest.mark.parametrize("fit", [FITS[0], FITS[2]])
def test_missing_labels(points, fit):
    with pytest.raises(ValueError, match="labels does not match"):
        fit(points([(0, [1.0], 0), (1, [1.0], None)]))


@pytest.mark.parametrize("fit", FITS)
def test_width_mismatch(points, fit):
    model = fit(points([(i, [float(i), 1.0], i % 2) for i in range(10)]))
    with pytest.raises(Exception, match="feature width differs"):
        model.predict(points([(0, [1.0], 0)])).collect()


@pytest.fixture
def blobs(points):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=2) + 50.0 * (i % 2)).tolist(), i % 2) for i in range(60)]
    return points(rows)


def test_two_blobs(blobs):
    clusters = pl.fit_kmeans(blobs, 2).predict(blobs)
    assert clusters.groupBy("label", "prediction").count().count() == 2
    forest = pl.fit_random_forest(blobs, 50)
    assert pl.accuracy(forest.predict(blobs)).first().accuracy == 1.0
    assert pl.accuracy(pl.fit_knn(blobs).predict(blobs)).first().accuracy == 1.0


def test_kmeans_fit_is_a_clustering(points):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3))
    table = points([(i, v.tolist(), 0) for i, v in enumerate(x)])
    model = pl.fit_kmeans(table, 5)
    found = {r.row_id: (r.prediction, r.distance) for r in model.assign(table).collect()}
    rounded = x.astype(np.float32).astype(float)
    gaps = ((rounded[:, None] - model.centers[None]) ** 2).sum(axis=2)
    assert [found[i][0] for i in range(200)] == gaps.argmin(axis=1).tolist()
    assert np.isclose(model.inertia, gaps.min(axis=1).sum())
    assert model.inertia < ((rounded - rounded.mean(axis=0)) ** 2).sum()
    sizes = pl.cluster_sizes(model.predict(table)).collect()
    assert sum(r.n_rows for r in sizes) == 200 and len(sizes) == 5


def test_kmeans_depends_on_its_rows_only(points, spark):
    rng = np.random.default_rng(14)
    rows = [(i, (rng.normal(size=3) + 6.0 * (i % 5)).tolist(), 0) for i in range(500)]
    fits = [pl.fit_kmeans(points(order).repartition(n), 5) for order, n in ((rows, 2), (rows[::-1], 8), (rows, 3))]
    for other in fits[1:]:
        assert np.allclose(other.centers, fits[0].centers, rtol=1e-9) and np.isclose(other.inertia, fits[0].inertia)
    # Five groups far apart are found.
    found = fits[0].predict(points(rows)).withColumn("of", F.col("row_id") % 5)
    assert found.groupBy("of", "prediction").count().count() == 5


@pytest.mark.parametrize("direct", [0, 1 << 30])
def test_sums_on_the_driver_or_in_tasks(points, monkeypatch, direct):
    from plumbline.operators import kmeans

    monkeypatch.setattr(kmeans, "DIRECT_BYTES", direct)
    table = points([(i, [float(i % 4) * 10, 1.0], 0) for i in range(80)]).repartition(5)
    model = pl.fit_kmeans(table, 4)
    assert sorted(c[0] for c in model.centers.tolist()) == [0.0, 10.0, 20.0, 30.0] and model.inertia == 0.0


def test_one_cluster_is_the_mean(points):
    model = pl.fit_kmeans(points([(0, [0.0, 2.0], 0), (1, [2.0, 4.0], 0)]), 1)
    assert model.centers.tolist() == [[1.0, 3.0]] and model.inertia == 4.0


def test_more_clusters_than_rows(points):
    table = points([(0, [0.0], 0), (1, [5.0], 0)])
    assert pl.fit_kmeans(table, 6).inertia == 0.0


def test_lloyd_stops_and_keeps_empty_clusters(points):
    table = points([(i, [float(i // 5) * 10], 0) for i in range(10)])
    model = pl.lloyd(table, [[1.0], [9.0], [500.0]], 50)
    assert model.centers.tolist() == [[0.0], [10.0], [500.0]]
    assert model.inertia == 0.0 and model.iterations == 2


def test_lloyd_needs_centers_of_the_right_width(points):
    with pytest.raises(ValueError, match="centres must have 1 columns"):
        pl.lloyd(points([(0, [0.0], 0)]), [[0.0, 1.0]], 1)


def test_many_centers_are_searched_in_blocks(points, monkeypatch):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(300, 2))
    table = points([(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(90, 2)))])
    model = pl.lloyd(table, centers, 0)
    near = sorted(model.assign(table).select("row_id", "prediction").collect())
    of_centers = nearest.PointSet.of_centers
    monkeypatch.setattr(
        nearest.PointSet, "of_centers", lambda spark, c: of_centers(spark, c, **GRID)
    )
    assert sorted(model.assign(table).select("row_id", "prediction").collect()) == near


@pytest.mark.parametrize("width", [1, 3, 70])
def test_stored_centers_equal_the_small_path(points, spark, width):
    rng = np.random.default_rng(8)
    table = points([(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(160, width)).round(2))])
    start = rng.normal(size=(50, width)).round(2)
    small = pl.lloyd(table, start, 3, 0.0)
    large = pl.lloyd(table, start, 3, 0.0, broadcast_bytes=100)
    again = pl.lloyd(table, large.table, 0)
    held = {r.cluster_id: r.center for r in large.center_rows(spark).collect()}
    assert np.allclose([held[i] for i in range(50)], small.centers) and np.allclose(again.centers, small.centers)
    assert large.iterations == small.iterations == 3 and np.isclose(large.inertia, small.inertia)
    near = sorted(small.predict(table).select("row_id", "prediction").collect())
    assert sorted(large.predict(table).select("row_id", "prediction").collect()) == near
    large.unpersist()
    assert not Path(large.folder).exists()
    with pytest.raises(ValueError, match="columns"):
        pl.lloyd(table, [[0.0] * (width + 1)], 1)


def test_more_clusters_than_a_broadcast(points):
    table = points([(i, [float(i % 90), 1.0], 0) for i in range(300)])
    model = pl.fit_kmeans(table, 60, broadcast_bytes=100)
    assert model.predict(table).select("prediction").distinct().count() == 60
    every = pl.fit_kmeans(table, 500, broadcast_bytes=100)
    assert every.inertia == 0.0 and every.center_rows(None).count() == 90


def test_forest_labels_with_gaps_and_below_zero(points):
    table = points([(i, [float(i % 3)], [-4, 2, 500][i % 3]) for i in range(60)])
    found = pl.fit_random_forest(table, 10).predict(table)
    assert found.filter("label = prediction").count() == 60
    assert (pl.num_classes(table), pl.num_classes_max(table)) == (3, 501)


def test_forest_of_one_class(points):
    table = points([(i, [float(i)], 3) for i in range(8)])
    assert {r.prediction for r in pl.fit_random_forest(table, 3).predict(table).collect()} == {3}


def test_forest_options(points):
    table = points([(i, [float(i % 2), 0.0], i % 2) for i in range(20)])
    for wrong in ({"max_leaves": 0}, {"max_leaves": -2}, {"max_depth": -1}):
        with pytest.raises(ValueError):
            pl.fit_random_forest(table, 3, **wrong)
    model = pl.fit_random_forest(table, 7, max_depth=2, max_features=1.0, max_samples=0.5)
    assert model.trees.getNumTrees == 7
    assert model.trees.getOrDefault("subsamplingRate") == 0.5
    assert model.trees.getFeatureSubsetStrategy() == "1.0"
    assert model.trees.getMaxBins() == 128 and model.trees.getImpurity() == "gini"


@pytest.mark.parametrize("limits", PATHS)
def test_repeated_null_and_absent_ids(spark, limits):
    train = spark.createDataFrame([(i, [float(i)], i) for i in range(40)], "row_id long, features array<float>, label int")
    asked = [(1, [0.2]), (1, [9.1]), (None, [30.0]), (None, [30.0]), (2, [5.0])]
    table = spark.createDataFrame(asked, "row_id long, features array<float>")
    model = pl.fit_knn(train, 3, **limits)
    found = model.predict(table).collect()
    assert sorted((r.features[0], r.prediction) for r in found) == [
        (pytest.approx(0.2), 0), (5.0, 4), (pytest.approx(9.1), 8), (30.0, 29), (30.0, 29)
    ]
    assert model.predict(table.drop("row_id")).count() == 5
    assert model.neighbors(table).count() == 15
    with pytest.raises(ValueError, match="score_stream"):
        model.predict(spark.readStream.format("rate").load())


def test_reference_is_stored_once(points, spark):
    table = points([(i, [float(i)], i % 2) for i in range(60)])
    model = pl.fit_knn(table, 2, **GRID)
    assert model.predict(table).count() == 60
    stored = model.points.folders[0]
    assert model.predict(table).count() == 60 and len(model.points.tables) == 1
    assert [f for f in model.points.folders if "points-" in f] == [stored]
    paths, names = [Path(f) for f in model.points.folders], set(model.points.tables)
    assert all(path.exists() for path in paths)
    model.unpersist()
    assert not any(path.exists() for path in paths) and not model.points.stored
    assert not names & {t.name for t in spark.catalog.listTables()}
    assert model.predict(table).count() == 60
    small = pl.fit_knn(table, 2)
    assert small.predict(table).count() == 60
    small.unpersist()
    assert small.predict(table).count() == 60


@pytest.mark.parametrize("cells", [1, 3, 40])
def test_any_number_of_cells_gives_the_same(points, monkeypatch, cells):
    monkeypatch.setattr(nearest, "_pivots", lambda sample, rows, k: np.unique(sample, axis=0)[:cells].astype(float))
    table = points([(i, [float(i * 37 % 101)], i % 3) for i in range(90)])
    found = pl.fit_knn(table, 3, **GRID).neighbors(table)
    expected = pl.fit_knn(table, 3).neighbors(table)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_odd_values_in_blocks(points):
    nan, inf = float("nan"), float("inf")
    values = [[nan, 0.0], [inf, 1.0], [-inf, 1.0], [1e30, 1.0], [0.0, 0.0]] + [[float(i), 1.0] for i in range(40)]
    table = points([(i, v, i % 3) for i, v in enumerate(values)])
    found = pl.fit_knn(table, 3, **GRID).neighbors(table).select("row_id", "rank", "train_id")
    expected = pl.fit_knn(table, 3).neighbors(table).select("row_id", "rank", "train_id")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("ids", [300, 7, 1])
@pytest.mark.parametrize("options", [{}, {"max_leaves": 9}])
def test_forest_depends_on_its_rows_only(points, ids, options):
    rng = np.random.default_rng(7)
    rows = [(i % ids, rng.normal(size=3).tolist(), int(rng.integers(0, 2))) for i in range(300)]
    asked = [(i, r[1], r[2]) for i, r in enumerate(rows)]
    found = []
    for table in (points(rows).repartition(2), points(rows[::-1]).repartition(7)):
        predicted = pl.fit_random_forest(table, 5, 6, **options).predict(points(asked))
        found.append(sorted((r.row_id, r.prediction) for r in predicted.select("row_id", "prediction").collect()))
    assert found[0] == found[1]


def test_forest_takes_many_classes(points):
    table = points([(i, [float(i)], 7 * i - 50) for i in range(120)])
    found = pl.fit_random_forest(table, 2, 2).predict(table)
    assert found.filter("prediction % 7 = -1 OR prediction % 7 = 6").count() == 120


def test_rounds_without_candidates_take_no_passes(points, monkeypatch):
    """Of copies no row may be drawn in many rounds: the costs are summed for new candidates only."""
    calls, sums, drawn = [], kmeans._cluster_sums, kmeans._drawn
    monkeypatch.setattr(kmeans, "_cluster_sums", lambda *a: calls.append("sums") or sums(*a))
    monkeypatch.setattr(kmeans, "_drawn", lambda *a: calls.append("draws") or drawn(*a))
    table = points([(0, [0.0, 0.0], 0)]).sparkSession.range(60_000).select(
        F.array((F.col("id") % 3).cast("float"), F.lit(1.0).cast("float")).alias("features")
    )
    model = pl.fit_kmeans(table, 3)
    assert sorted(c[0] for c in model.centers) == [0.0, 1.0, 2.0] and model.inertia == 0.0
    assert calls.count("sums") <= 4 and calls.count("draws") <= 5


def test_inertia_of_centres_that_moved_in_the_last_pass(points):
    table = points([(i, [float(x)], 0) for i, x in enumerate([0, 1, 9, 11])])
    for steps, inertia in ((0, 4.0 + 1.0 + 0.0 + 4.0), (1, 0.5 + 2.0), (5, 0.5 + 2.0)):
        assert pl.lloyd(table, [[2.0], [9.0]], steps).inertia == inertia
    assert pl.lloyd(table, [[2.0], [9.0]], 5, 100.0).inertia == 2.5
