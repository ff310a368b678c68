"""Trees grown best leaf first, against plain Python."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import plumbline as pl
from plumbline.operators import forest, grown_forest


def gini_gain(left, right):
    def pure(rows):
        return sum(rows.count(c) ** 2 for c in set(rows)) / len(rows) if rows else 0.0

    return pure(left) + pure(right) - pure(left + right)


def plain_tree(rows, max_depth, max_leaves):
    """Leaves of one tree as lists of (values, label), splitting the best leaf each time."""

    def best(leaf):
        found = (0.0, None)
        for f in range(len(leaf[0][0]) if leaf else 0):
            values = sorted({x[f] for x, _ in leaf})
            for a, b in zip(values, values[1:]):
                sides = [[r for r in leaf if r[0][f] <= a], [r for r in leaf if r[0][f] > a]]
                gain = gini_gain([r[1] for r in sides[0]], [r[1] for r in sides[1]])
                if gain > found[0] + 1e-9:
                    found = (gain, sides)
        return found

    leaves = [(rows, 0)]
    while max_leaves < 0 or len(leaves) < max_leaves:
        options = [(best(leaf) if depth < max_depth else (0.0, None)) for leaf, depth in leaves]
        at = max(range(len(leaves)), key=lambda i: options[i][0])
        if options[at][1] is None:
            break
        _, depth = leaves.pop(at)
        leaves += [(side, depth + 1) for side in options[at][1]]
    return [leaf for leaf, _ in leaves]


def some_rows(seed, n, width, classes):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    y = (x[:, 0] * 3 + x[:, 1] ** 2 + rng.normal(size=n)).astype(int) % classes
    return [(i, v.tolist(), int(c) * 5 - 3) for i, (v, c) in enumerate(zip(x, y))]


@pytest.mark.parametrize("depth,leaves", [(16, 2), (16, 5), (16, 12), (3, 12), (3, -1), (40, -1)])
def test_a_tree_equals_plain_best_first(points, spark, monkeypatch, depth, leaves):
    monkeypatch.setattr(grown_forest, "SAMPLE_ROWS", 1000)
    monkeypatch.setattr(grown_forest, "BINS", 256)
    rows = some_rows(leaves + 2, 110, 3, 3)
    table = points(rows).repartition(3)
    seeds = {r.row_id: r.h for r in table.select("row_id", F.xxhash64("row_id", "features", "label").alias("h")).collect()}
    hashes = np.array([seeds[i] for i, _, _ in rows], np.int64).view(np.uint64)
    drawn = grown_forest.draws(hashes, 0, grown_forest.poisson(1.0))
    sample = [(tuple(x), c) for (_, x, c), n in zip(rows, drawn) for _ in range(n)]
    model = grown_forest.grow(table, 3, sorted({c for _, _, c in rows}), "features", "label", 1, depth, 1.0, leaves, 1.0, "row_id")
    feature, value, left, right, ends, classes, shares = model.trees[0]
    expected = plain_tree(sample, depth, leaves)
    assert (feature < 0).sum() == len(expected)
    if leaves > 0:
        assert len(expected) <= leaves
    at = grown_forest._leaves(np.array([x for x, _ in sample]), feature, value, left, right)
    found = {}
    for row, leaf in zip(sample, at):
        found.setdefault(int(leaf), []).append(row)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected))
    for leaf, held in found.items():
        own = np.array([c for _, c in held])
        kinds, counts = np.unique(own, return_counts=True)
        names = np.array(sorted({c for _, _, c in rows}))
        assert names[classes[ends[leaf] : ends[leaf + 1]]].tolist() == kinds.tolist()
        assert np.allclose(shares[ends[leaf] : ends[leaf + 1]], counts / counts.sum())


def test_passes_in_small_memory_give_the_same_trees(points, monkeypatch):
    table = points(some_rows(8, 120, 4, 3))
    options = {"max_depth": 4, "max_leaves": 5, "max_features": 1.0}
    whole = pl.fit_random_forest(table, 2, **options)
    monkeypatch.setattr(grown_forest, "HISTOGRAM_BYTES", 8 * 128 * 3 * 2)
    small = pl.fit_random_forest(table, 2, **options)
    for a, b in zip(whole.trees.trees, small.trees.trees):
        assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_a_chain_deeper_than_forty(spark):
    """Classes of growing size, each best parted from all smaller ones, one by one."""
    sizes = spark.createDataFrame([(i, int(8 * 1.15**i)) for i in range(45)], "label int, n int")
    rows = sizes.select("label", F.explode(F.sequence(F.lit(1), "n")).alias("k")).select(
        (F.col("label") * 100_000 + F.col("k")).cast("long").alias("row_id"),
        F.array(F.col("label").cast("float")).alias("features"),
        "label",
    )
    shallow = pl.fit_random_forest(rows, 1, max_depth=30, max_features=1.0)
    assert pl.accuracy(shallow.predict(rows)).first().accuracy < 1.0
    deep = pl.fit_random_forest(rows, 1, max_depth=50, max_features=1.0)
    assert pl.accuracy(deep.predict(rows)).first().accuracy == 1.0
    feature, _, left, right, *_ = deep.trees.trees[0]
    depth = np.zeros(len(feature), int)
    for node in range(len(feature)):
        if feature[node] >= 0:
            depth[left[node]] = depth[right[node]] = depth[node] + 1
    assert depth.max() >= 40


def test_leaves_of_many_classes_and_odd_values(points):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [[nan, -inf, inf, 0.0, 1e38][i % 5], 1.0], [7, -7, 2**31 - 1, 0, 3][i % 5]) for i in range(60)]
    model = pl.fit_random_forest(points(rows), 15, max_leaves=6, max_features=1.0)
    assert pl.accuracy(model.predict(points(rows))).first().accuracy == 1.0
    assert all((t[0] < 0).sum() <= 6 for t in model.trees.trees)
    one = pl.fit_random_forest(points(rows), 3, max_leaves=1)
    assert len({r.prediction for r in one.predict(points(rows)).collect()}) == 1
    same = points([(0, [1.0], 4)] * 20)
    assert {r.prediction for r in pl.fit_random_forest(same, 3, max_leaves=4).predict(same).collect()} == {4}
    with pytest.raises(Exception, match="feature width differs"):
        model.predict(points([(0, [1.0], 0)])).collect()


FLAGS = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]


@pytest.mark.parametrize("key", [lambda i: i, lambda i: i % 4, lambda i: None])
def test_large_tables_of_few_vectors_are_grown(points, monkeypatch, key):
    """Equal rows, whatever their ids, are drawn each by itself: no tree is without a class."""
    monkeypatch.setattr(forest, "DRAWN_VALUES", 0)
    rows = [(key(i), FLAGS[i % 3], [0, 2, 5][i % 3]) for i in range(300)]
    model = pl.fit_random_forest(points(rows), 30, 10)
    assert isinstance(model, forest.GrownForestModel)
    assert pl.accuracy(model.predict(points(rows))).first().accuracy == 1.0
    for feature, _, _, _, ends, _, shares in model.trees.trees:
        assert (feature < 0).sum() == 3 and (shares == 1.0).all() and ends[-1] == 3
    turned = pl.fit_random_forest(points(rows[::-1]).repartition(5), 30, 10)
    for a, b in zip(model.trees.trees, turned.trees.trees):
        assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_spark_ml_takes_small_tables_and_many_vectors(points, monkeypatch):
    few = points([(i, FLAGS[i % 3], i % 3) for i in range(60)])
    many = points([(i, [float(i), 1.0], i % 2) for i in range(140)])
    assert isinstance(pl.fit_random_forest(few, 3), forest.ForestModel)
    monkeypatch.setattr(forest, "DRAWN_VALUES", 0)
    assert isinstance(pl.fit_random_forest(many, 3), forest.ForestModel)


@pytest.mark.parametrize("max_features,columns", [("sqrt", 2), (0.1, 1), (1.0, 3)])
def test_grown_tables_try_as_many_columns_as_spark_ml(points, monkeypatch, max_features, columns):
    tried = []
    columns_of = grown_forest.columns_of
    monkeypatch.setattr(grown_forest, "columns_of", lambda t, n, w, taken: tried.append(taken) or columns_of(t, n, w, taken))
    monkeypatch.setattr(forest, "DRAWN_VALUES", 0)
    pl.fit_random_forest(points([(i, FLAGS[i % 3], i % 3) for i in range(60)]), 3, max_features=max_features)
    assert set(tried) == {columns}


def test_odd_values_of_few_vectors(points, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [[nan, -inf, inf, -0.0, 1e38][i % 5], 1.0], [7, -7, 2**31 - 1, 0, 3][i % 5]) for i in range(100)]
    monkeypatch.setattr(forest, "DRAWN_VALUES", 0)
    model = pl.fit_random_forest(points(rows), 15)
    assert isinstance(model, forest.GrownForestModel)
    assert pl.accuracy(model.predict(points(rows))).first().accuracy == 1.0


def test_equal_rows_of_a_batch_go_down_a_tree_once(monkeypatch):
    rng = np.random.default_rng(3)
    bins, classes, seeds = rng.integers(0, 2, (900, 3)).astype(np.uint8), rng.integers(0, 2, 900), rng.integers(0, 2**62, 900)
    tree = grown_forest.Tree()
    tree.split(0, 1, 0, None, None)
    asked = {"columns": np.array([[0, 2]]), "trees": [(4, tree.arrays(), np.array([-1, -1, 0]))]}
    shared, chances = type("Shared", (), {"value": asked}), grown_forest.poisson(1.0)
    walked, leaves_of = [], grown_forest.leaves_of
    monkeypatch.setattr(grown_forest, "leaves_of", lambda b, t: walked.append(len(b)) or leaves_of(b, t))
    texts = pa.array([r.tobytes() for r in bins], pa.binary())
    batch = pa.RecordBatch.from_arrays([texts, pa.array(classes.astype(np.int32)), pa.array(seeds)], names=["bins", "class", "seed"])
    (found,) = grown_forest._histograms(shared, 3, (2, 2, 2), chances)([batch.slice(0, 0), batch])
    expected = np.zeros((2, 2, 2), np.int64)
    for row, c, n in zip(bins, classes, grown_forest.draws(seeds, 4, chances)):
        for slot, column in enumerate((0, 2)):
            expected[slot, row[column], c] += n * (row[1] > 0)
    assert found.column("sums")[0].as_py() == expected.tobytes()
    assert max(walked) <= 16


@pytest.mark.parametrize("rate", [0.3, 1.0, 5.0, 200.0])
def test_draws_by_a_table_are_those_by_search(rate):
    chances, seeds = grown_forest.poisson(rate), np.random.default_rng(5).integers(0, 2**62, 20_000)
    unit = (grown_forest.key_of(9, seeds) >> np.uint64(11)) / float(1 << 53)
    assert np.array_equal(grown_forest.draws(seeds, 9, chances), np.searchsorted(chances, unit, "right"))
    assert (grown_forest.guide(chances) >= 0).mean() > 0.5


@pytest.mark.parametrize("width", [1, 3])
def test_rows_are_alike_where_their_bytes_are(monkeypatch, width):
    values = np.array([0.0, -0.0, np.nan, np.inf, 1.0, 0.0, np.nan, 1.0])
    rows = np.stack([values] + [np.ones(len(values))] * (width - 1), axis=1)
    for _ in range(2):
        first, which = grown_forest.alike(rows)
        assert rows[first][which].tobytes() == rows.tobytes()
        # With a hash that tells nothing, rows stay apart.
        monkeypatch.setattr(grown_forest, "mixed", lambda x: x & np.uint64(0))
    assert [len(a) for a in grown_forest.alike(rows[:0])] == [0, 0]


@pytest.mark.parametrize("name", ["rf_separable", "rf_score_stream"])
def test_flags_of_lines_on_grown_trees(spark, monkeypatch, name):
    grown, grow = [], grown_forest.grow
    monkeypatch.setattr(grown_forest, "grow", lambda *a: grown.append(a) or grow(*a))
    monkeypatch.setattr(forest, "DRAWN_VALUES", 0)
    found = entry_points.queries()[name](spark, "/root/testdata/sf0.001")
    lines = entry_points._line_flags(spark, "/root/testdata/sf0.001").select("l_orderkey", "l_linenumber", "label")
    assert len(grown) == 1
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, lines.collect()))


def test_equal_rows_are_stored_once_and_drawn_as_often(points, monkeypatch):
    """Ten thousand rows are three groups; each tree draws about as many rows as there are."""
    stored, written_table = [], grown_forest.written_table
    monkeypatch.setattr(grown_forest, "written_table", lambda df, name: stored.append(df.collect()) or written_table(df, name))
    monkeypatch.setattr(forest, "DRAWN_VALUES", 0)
    plain = []
    monkeypatch.setattr(grown_forest, "_plain", lambda t, cuts, f=grown_forest._plain: plain.append(t.counts[0]) or f(t, cuts))
    rows = [(i, FLAGS[min(i % 10, 2)], min(i % 10, 2)) for i in range(10_000)]
    for share in (1.0, 0.3):
        plain.clear()
        pl.fit_random_forest(points(rows), 40, 10, max_samples=share)
        expected = share * np.array([1000, 1000, 8000])
        assert len(stored[-1]) == 3 and sum(r.rate for r in stored[-1]) == pytest.approx(10_000 * share)
        gap = (np.array(plain) - expected) / np.sqrt(expected)
        assert gap.shape == (40, 3) and np.abs(gap).max() < 5 and 0.7 < gap.std() < 1.3


def test_draws_of_a_group_are_those_of_its_rows():
    seeds, chances = np.arange(20_000, dtype=np.uint64), grown_forest.poisson(0.7)
    drawn = grown_forest.group_draws(seeds, np.full(len(seeds), 7 * 0.7), 3)
    single = sum(grown_forest.draws(seeds + np.uint64(i * 10**6), 0, chances) for i in range(7))
    most = max(drawn.max(), single.max()) + 1
    shares = [np.bincount(d, minlength=most) / len(seeds) for d in (*drawn, single)]
    assert all(np.abs(s - shares[-1]).max() < 0.015 for s in shares)
    assert np.abs(np.corrcoef(drawn) - np.eye(3)).max() < 0.03
    # Numbers depend on the group only: not on the other groups, nor on more trees.
    assert np.array_equal(grown_forest.group_draws(seeds[:50][::-1], np.full(50, 7 * 0.7), 9)[:3, ::-1], drawn[:, :50])
    assert grown_forest.group_draws(seeds[:0], np.zeros(0), 3).shape == (3, 0)


def test_lines_are_scored_from_where_they_are(spark, tmp_path, monkeypatch):
    """The stream reads a folder of line items itself; no copy of the table is written."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines.repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    folders, shared_folder = [], pl.shared_folder
    monkeypatch.setattr(pl, "shared_folder", lambda spark, name: folders.append(name) or shared_folder(spark, name))
    monkeypatch.setattr(forest, "DRAWN_VALUES", 0)
    found = entry_points.queries()["rf_score_stream"](spark, str(tmp_path))
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 2).otherwise(5)
    expected = lines.select("l_orderkey", "l_linenumber", label)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert folders == ["scored", "scored-state"]
