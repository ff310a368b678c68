"""k-means clustering: from drawn or given centres."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import blocks
from plumbline.functions.vectors import UNROLL_WIDTH, of_width
from plumbline.operators.evaluate import training_shape
from plumbline.operators.nearest import (
    BROADCAST_BYTES,
    PointSet,
    numbered,
    point_bytes,
    with_neighbors,
)
from plumbline.operators.order import with_row_id
from plumbline.session import remove_folder, scratch, shared_folder, written_table

DEFAULT_CLUSTERS = 8
DEFAULT_ITERATIONS = 300
DEFAULT_TOLERANCE = 1e-4
SEED = 42
#: Rounds of the parallel initialisation, more while there are too few candidates, each
#: drawing about ``OVERSAMPLING`` candidates for a cluster; rounds that one pass over the
#: rows draws until one gives any; passes over the candidates.
START_ROUNDS, MOST_ROUNDS, OVERSAMPLING, ROUNDS_AT_ONCE, LOCAL_PASSES = 2, 40, 2, 8, 30
#: Partial sums of all tasks that go to the driver at once; more of them meet in tasks first.
DIRECT_BYTES = 16 << 20
# Partial sums of a cluster meet in two steps: so many groups of tasks, then one row.
MERGE_TREE, MERGE_PARTS = 64, 256
PARTIAL = "cluster_id int, n long, cost double, sums array<double>"


@dataclass
class CentroidModel:
    """Centres by cluster id, and the squared distance summed over the fitted rows."""

    centers: np.ndarray
    inertia: float
    iterations: int

    def assign(self, df, features="features", row_id="row_id"):
        """Adds ``prediction`` and the squared ``distance`` to that centre."""
        return _assigned(df, PointSet.of_centers(df.sparkSession, self.centers), features)

    def predict(self, df, features="features", row_id="row_id"):
        """Adds the nearest centre of each row; the lowest cluster id wins a tie."""
        return self.assign(df, features, row_id).drop("distance")

    def center_rows(self, spark):
        """Centres as ``(cluster_id, center)`` rows."""
        rows = [(i, c.tolist()) for i, c in enumerate(self.centers)]
        return spark.createDataFrame(rows, "cluster_id int, center array<double>")


@dataclass
class StoredCentroidModel:
    """As ``CentroidModel``, for centres beyond the broadcast bound.

    They are a table ``(cluster_id, center)`` below the checkpoint folder, and rows find
    theirs by the block search. ``unpersist`` removes what the model and its
    predictions have stored; predictions not yet computed need it.
    """

    table: DataFrame
    folder: str
    points: PointSet
    inertia: float
    iterations: int

    def assign(self, df, features="features", row_id="row_id"):
        """Adds ``prediction`` and the squared ``distance`` to that centre."""
        return _assigned(df, self.points, features)

    def predict(self, df, features="features", row_id="row_id"):
        """Adds the nearest centre of each row; the lowest cluster id wins a tie."""
        return self.assign(df, features, row_id).drop("distance")

    def center_rows(self, spark):
        """Centres as ``(cluster_id, center)`` rows."""
        return self.table

    def unpersist(self):
        self.points.release()
        remove_folder(self.table.sparkSession, self.folder)


def _assigned(df, points, features):
    found = with_neighbors(df, points, 1, features, "_nearest")
    hit = F.col("_nearest")[0]
    assigned = found.withColumn("prediction", hit["label"]).withColumn("distance", hit["distance"])
    return assigned.drop("_nearest")


def _check_clusters(k):
    if k < 1:
        raise ValueError(f"the number of clusters must be at least 1, not {k}")


def fit_kmeans(
    df,
    k=DEFAULT_CLUSTERS,
    max_iter=DEFAULT_ITERATIONS,
    tol=DEFAULT_TOLERANCE,
    features="features",
    row_id="row_id",
    broadcast_bytes=BROADCAST_BYTES,
):
    """Fit with seeded parallel initialisation, then ``lloyd``.

    Rows are drawn as candidates in rounds, with a chance that grows with their distance
    to the candidates so far; each is weighted by the rows nearest to it, and weighted
    k-means on the driver makes the ``k`` starting centres of them. Chances are compared
    with a hash of the row, so the centres depend on the rows only, but for the order of
    sums. With fewer different candidates than ``k`` there are fewer centres.

    Centres beyond ``broadcast_bytes`` start as the ``k`` different rows with the least
    hash instead, all rows where there are fewer, and the fit goes on as for ``lloyd``.
    """
    rows, width = training_shape(df, features)
    _check_clusters(k)
    with scratch(df.sparkSession):
        table = written_table(df.select(of_width(features, width).alias("features")), "kmeans-rows")
        if k * point_bytes(width) > broadcast_bytes:
            start = written_table(_least_hashes(table, k), "kmeans-start")
            return lloyd(table, start, max_iter, tol, "features", (rows, width), broadcast_bytes)
        tasks = _tasks(table)
        start = np.zeros((1, width)) if k == 1 else _drawn_centers(table, k, width, tasks)
        return _passes(table, start, width, 1 if k == 1 else max_iter, tol, tasks)


def _drawn_centers(rows, k, width, tasks):
    key = F.xxhash64("features", F.lit(SEED))
    first = rows.orderBy(key, "features").limit(1).toArrow()
    found = blocks.doubles(first["features"], width)
    step, sums = 0, _cluster_sums(rows, found, width, tasks)
    while step < MOST_ROUNDS and 0 < sums[2] < np.inf and not (step >= START_ROUNDS and len(found) >= k):
        # Rounds that give nothing leave the costs as they are, so a pass goes on with the next.
        last = MOST_ROUNDS if len(found) < k else START_ROUNDS
        steps = range(step, min(step + ROUNDS_AT_ONCE, last))
        # Copies of a row are drawn together, so rounds may give few; then the chances double.
        rates = [OVERSAMPLING * k * 2.0 ** max(0, s + 1 - START_ROUNDS) / sums[2] for s in steps]
        draws = [F.pmod(F.xxhash64("features", F.lit(SEED), F.lit(s)), F.lit(1 << 53)) / F.lit(float(1 << 53)) for s in steps]
        shared = rows.sparkSession.sparkContext.broadcast({"points": numbered(found)})
        drawn = rows.select("features", *[d.alias(f"draw{i}") for i, d in enumerate(draws)]).mapInArrow(
            _drawn(shared, width, rates), "round int, features array<double>"
        )
        drawn = drawn.toArrow()
        shared.unpersist()
        if not len(drawn):
            step = steps[-1] + 1
            continue
        at = drawn["round"].to_numpy()
        new = blocks.doubles(drawn["features"], width)[at == at.min()]
        found, step = np.unique(np.concatenate([found, new]), axis=0), steps[at.min()] + 1
        sums = _cluster_sums(rows, found, width, tasks)
    return _reduced(found, sums[0].astype(np.float64), k)


def _drawn(shared, width, rates):
    """The different rows whose draw is below their squared distance times the rate, of the
    task's first round that has any."""

    def run(batches):
        points = blocks.Points.shared(shared)
        first, held = len(rates), np.empty((0, width))
        for batch in batches:
            rows = blocks.doubles(batch.column(0), width)
            distance = blocks.nearest(rows, points, 1)[0][:, 0]
            for i, rate in enumerate(rates[: first + 1]):
                chosen = batch.column(i + 1).to_numpy() < rate * distance
                if chosen.any():
                    held = np.unique(np.concatenate([held if i == first else held[:0], rows[chosen]]), axis=0)
                    first = i
                    break
        features = pa.array(list(held), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), first, np.int32)), features], names=["round", "features"])

    return run


def _reduced(points, weights, k):
    """``k`` centres of weighted points: seeded draws by distance, then passes over the points."""
    rng = np.random.default_rng(SEED)
    every = blocks.Points(*numbered(points))

    def gaps(centers):
        held = blocks.Points(*numbered(np.array(centers)))
        distance, at = blocks.nearest(points, held, 1)
        return distance[:, 0], at[:, 0]

    if len(points) <= k:
        return every.values
    centers = [points[rng.choice(len(points), p=weights / weights.sum())]]
    while len(centers) < k:
        chance = weights * gaps(centers)[0]
        if not 0 < chance.sum() < np.inf:
            break
        centers.append(points[rng.choice(len(points), p=chance / chance.sum())])
    centers = np.array(centers)
    for _ in range(LOCAL_PASSES):
        at = gaps(centers)[1]
        total = np.bincount(at, weights=weights, minlength=len(centers))
        sums = np.zeros(centers.shape)
        np.add.at(sums, at, points * weights[:, None])
        moved = np.where(total[:, None] > 0, sums / np.maximum(total, 1e-300)[:, None], centers)
        if np.array_equal(moved, centers):
            break
        centers = moved
    return centers


def _partial_sums(shared, width):
    """Per task: one row per cluster with its count, coordinate sums and cost."""

    def collect(batches):
        points = blocks.Points.shared(shared)
        centers = points.values
        counts = np.zeros(len(centers), dtype=np.int64)
        sums = np.zeros(centers.shape)
        costs = np.zeros(len(centers))
        for batch in batches:
            rows = blocks.doubles(batch.column(0), width)
            distance, cluster = blocks.nearest(rows, points, 1)
            cluster = cluster[:, 0]
            counts += np.bincount(cluster, minlength=len(centers))
            costs += np.bincount(cluster, weights=distance[:, 0], minlength=len(centers))
            order = np.argsort(cluster, kind="stable")
            first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            if len(first):
                sums[cluster[order][first]] += np.add.reduceat(rows[order], first, axis=0)
        seen = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(seen.astype(np.int32)),
                pa.array(counts[seen]),
                pa.array(costs[seen]),
                pa.array(list(sums[seen]), pa.list_(pa.float64())),
            ],
            names=["cluster_id", "n", "cost", "sums"],
        )

    return collect


def _cluster_sums(df, centers, width, tasks=None):
    """Count, cost and coordinate sums of every non-empty cluster, of ``tasks`` tasks if known."""
    shared = df.sparkSession.sparkContext.broadcast({"points": numbered(centers)})
    partial = df.mapInArrow(_partial_sums(shared, width), PARTIAL)
    if tasks is None or tasks * centers.nbytes > DIRECT_BYTES:
        parts = max(1, min(MERGE_PARTS, len(centers)))
        partial = (
            partial.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_TREE)))
            .groupBy("cluster_id", "part")
            .applyInArrow(_add_sums, PARTIAL)
            .repartition(parts, "cluster_id")
            .groupBy("cluster_id")
            .applyInArrow(_add_sums, PARTIAL)
        )
    found = partial.toArrow()
    shared.unpersist()
    counts, sums = np.zeros(len(centers)), np.zeros(centers.shape)
    cluster = found["cluster_id"].to_numpy()
    np.add.at(counts, cluster, found["n"].to_numpy())
    if len(cluster):
        np.add.at(sums, cluster, blocks.doubles(found["sums"], width))
    return counts, sums, float(found["cost"].to_numpy().sum())


def _add_sums(parts):
    """Partial sums of one cluster as one row, added up array by array."""
    width = len(parts["sums"][0])
    sums = blocks.doubles(parts["sums"], width).sum(axis=0)
    return pa.table(
        {
            "cluster_id": pa.array([parts["cluster_id"][0].as_py()], pa.int32()),
            "n": pa.array([int(parts["n"].to_numpy().sum())], pa.int64()),
            "cost": pa.array([float(parts["cost"].to_numpy().sum())]),
            "sums": pa.array([sums], pa.list_(pa.float64())),
        }
    )


def _least_hashes(rows, k):
    """``k`` different rows by a hash, numbered from 0: ``(cluster_id, center)``."""
    key = F.xxhash64("features", F.lit(SEED)).alias("key")
    distinct = rows.select(key, "features").distinct()
    kinds = distinct.count()
    if kinds > k:
        # Hashes are spread evenly, so a share of their range holds about a share of the rows.
        share = min(1.0, 1.1 * k / kinds + 100 / kinds)
        bound = int((share - 0.5) * 2**64)
        some = distinct.filter(F.col("key") < F.lit(min(bound, 2**63 - 1)))
        distinct = some if some.count() >= k else distinct
    placed = with_row_id(distinct.groupBy("key").agg(F.min("features").alias("center")), "key", "place")
    return placed.filter(F.col("place") < k).select(F.col("place").cast("int").alias("cluster_id"), F.col("center").cast("array<double>").alias("center"))


def lloyd(
    df,
    centers,
    max_iter=DEFAULT_ITERATIONS,
    tol=DEFAULT_TOLERANCE,
    features="features",
    rows_width=None,
    broadcast_bytes=BROADCAST_BYTES,
):
    """Fit from given centres; the result depends on nothing but the rows.

    ``centers`` is an array, or a table ``(cluster_id, center)`` of ids from 0. The
    features are written once, so joins and parsing before them are not repeated.
    Each pass reads them once, sums them per cluster inside the tasks and brings
    back one row per cluster. It stops after ``max_iter`` passes or when no centre
    moves further than ``tol``; a cluster that loses all rows keeps its centre.

    Centres of more than ``broadcast_bytes`` stay a table: rows find theirs by the
    block search, sums go by cluster through a shuffle, and the centres of the next
    pass are written. Both ways give the same centres but for the order of sums.
    """
    _, width = rows_width or training_shape(df, features)
    if isinstance(centers, DataFrame):
        shape = centers.agg(F.count("*").alias("n"), F.min(F.size("center")).alias("low"), F.max(F.size("center")).alias("high"))
        n, low, high = shape.first()
        fits = n and low == high == width
    else:
        centers = np.asarray(centers, dtype=np.float64)
        n, fits = len(centers), centers.ndim == 2 and centers.shape[1] == width
    if n < 1:
        raise ValueError(f"the number of clusters must be at least 1, not {n}")
    if not fits:
        raise ValueError(f"centres must have {width} columns")
    rows = df.select(of_width(features, width).alias("features"))
    with scratch(df.sparkSession):
        if n * point_bytes(width) > broadcast_bytes:
            if not isinstance(centers, DataFrame):
                centers = _center_table(df.sparkSession, centers)
            return _stored_passes(written_table(rows, "kmeans-rows"), centers, n, width, max_iter, tol, broadcast_bytes)
        if isinstance(centers, DataFrame):
            held = centers.orderBy("cluster_id").toArrow()
            centers = blocks.doubles(held["center"], width)
        if max_iter <= 1:
            return _passes(rows, centers, width, max_iter, tol)
        rows = written_table(rows, "kmeans-rows")
        return _passes(rows, centers, width, max_iter, tol, _tasks(rows))


def _center_table(spark, centers):
    ids = pa.array(np.arange(len(centers)), pa.int32())
    return spark.createDataFrame(pa.table({"cluster_id": ids, "center": pa.array(list(centers), pa.list_(pa.float64()))}))


def _point_table(centers, n, width, broadcast_bytes):
    ids = [F.col("cluster_id").cast("long").alias("train_id"), F.col("cluster_id").alias("label")]
    return PointSet(centers.select(*ids, F.col("center").alias("features")), n, width, broadcast_bytes)


def _means(found, width):
    """The mean of each cluster's rows, (cluster_id, mean)."""
    if width <= UNROLL_WIDTH:
        mean = F.array(*[F.avg(F.col("features")[i].cast("double")) for i in range(width)]).alias("mean")
        return found.groupBy(F.col("prediction").alias("cluster_id")).agg(mean)
    cells = found.select(F.col("prediction").alias("cluster_id"), F.posexplode("features").alias("at", "x"))
    each = cells.groupBy("cluster_id", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "x")))
    return each.groupBy("cluster_id").agg(F.transform(ordered, lambda s: s["x"]).alias("mean"))


def _stored_passes(rows, centers, n, width, max_iter, tol, broadcast_bytes):
    """Passes with the centres as a table; only it, and not the driver, grows with them."""
    spark, done = rows.sparkSession, 0
    folder = shared_folder(spark, "centres")
    centers.select("cluster_id", "center").write.parquet(folder)
    gap = F.aggregate(
        F.zip_with("center", "next", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x
    )
    while done < max_iter:
        centers = spark.read.parquet(folder)
        points = _point_table(centers, n, width, broadcast_bytes)
        means = _means(_assigned(rows, points, "features"), width)
        following = shared_folder(spark, "centres")
        moved = centers.join(means, "cluster_id", "left")
        moved.select("cluster_id", "center", F.coalesce("mean", "center").alias("next")).write.parquet(following + "-moved")
        points.release()
        moved = spark.read.parquet(following + "-moved")
        shift = moved.agg(F.max(F.sqrt(gap)).alias("shift")).first()["shift"]
        moved.select("cluster_id", F.col("next").alias("center")).write.parquet(following)
        for path in (folder, following + "-moved"):
            remove_folder(spark, path)
        folder, done = following, done + 1
        if shift <= tol:
            break
    centers = spark.read.parquet(folder)
    points = _point_table(centers, n, width, broadcast_bytes)
    with scratch(spark):
        cost = _assigned(rows, points, "features").agg(F.sum("distance").alias("cost")).first()["cost"]
    return StoredCentroidModel(centers, folder, points, float(cost), done)


def _tasks(written):
    """The splits of a written table, which its plan counts without a job."""
    return written.rdd.getNumPartitions()


def _passes(rows, centers, width, max_iter, tol, tasks=None):
    done = 0
    while done < max_iter:
        counts, sums, cost = _cluster_sums(rows, centers, width, tasks)
        filled = counts > 0
        moved = centers.copy()
        moved[filled] = sums[filled] / counts[filled, None]
        shift = np.sqrt(((moved - centers) ** 2).sum(axis=1)).max()
        still = np.array_equal(moved, centers)
        centers, done = moved, done + 1
        if shift <= tol:
            # The pass was over these centres if none has moved.
            return CentroidModel(centers, cost if still else _cluster_sums(rows, centers, width, tasks)[2], done)
    return CentroidModel(centers, _cluster_sums(rows, centers, width, tasks)[2], done)
