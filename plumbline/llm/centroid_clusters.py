"""Centroid clustering on whole numbers, with nearest centroids by a bisector tournament."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from plumbline.llm import vectors
from plumbline.llm.arrow import column, free_of

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 16, 3, 64, 64, "1:"
RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


class Tournament:
    """Finds the nearest of some centroids, lists of whole numbers, by k - 1 sign tests.

    The bisector of each pair of centroids has a normal and a threshold, whole
    numbers that are computed once. The side of it that a row lies on tells which of
    the two is further away and out; a row on the bisector stays with the smaller
    number. The distance is computed for the last one left.
    """

    def __init__(self, centroids, width):
        self.exact = np.array(centroids, dtype=object).reshape(len(centroids), width)
        self.small = bool((abs(self.exact) <= vectors.small_bound(width)).all())
        self.sides = {}

    def bisectors(self, kind):
        if kind not in self.sides:
            c = self.exact.astype(kind)
            norms = (c * c).sum(axis=1)
            self.sides[kind] = c, 2 * (c[None, :, :] - c[:, None, :]), norms[None, :] - norms[:, None]
        return self.sides[kind]

    def nearest(self, rows):
        """Number of the nearest centroid of each row, and the squared distance."""
        c, normals, thresholds = self.bisectors(rows.dtype)
        left = np.zeros(len(rows), np.int64)
        for other in range(1, len(c)):
            beyond = (normals[left, other] * rows).sum(axis=1) > thresholds[left, other]
            left[beyond.astype(bool)] = other
        gap = rows - c[left]
        return left, (gap * gap).sum(axis=1)


def _sums(centroids, width, scale):
    """Per task and cluster: rows, distances and components, summed."""

    def run(batches):
        tournament = Tournament(centroids, width)
        sums = {}
        for batch in batches:
            for _, rows in vectors.integer_rows(batch.column(0), width, scale, tournament.small):
                cluster, distance = tournament.nearest(rows)
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    new = [int(own.sum()), vectors.exact_sum(distance[own]), *map(int, rows[own].sum(axis=0))]
                    sums[c] = [a + b for a, b in zip(sums[c], new)] if c in sums else new
        yield vectors.sums_batch(sums)

    return run


def _assigned(centroids, width, scale):
    def run(batches):
        tournament = Tournament(centroids, width)
        for batch in batches:
            clusters, distances = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, object)
            for at, rows in vectors.integer_rows(batch.column(1), width, scale, tournament.small):
                clusters[at], distances[at] = tournament.nearest(rows)
            columns = [batch.column(0), pa.array(clusters), vectors.longs(distances)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "cluster", "distance"])

    return run


def moved(centroids, sums):
    """Each centroid at the floor of its rows' mean; one without rows stays."""
    return [
        [s // sums[c][0] for s in sums[c][2:]] if c in sums else centroid for c, centroid in enumerate(centroids)
    ]


def fit_centroids(df, vector, usable, first, clusters, rounds, width, scale):
    """The centroids after all rounds, from the vectors that ``first`` puts first."""
    start = df.filter(usable).orderBy(*first).limit(clusters).select(vector.alias("v")).collect()
    centroids = [vectors.integers_of(r["v"], scale) for r in start]
    for _ in range(rounds if centroids else 0):
        centroids = moved(centroids, vectors.totals(df, vector, usable, _sums(centroids, width, scale)))
    return centroids


def cluster_vectors(
    df,
    vec_id="vec_id",
    vector="embedding",
    clusters=CLUSTERS,
    rounds=ROUNDS,
    width=WIDTH,
    scale=SCALE,
    seed=SEED,
    carry=None,
):
    """The usable rows of ``df`` with cluster, distance, cluster_inertia, inertia and centroid_sha256.

    A vector is usable with exactly ``width`` components, all of them finite numbers;
    a component x counts as the whole number floor(``scale`` * x). The centroids
    start as the vectors with the least SHA-256 of ``seed`` and the id. In each
    round every vector goes to its nearest centroid, by squared distance and then
    number, and a centroid with vectors moves to the floor of their mean. distance is
    that to the last centroid, summed over its cluster and over all rows in the two
    inertias; centroid_sha256 is of its components, joined by commas.

    Each round reads the table once; tasks give one row for each cluster, which are
    added without meeting in one task. Only centroids, ``clusters`` times ``width``
    numbers, reach the driver; a task holds ``clusters`` squared times ``width``
    numbers. Nothing is written, and rows never move to another task.

    Rows with a null, shorter, longer or unusable vector are left out. Rows with
    null id count, and are the last to start a centroid; repeated rows count each,
    and equal ids are started with in the order of their vectors. With fewer
    vectors than ``clusters`` there are fewer centroids. Components of any size are
    exact; a distance or sum that is no 64-bit number is null. Columns with names
    of results give way, and an empty table gives an empty one.
    """
    values, key = column(vector), column(vec_id)
    usable = vectors.finite(values) & (F.size(values) == width)
    kept = free_of(df.columns if carry is None else carry, RESULTS)
    digest = F.sha2(F.concat(F.lit(seed), key.cast("string")), 256)
    first = [digest.asc_nulls_last(), values]
    centroids = fit_centroids(df, values, usable, first, clusters, rounds, width, scale)
    fields = [("cluster", IntegerType()), ("distance", LongType())]
    found = vectors.scanned(df, values, usable, kept, _assigned(centroids, width, scale), fields)
    sums = vectors.totals(df, values, usable, _sums(centroids, width, scale)) if centroids else {}
    costs = [sums[c][1] if c in sums else 0 for c in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    each = F.get(F.array(*[_long(c) for c in costs]).cast("array<long>"), F.col("cluster"))
    digests = F.get(F.array(*map(F.lit, names)).cast("array<string>"), F.col("cluster"))
    shown = [column(k) for k in kept]
    return found.select(
        *shown,
        "cluster",
        "distance",
        each.alias("cluster_inertia"),
        _long(sum(costs)).alias("inertia"),
        digests.alias("centroid_sha256"),
    )


def _long(n):
    return F.lit(n if n <= vectors.LONGEST else None).cast("long")
