"""Exact nearest-neighbour search of one table's rows in another.

A reference table within ``BROADCAST_BYTES`` is sent to every task and the
search is one projection over the queries: no shuffle, and it works on streams.

A larger one is stored once, by cells: each reference row goes to its nearest pivot,
a cell is cut into pieces of bounded size by a hash of the row id, pieces in a row make
a block, and the table is bucketed by block. A search moves queries only, once for each
block, of which there are few for each core until one would be larger than
``BLOCK_BYTES``. Each query first visits its home cell,
which gives it k neighbours and so an upper bound of its k-th distance; the triangle
inequality bounds its distance to any other cell from below, and only pieces of cells
that can hold a neighbour are visited then. A block that very many queries visit is dealt
to several tasks, with a copy of the block for each. Blocks emit k rows per query, never
all pairs.

Both ways answer every row by itself: queries get an id of their own, so rows with
equal, null or no ids are told apart, and a row without neighbours stays.
"""

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import blocks
from plumbline.functions.vectors import of_width
from plumbline.session import remove_folder, scratch, shared_folder, written_folder, written_table

BROADCAST_BYTES = 64 << 20
BLOCK_BYTES = 32 << 20
#: Cells of a reference: so many rows each at least, and so many cells until a cell would
#: hold more than ``CELL_ROWS``; never more than the sample.
LEAST_CELL_ROWS, FINE_CELLS, CELL_ROWS = 64, 128, 1_000_000
SAMPLE_ROWS = 2048
#: Sampled rows that show whether cells spare queries more than this share of the rows.
PROBE_ROWS, FEW_MET = 256, 0.5
COPY_PARTS = 64
MIN_BLOCK_ROWS = 16
BLOCKS_PER_CORE = 2
BLOCKS_PER_BUCKET, MOST_BUCKETS = 8, 100_000
#: Queries that meet one block in one task.
ASKED_ROWS = 100_000
SPREAD_ROWS = 10_000
WORK_PER_TASK = 4 << 30
BOUND_SLACK = 1e-9

NEIGHBOR = "struct<distance:double,train_id:bigint,label:int>"
NEIGHBOR_ROWS = "query_id long, distance double, train_id long, label int"


def point_bytes(width):
    """The bound of one point's size in a broadcast."""
    return 8 * width + 16


@dataclass
class PointSet:
    """Reference points as ``(train_id, label, features)`` rows."""

    table: DataFrame
    rows: int
    width: int
    broadcast_bytes: int = BROADCAST_BYTES
    block_bytes: int = BLOCK_BYTES
    shared: dict[int, Broadcast] = field(default_factory=dict, repr=False)
    stored: dict = field(default_factory=dict, repr=False)
    folders: list[str] = field(default_factory=list, repr=False)
    tables: list[str] = field(default_factory=list, repr=False)
    compared: int = 0

    @classmethod
    def of_centers(cls, spark, centers, **limits):
        """Points numbered by position, as for centroids."""
        values = pa.array(list(np.asarray(centers, dtype=np.float64)), pa.list_(pa.float64()))
        ids = np.arange(len(values))
        table = pa.table({"train_id": ids, "label": ids.astype(np.int32), "features": values})
        return cls(spark.createDataFrame(table), len(ids), len(values[0]), **limits)

    @property
    def row_bytes(self):
        return point_bytes(self.width)

    @property
    def fits_broadcast(self):
        return self.rows * self.row_bytes <= self.broadcast_bytes

    def index(self, k):
        """The reference by cells and blocks, stored once for all searches of k neighbours."""
        if ("index", k) not in self.stored:
            self.stored["index", k] = _stored_index(self, k)
        return self.stored["index", k]

    def release(self):
        """Removes what was stored and broadcast for searches; the next one makes it anew."""
        spark = self.table.sparkSession
        for name in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in self.folders:
            remove_folder(spark, path)
        for block in self.shared.values():
            block.unpersist()
        for held in (self.folders, self.tables, self.shared, self.stored):
            held.clear()

    def local(self, k):
        """Ids, labels and matrix of all points, shared with every task once."""
        if k not in self.shared:
            ids, labels, values = _local(self.table, self.width)
            keep = blocks.limit_copies(ids, values, k)
            block = (ids[keep], labels[keep], values[keep])
            self.shared[k] = self.table.sparkSession.sparkContext.broadcast({"points": block})
        return self.shared[k]


def _local(table, width):
    """A table of proven size on the driver, by ascending id."""
    return _by_id(table.select("train_id", "label", "features").toArrow(), width)


def _by_id(table, width):
    ids = table["train_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    labels = table["label"].to_numpy().astype(np.int32)
    return ids[order], labels[order], blocks.matrix(table["features"], width)[order]


def _search_udf(shared, width, k):
    @F.arrow_udf(f"array<{NEIGHBOR}>")
    def search(features: pa.Array) -> pa.Array:
        points = blocks.Points.shared(shared)
        distances, found = blocks.nearest(blocks.doubles(features, width), points, k)
        used = found >= 0
        offsets = np.concatenate([[0], np.cumsum(used.sum(axis=1))]).astype(np.int32)
        at = found[used]
        rows = pa.StructArray.from_arrays(
            [pa.array(distances[used]), pa.array(points.ids[at]), pa.array(points.labels[at])],
            names=["distance", "train_id", "label"],
        )
        return pa.ListArray.from_arrays(offsets, rows)

    return search


def _spread(df, points):
    """More tasks for a search that is heavy for its input size."""
    work_per_row = points.rows * points.width
    if df.isStreaming or points.rows < SPREAD_ROWS:
        return df
    tasks = df.count() * work_per_row // WORK_PER_TASK
    return df.repartition(int(tasks)) if tasks > 1 else df


def with_neighbors(df, points, k, features="features", name="neighbors"):
    """The k nearest points of each row as an array ordered by distance, then id."""
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    if points.fits_broadcast:
        search = _search_udf(points.local(k), points.width, k)
        return _spread(df, points).withColumn(name, search(of_width(features, points.width)))
    if df.isStreaming:
        raise ValueError("this reference table needs a shuffle: score the stream by foreachBatch")
    asked = df.select(
        F.monotonically_increasing_id().alias("query_id"),
        of_width(features, points.width).alias("features"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
    )
    visiting, hits = _search_blocks(asked, points, k)
    found = hits.groupBy("query_id").agg(F.sort_array(F.collect_list("hit")).alias("found"))
    none = F.array().cast(f"array<{NEIGHBOR}>")
    rows = visiting.select("query_id", "row").join(found, "query_id", "left")
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != name]
    return rows.select(*kept, F.coalesce("found", none).alias(name))


def nearest_neighbors(df, points, k, features="features", query_id="row_id"):
    """One row per query and neighbour: id, rank from 1, neighbour id, distance, label."""
    found = with_neighbors(df, points, k, features)
    hits = found.select(query_id, F.posexplode("neighbors").alias("rank", "hit"))
    return hits.select(query_id, (F.col("rank") + 1).alias("rank"), "hit.*")


def _hash(column, modulus):
    return F.pmod(F.xxhash64(column), modulus).cast("int")


def _sample(points):
    """A bounded set of reference rows, the same one on every run."""
    rows = max(1, min(SAMPLE_ROWS, points.block_bytes // points.row_bytes))
    stride = points.rows // (4 * rows)
    some = points.table
    if stride > 1:
        some = some.filter(_hash("train_id", F.lit(stride)) == 0)
    return _local(some.orderBy(F.xxhash64("train_id"), "train_id").limit(rows), points.width)[2]


def _cell_udf(shared, width):
    @F.arrow_udf("struct<cell:int,radius:double>")
    def assign(features: pa.Array) -> pa.Array:
        pivots = blocks.Points.shared(shared, "pivots")
        distances, cells = blocks.nearest(blocks.doubles(features, width), pivots, 1)
        return pa.StructArray.from_arrays(
            [pa.array(cells[:, 0].astype(np.int32)), pa.array(np.sqrt(distances[:, 0]))],
            names=["cell", "radius"],
        )

    # Else Spark infers a null filter on the result and runs the search for it, too.
    return assign.asNondeterministic()


def numbered(values):
    """Ids, labels and values of points that are numbered by position."""
    ids = np.arange(len(values))
    return ids, ids, values


def _gaps(queries, pivots):
    gaps = np.empty((len(queries), len(pivots)))
    with np.errstate(invalid="ignore", over="ignore"):
        for j, pivot in enumerate(pivots):
            step = queries - pivot
            gaps[:, j] = np.sqrt(np.einsum("ij,ij->i", step, step))
    return gaps


@dataclass
class Index:
    """The stored reference, one bucketed table, and what routes queries to its blocks.

    Cell i has the pieces from ``first[i]`` on, ``counts[i]`` of them, and all its rows
    within ``radii[i]`` of pivot i, -1 where it has none. A block is ``pieces`` pieces in a
    row; ``sizes`` has the mean rows of a piece of each block.
    """

    table: DataFrame
    buckets: int
    pieces: int
    shared: Broadcast
    sizes: np.ndarray

    def route(self, features, width, k):
        """For each query the pieces of its home cell, and of other cells with a lower bound."""
        return _route_udf(self.shared, width, k)(features)


def _pivots(sample, rows, k):
    """Distinct sampled rows as pivots: many, if some of the sample show that this spares
    queries most rows, else one."""
    distinct = sample[blocks.limit_copies(np.arange(len(sample)), sample, 1)].astype(np.float64)
    fine = min(len(distinct), rows // LEAST_CELL_ROWS, max(FINE_CELLS, rows // CELL_ROWS))
    if fine < 2:
        return distinct[:1]
    every = blocks.Points(*numbered(sample.astype(np.float64)))
    reach = np.sqrt(blocks.nearest(every.values[:PROBE_ROWS], every, min(k + 1, len(sample)))[0][:, -1])
    gaps = _gaps(every.values, distinct[:fine])
    known = ~np.isnan(gaps).any(axis=1)
    cell = np.where(np.isnan(gaps), np.inf, gaps).argmin(axis=1)
    radii, sizes = np.zeros(fine), np.bincount(cell, minlength=fine)
    np.maximum.at(radii, cell[known], gaps[known, cell[known]])
    with np.errstate(invalid="ignore"):
        met = ~(gaps[:PROBE_ROWS] - radii > reach[:, None])
    spared = 1 - (met @ sizes).mean() / len(sample)
    return distinct[:fine] if spared > 1 - FEW_MET else distinct[:1]


def _stored_index(points, k):
    """Writes the rows that can be among the k nearest of a query, bucketed by block.

    Copies of a point beyond the k lowest ids lose every tie. They are dropped in
    parts of a hot point first, so no task ranks all of its copies.
    """
    spark, width = points.table.sparkSession, points.width
    part = F.pmod(F.xxhash64("train_id"), F.lit(COPY_PARTS))
    rows = points.table
    for keys in (["features", part], ["features"]):
        copies = Window.partitionBy(*keys).orderBy("train_id")
        rows = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k).drop("copy")
    sample = _sample(points)
    pivots = _pivots(sample, points.rows, k)
    held = {"sample": numbered(sample.astype(np.float64)), "pivots": numbered(pivots)}
    shared = spark.sparkContext.broadcast(held)
    with scratch(spark):
        placed = rows.withColumn("at", _cell_udf(shared, width)("features"))
        placed = written_table(placed.select("train_id", "label", "features", "at.*"), "reference")
        cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("r")).collect()
        sizes, radii = np.zeros(len(pivots), np.int64), np.full(len(pivots), -1.0)
        for row in cells:
            sizes[row["cell"]] = row["n"]
            radii[row["cell"]] = np.inf if np.isnan(row["r"]) else row["r"]
        slots = BLOCKS_PER_CORE * spark.sparkContext.defaultParallelism
        piece_rows = max(MIN_BLOCK_ROWS, min(points.block_bytes // points.row_bytes, -(-int(sizes.sum()) // slots)))
        counts = -(-sizes // piece_rows)
        first = np.cumsum(counts) - counts
        pieces = int(max(1, min(counts.sum() // slots, BLOCK_BYTES // (piece_rows * points.row_bytes))))
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = int(min(MOST_BUCKETS, max(least, counts.sum() // pieces // BLOCKS_PER_BUCKET)))
        cut = pa.table({"cell": pa.array(np.arange(len(pivots)), pa.int32()), "first": pa.array(first, pa.int32()), "count": pa.array(counts, pa.int32())})
        # One row for each pivot, of which the sample bounds the number.
        piece = (F.col("first") + _hash("train_id", F.col("count"))).cast("int").alias("piece")
        blocked = placed.join(F.broadcast(spark.createDataFrame(cut)), "cell").select(piece, "train_id", "label", "features")
        blocked = blocked.withColumn("block", _block_of(F.col("piece"), pieces))
        name, path = f"plumbline_points_{uuid.uuid4().hex}", shared_folder(spark, "points")
        stored = blocked.repartition(buckets, "block").write.format("parquet").bucketBy(buckets, "block")
        stored.option("path", path).saveAsTable(name)
    points.tables.append(name)
    points.folders.append(path)
    piece_sizes = np.repeat(-(-sizes // np.maximum(counts, 1)), counts)
    block = np.arange(len(piece_sizes)) // pieces
    block_sizes = np.bincount(block, weights=piece_sizes) / np.bincount(block)
    routes = spark.sparkContext.broadcast(held | {"radii": radii, "first": first, "counts": counts})
    shared.unpersist()
    return Index(spark.table(name), buckets, pieces, routes, block_sizes)


def _block_of(piece, pieces):
    return (piece / F.lit(pieces)).cast("int")


def _route_udf(shared, width, k):
    @F.arrow_udf("struct<reach:double,home:struct<first:int,count:int>,others:array<struct<low:double,first:int,count:int>>>")
    def route(features: pa.Array) -> pa.Array:
        held = shared.value
        sample, pivots = (blocks.Points.shared(shared, name) for name in ("sample", "pivots"))
        radii, first, counts = held["radii"], held["first"], held["counts"]
        queries = blocks.doubles(features, width)
        reach = np.sqrt(blocks.nearest(queries, sample, k)[0][:, -1])
        gaps = _gaps(queries, pivots.values)
        with np.errstate(invalid="ignore", over="ignore"):
            low = gaps - radii - BOUND_SLACK * (gaps + radii + reach[:, None])
            far = (low > reach[:, None]) | (radii < 0)
        low[np.isnan(low)] = -np.inf
        home = np.where(np.isnan(gaps) | (radii < 0), np.inf, gaps).argmin(axis=1)
        far[np.arange(len(home)), home] = True
        used, cells = np.nonzero(~far)
        offsets = np.searchsorted(used, np.arange(len(queries) + 1)).astype(np.int32)
        others = pa.StructArray.from_arrays(
            [pa.array(low[used, cells]), pa.array(first[cells], pa.int32()), pa.array(counts[cells], pa.int32())],
            names=["low", "first", "count"],
        )
        homes = pa.StructArray.from_arrays(
            [pa.array(first[home], pa.int32()), pa.array(counts[home], pa.int32())], names=["first", "count"]
        )
        columns = [pa.array(reach), homes, pa.ListArray.from_arrays(offsets, others)]
        return pa.StructArray.from_arrays(columns, names=["reach", "home", "others"])

    return route.asNondeterministic()


def _runs(pieces, query, low, high):
    """Pieces in a row that the same queries visit, with these."""
    held, run = None, []
    for piece in pieces:
        asking = query[(low <= piece) & (piece < high)]
        if run and not np.array_equal(asking, held):
            yield held, run
            run = []
        held = asking
        run.append(piece)
    if run:
        yield held, run


def _block_search(width, k):
    def search(queries: pa.Table, reference: pa.Table) -> pa.Table:
        asked = queries["query_id"].to_numpy()
        ids, labels, values = _by_id(reference, width)
        # Unused places hold the position after the last.
        found = np.full((len(asked), k), len(ids))
        distances = np.full((len(asked), k), np.inf)
        if len(asked) and len(ids):
            features = blocks.doubles(queries["features"], width)
            piece = reference["piece"].to_numpy()[np.argsort(reference["train_id"].to_numpy(), kind="stable")]
            ranges = queries["ranges"].combine_chunks()
            query = np.repeat(np.arange(len(asked)), np.diff(ranges.offsets.to_numpy()))
            low, count = (ranges.flatten().field(n).to_numpy() for n in ("first", "count"))
            for some, run in _runs(np.unique(piece), query, low, low + count):
                if not len(some):
                    continue
                rows = np.flatnonzero(np.isin(piece, run))
                points = blocks.Points(ids[rows], labels[rows], values[rows])
                new, at = blocks.nearest(features[some], points, k)
                at = np.where(at >= 0, rows[at], len(ids))
                both = np.hstack([distances[some], new]), np.hstack([found[some], at])
                best = np.lexsort(both[::-1], axis=1)[:, :k]
                distances[some], found[some] = (np.take_along_axis(x, best, 1) for x in both)
        used = found < len(ids)
        at = found[used]
        return pa.table(
            {
                "query_id": np.repeat(asked, used.sum(axis=1)),
                "distance": distances[used],
                "train_id": ids[at],
                "label": labels[at],
            }
        )

    return search


def _visits(queries, ranges, index):
    """A row for each block of the pieces in ``ranges``, with those of its ranges."""
    ends = [lambda r: r["first"], lambda r: r["first"] + r["count"] - 1]
    at = F.transform(ranges, lambda r: F.sequence(*[_block_of(end(r), index.pieces) for end in ends]))
    each = queries.select("query_id", "features", ranges.alias("ranges"), F.explode(F.array_distinct(F.flatten(at))).alias("block"))
    return each.withColumn("ranges", F.filter("ranges", lambda r: _met(r, index) > 0))


def _met(r, index):
    """How many pieces of the row's block are in a range."""
    start = F.col("block") * index.pieces
    return F.least(r["first"] + r["count"], start + index.pieces) - F.greatest(r["first"], start)


def _visited(asked, index, points, k):
    """The k best hits of each query in each block that it visits, (query_id, hit).

    ``asked`` has query_id, features, block and the ranges of pieces to search there, all
    of them if there is no such column. The blocks stay where they are; one that more than
    ``ASKED_ROWS`` queries visit is copied for each part of these.
    """
    spark, search = asked.sparkSession, _block_search(points.width, k)
    if "ranges" not in asked.columns:
        every = F.struct((F.col("block") * index.pieces).alias("first"), F.lit(index.pieces).alias("count"))
        asked = asked.withColumn("ranges", F.array(every))
    met = F.aggregate("ranges", F.lit(0), lambda n, r: n + _met(r, index))
    counts = asked.groupBy("block").agg(F.count("*").alias("count"), F.sum(met).alias("pieces")).toArrow()
    at, numbers = counts["block"].to_numpy(), counts["count"].to_numpy()
    points.compared += int((counts["pieces"].to_numpy() * index.sizes[at]).sum())
    hot = numbers > ASKED_ROWS
    cold_asked, cold = asked, index.table
    found = []
    if hot.any():
        parts = pa.table({"block": pa.array(at[hot], pa.int32()), "parts": pa.array(-(-numbers[hot] // ASKED_ROWS), pa.int32())})
        # One row for each block that fills several tasks with queries; a table of its own for
        # each side of the co-group, whose columns must not be the same.
        ours, theirs = (F.broadcast(spark.createDataFrame(parts)) for _ in range(2))
        several = asked.join(ours, "block").withColumn("part", _hash("query_id", F.col("parts"))).drop("parts")
        copies = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        copied = index.table.join(theirs, "block").withColumn("part", copies).drop("parts")
        pairs = several.groupBy("block", "part").cogroup(copied.groupBy("block", "part"))
        found.append(pairs.applyInArrow(search, NEIGHBOR_ROWS))
        cold_asked = asked.join(ours, "block", "left_anti")
    met = cold_asked.repartition(index.buckets, "block").groupBy("block").cogroup(cold.groupBy("block"))
    found.append(met.applyInArrow(search, NEIGHBOR_ROWS))
    hits = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return hits.select("query_id", F.struct("distance", "train_id", "label").alias("hit"))


def _best(hits, k):
    order = Window.partitionBy("query_id").orderBy("hit")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def _search_blocks(queries, points, k):
    """The queries, stored, and the best hits of each: of the home cell first, then of
    the cells that can hold a nearer row."""
    index = points.index(k)
    routed = queries.withColumn("route", index.route(F.col("features"), points.width, k))
    queries = _kept(points, routed.select(*queries.columns, "route.*"), "queries")
    at_home = _visits(queries, F.array("home"), index)
    first = _best(_visited(at_home, index, points, k), k).groupBy("query_id").agg(F.collect_list("hit").alias("hits"))
    first = _kept(points, first, "home-hits")
    known = F.when(F.size("hits") == k, F.sqrt(F.array_max(F.transform("hits", lambda h: h["distance"]))))
    bounds = first.select("query_id", known.alias("known"))
    further = queries.filter(F.size("others") > 0).join(bounds, "query_id", "left")
    reach = F.least("reach", F.coalesce("known", F.lit(float("inf"))))
    near = F.filter("others", lambda c: c["low"] <= F.col("bound"))
    near = F.transform(near, lambda c: F.struct(c["first"].alias("first"), c["count"].alias("count")))
    further = further.withColumn("bound", reach).select("query_id", "features", near.alias("near"))
    further = _kept(points, _visits(further, F.col("near"), index), "visits")
    hits = first.select("query_id", F.explode("hits").alias("hit"))
    if not further.isEmpty():
        hits = _best(hits.unionByName(_visited(further, index, points, k)), k)
    return queries, hits


def _kept(points, df, name):
    """A table of one search, removed by ``release`` or at the end of a ``scratch`` block."""
    points.folders.append(written_folder(df, name))
    return df.sparkSession.read.parquet(points.folders[-1])
