"""Trees of any depth or number of leaves, grown best leaf first.

Rows are binned once. Each pass over them sums, in Spark, histograms of the leaves
that are looked at next, and the driver gets the best split of each. Nodes are
numbered in their tree, so a path of any length costs no more than another.
"""

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import functions as F

from plumbline.functions import blocks
from plumbline.functions.vectors import of_width
from plumbline.session import scratch, written_table

BINS = 128
SEED = 42
#: Rows, by hash, and values that the bins are cut from.
SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 4_000_000
#: Memory of the histograms that a task sums in one pass, and of the votes that it counts at once.
HISTOGRAM_BYTES, VOTE_BYTES = 32 << 20, 32 << 20
#: Histograms of one leaf meet in so many groups of tasks first, then in one row.
MERGE_TREE = 64
LEAST_GAIN = 1e-9
#: Leading bits of a random number that settle most draws by a table.
GUIDE_BITS = 12
SPLITS = "unit int, feature int, bin int, gain double, left array<long>, right array<long>"


def mixed(x):
    """A bijection of 64-bit numbers that spreads every bit over all of them."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def key_of(*numbers):
    """One 64-bit number that depends on all of them and their order."""
    key = np.uint64(SEED)
    for n in numbers:
        key = mixed(key ^ mixed(np.asarray(n).astype(np.uint64) + np.uint64(1)))
    return key


def poisson(rate):
    """Chances that a draw is at most 0, 1, 2, ..."""
    terms = [np.exp(-rate)]
    while terms[-1] > 1e-18 or len(terms) < rate:
        terms.append(terms[-1] * rate / len(terms))
    return np.cumsum(terms)[:-1]


def spread(seeds):
    """The rows' part of their random numbers, which is the same for all trees."""
    return mixed(np.asarray(seeds).astype(np.uint64) + np.uint64(1))


def guide(chances):
    """Draws by the leading bits of a random number, -1 where more bits are needed."""
    edges = np.arange((1 << GUIDE_BITS) + 1) / (1 << GUIDE_BITS)
    low, high = np.searchsorted(chances, edges[:-1], "right"), np.searchsorted(chances, edges[1:], "left")
    return np.where(low == high, low, -1)


def drawn_rows(spread_seeds, tree, chances, guided):
    """``draws`` from what ``spread`` and ``guide`` give."""
    numbers = mixed(key_of(tree) ^ spread_seeds)
    found = guided[(numbers >> np.uint64(64 - GUIDE_BITS)).view(np.int64)]
    more = np.flatnonzero(found < 0)
    found[more] = np.searchsorted(chances, (numbers[more] >> np.uint64(11)) / float(1 << 53), "right")
    return found


def draws(seeds, tree, chances):
    """How often a tree draws each row for its sample: numbers of the rows' seeds only."""
    return drawn_rows(spread(seeds), tree, chances, guide(chances))


def group_draws(seeds, rates, trees):
    """How often each of the trees draws from each group of equal rows, all rows of it together.

    A row's draws are a Poisson number, and those of many rows add up to a Poisson number
    of the sum of their rates. Numbers depend on the seed and rate of the group only, and
    those of a tree not on how many more trees there are.
    """
    found = [np.random.default_rng(int(s)).poisson(r, trees) for s, r in zip(key_of(seeds), rates)]
    return np.array(found, np.int64).reshape(len(found), trees).T


def alike(rows):
    """The first place of each different row of a matrix, and for every row which of them it equals.

    Rows are told apart byte by byte, by a hash of their bytes first.
    """
    size = rows.shape[1] * rows.itemsize
    words = np.zeros((len(rows), -(-size // 8) * 8), np.uint8)
    words[:, :size] = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), size)
    words = words.view(np.uint64)
    key = words[:, 0]
    for i in range(1, words.shape[1]):
        key = mixed(key) ^ words[:, i]
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    if not np.array_equal(words[first][which], words):
        first = which = np.arange(len(rows))
    return first, which


def columns_of(tree, node, width, taken):
    """The columns that may split a node, in order."""
    if taken >= width:
        return np.arange(width)
    return np.sort(np.argsort(key_of(tree, node, np.arange(width)), kind="stable")[:taken])


def bin_cuts(values, bins):
    """Values that cut a column into bins, x <= cut going left, from a sample of it.

    NaN goes right at every cut; where there is any, the last one parts it from all else.
    """
    known = np.sort(values[~np.isnan(values)])
    distinct = np.unique(known)
    last = distinct[-1:] if len(known) < len(values) else distinct[:0]
    if len(distinct) > bins:
        return np.unique(np.concatenate([known[[len(known) * i // bins for i in range(1, bins)]], last]))
    with np.errstate(invalid="ignore", over="ignore"):
        middle = distinct[:-1] / 2 + distinct[1:] / 2
    inside = (distinct[:-1] <= middle) & (middle < distinct[1:])
    return np.concatenate([np.where(inside, middle, distinct[:-1]), last])


@dataclass
class Tree:
    """Nodes by number, the root first; one that is not split has feature -1."""

    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    depth: list = field(default_factory=lambda: [0])
    counts: list = field(default_factory=lambda: [None])

    def split(self, node, feature, cut, left, right):
        """Makes two children with these class counts and gives their numbers."""
        self.feature[node], self.bin[node] = feature, cut
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for counts in (left, right):
            for column, value in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0)):
                column.append(value)
            self.depth.append(self.depth[node] + 1)
            self.counts.append(counts)
        return self.left[node], self.right[node]

    def arrays(self):
        return tuple(np.array(x, np.int32) for x in (self.feature, self.bin, self.left, self.right))


class Growth:
    """One tree on the way: leaves by gain, of which some have been split on trial.

    A leaf counts as split once it is the best of all open leaves and the gains of its
    children are known. Children that come on trial let many leaves be split after
    one pass over the rows, in the order of one after the other.
    """

    def __init__(self, max_depth, max_leaves):
        self.tree, self.max_depth, self.max_leaves = Tree(), max_depth, max_leaves
        self.leaves, self.open, self.best = 1, [], {}
        self.waiting = {0}
        self.tried, self.done = {}, set()

    def may_split(self, node):
        counts = self.tree.counts[node]
        return self.tree.depth[node] < self.max_depth and np.count_nonzero(counts) > 1

    def learn(self, node, split):
        """Takes the best split of a node that was waited for."""
        self.waiting.discard(node)
        if node == 0:
            self.tree.counts[0] = split["left"] + split["right"]
        self.best[node] = split if split["gain"] > LEAST_GAIN and self.may_split(node) else None
        if node == 0:
            self._offer(0)

    def _offer(self, node):
        split = self.best.get(node)
        if split:
            heapq.heappush(self.open, (-split["gain"], node))

    def advance(self):
        """Splits leaves as long as their order is known, then tries the next ones; again,
        where no child of these can be split itself."""
        while True:
            self._settle()
            if 0 < self.max_leaves <= self.leaves:
                self.waiting.clear()
                return
            wanted = len(self.open) if self.max_leaves < 0 else self.max_leaves - self.leaves
            new = [node for _, node in heapq.nsmallest(wanted, self.open) if node not in self.tried]
            for node in new:
                self._try(node)
                self.waiting |= {c for c in self.tried[node] if self.may_split(c)}
            if self.waiting or not new:
                return

    def _settle(self):
        while self.open and not (0 < self.max_leaves <= self.leaves):
            node = self.open[0][1]
            last = self.leaves + 1 == self.max_leaves
            if node not in self.tried and last:
                self._try(node)
            if node not in self.tried or (not last and any(c in self.waiting for c in self.tried[node])):
                return
            heapq.heappop(self.open)
            self.done.add(node)
            self.leaves += 1
            for child in self.tried[node]:
                self._offer(child)

    def _try(self, node):
        s = self.best[node]
        self.tried[node] = self.tree.split(node, s["feature"], s["bin"], s["left"], s["right"])

    def finished(self):
        """The tree without what was tried only, its nodes numbered anew."""
        old, out = self.tree, Tree()
        out.counts[0] = old.counts[0]
        todo = [(0, 0)]
        while todo:
            at, to = todo.pop()
            if at in self.done:
                a, b = old.left[at], old.right[at]
                pair = out.split(to, old.feature[at], old.bin[at], old.counts[a], old.counts[b])
                todo += zip((a, b), pair)
        return out


def leaves_of(binned, tree):
    """The node of a tree, given as arrays, that each row ends in."""
    feature, cut, left, right = tree
    node, moving = np.zeros(len(binned), np.int64), np.arange(len(binned))
    while len(moving):
        at = node[moving]
        inner = feature[at] >= 0
        moving, at = moving[inner], at[inner]
        over = binned[moving, feature[at]] > cut[at]
        node[moving] = np.where(over, right[at], left[at])
    return node


def binary_rows(column, width):
    """An Arrow column of equally long byte strings as a matrix of bytes."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset :]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[len(column)]].reshape(len(column), width)


def _histograms(shared, width, shape, chances):
    """Per task: the class histograms of all asked leaves, one row for each that has rows."""

    def run(batches):
        asked = shared.value
        sums = np.zeros((len(asked["columns"]), *shape), np.int64)
        slots, bins, classes = shape
        guided = guide(chances)
        for batch in batches:
            if not batch.num_rows:
                continue
            binned = binary_rows(batch.column("bins"), width)
            own, seeds = batch.column("class").to_numpy(), spread(batch.column("seed").to_numpy().view(np.uint64))
            grouped = "rate" in batch.schema.names
            if grouped:
                most = 1 + max(number for number, _, _ in asked["trees"])
                every = group_draws(batch.column("seed").to_numpy().view(np.uint64), batch.column("rate").to_numpy(), most)
            # Every row or group is drawn by itself; equal ones then go down the trees as one.
            texts = np.ascontiguousarray(own, np.int32).view(np.uint8).reshape(len(own), 4)
            first, which = alike(np.concatenate([binned, texts], axis=1))
            binned, own = binned[first], own[first]
            for number, tree, units in asked["trees"]:
                times = every[number] if grouped else drawn_rows(seeds, number, chances, guided)
                drawn = np.bincount(which, times, len(first)).astype(np.int64)
                rows = np.flatnonzero(drawn)
                unit = units[leaves_of(binned[rows], tree)]
                rows, unit = rows[unit >= 0], unit[unit >= 0]
                columns = asked["columns"][unit]
                place = (unit[:, None] * slots + np.arange(slots)) * bins + binned[rows[:, None], columns]
                place = place * classes + own[rows][:, None]
                np.add.at(sums.reshape(-1), place.reshape(-1), np.repeat(drawn[rows], slots))
        seen = np.flatnonzero(sums.reshape(len(sums), -1).any(axis=1))
        texts = pa.array([sums[u].tobytes() for u in seen], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), texts], names=["unit", "sums"])

    return run


def _merged(finish, names):
    """Adds up the rows of one unit after the other; they must come in order."""

    def run(batches):
        unit, total = None, None
        for batch in batches:
            out = []
            for u, text in zip(batch.column("unit").to_pylist(), batch.column("sums")):
                sums = np.frombuffer(text.as_buffer(), np.int64)
                if u == unit:
                    total = total + sums
                    continue
                if unit is not None:
                    out.append((unit, *finish(total)))
                unit, total = u, sums
            yield pa.RecordBatch.from_pydict({n: [r[i] for r in out] for i, n in enumerate(names)}, schema=_schema(names))
        if unit is not None:
            out = [(unit, *finish(total))]
            yield pa.RecordBatch.from_pydict({n: [r[i] for r in out] for i, n in enumerate(names)}, schema=_schema(names))

    return run


KINDS = {
    "unit": pa.int32(),
    "sums": pa.binary(),
    "feature": pa.int32(),
    "bin": pa.int32(),
    "gain": pa.float64(),
    "left": pa.list_(pa.int64()),
    "right": pa.list_(pa.int64()),
}


def _schema(names):
    return pa.schema([(n, KINDS[n]) for n in names])


def best_split(sums, columns):
    """(column, bin, gain, left counts, right counts) from (column, bin, class) counts.

    gain is the fall of Gini impurity times the rows. Equal gains go to the first
    column and lowest bin. Without any split all counts are on the left.
    """
    left = sums.cumsum(axis=1)
    total = left[0, -1]
    right = total - left
    n_left, n_right = left.sum(axis=2), right.sum(axis=2)
    open_ = (n_left > 0) & (n_right > 0)

    def purity(counts, n):
        return (counts.astype(np.float64) ** 2).sum(axis=-1) / np.maximum(n, 1)

    gain = purity(left, n_left) + purity(right, n_right) - purity(total, total.sum())
    gain = np.where(open_, gain, 0.0)
    slot, cut = np.unravel_index(gain.argmax(), gain.shape)
    if gain[slot, cut] <= 0:
        return -1, 0, 0.0, total.tolist(), np.zeros_like(total).tolist()
    return int(columns[slot]), int(cut), float(gain[slot, cut]), left[slot, cut].tolist(), right[slot, cut].tolist()


def evaluated(rows, asked, trees, width, taken, bins, classes, chances):
    """The best split of each asked (tree, node), by passes that a task's memory bounds."""
    spark = rows.sparkSession
    slots = int(max(1, min(taken, HISTOGRAM_BYTES // (8 * bins * classes))))
    step = int(max(1, HISTOGRAM_BYTES // (8 * slots * bins * classes)))
    found = {}
    for low in range(0, len(asked), step):
        some = asked[low : low + step]
        columns = np.array([columns_of(t, n, width, taken) for t, n in some])
        for first in range(0, taken, slots):
            for key, split in _pass(spark, rows, some, columns[:, first : first + slots], trees, width, bins, classes, chances):
                held = found.get(key)
                if held is None or split["gain"] > held["gain"]:
                    found[key] = split
    return found


def _pass(spark, rows, some, columns, trees, width, bins, classes, chances):
    held = []
    for number in sorted({t for t, _ in some}):
        arrays = trees[number].arrays()
        units = np.full(len(arrays[0]), -1, np.int64)
        for unit, (t, node) in enumerate(some):
            if t == number:
                units[node] = unit
        held.append((number, arrays, units))
    shared = spark.sparkContext.broadcast({"columns": columns, "trees": held})
    shape = (columns.shape[1], bins, classes)

    def split(sums):
        return sums.reshape(shape)

    partial = rows.mapInArrow(_histograms(shared, width, shape, chances), "unit int, sums binary")
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_TREE))
    # Units are numbered, so equal shares of them make equal tasks.
    ordered = partial.withColumn("part", part).repartition("unit", "part").sortWithinPartitions("unit")
    merged = ordered.select("unit", "sums").mapInArrow(_merged(lambda s: (s.tobytes(),), ["unit", "sums"]), "unit int, sums binary")
    names = ["unit", "feature", "bin", "gain", "left", "right"]
    ordered = merged.repartition("unit").sortWithinPartitions("unit")

    def best(batches):
        def finish(unit):
            return lambda sums: best_split(split(sums), shared.value["columns"][unit])

        for batch in _merged(lambda s: (s.tobytes(),), ["unit", "sums"])(batches):
            units = batch.column("unit").to_pylist()
            sums = [np.frombuffer(t.as_buffer(), np.int64) for t in batch.column("sums")]
            out = [(u, *finish(u)(s)) for u, s in zip(units, sums)]
            yield pa.RecordBatch.from_pydict({n: [r[i] for r in out] for i, n in enumerate(names)}, schema=_schema(names))

    splits = ordered.mapInArrow(best, SPLITS).toArrow().to_pylist()
    shared.unpersist()
    for s in splits:
        for side in ("left", "right"):
            s[side] = np.array(s[side], np.int64)
        yield some[s.pop("unit")], s


@dataclass
class GrownTrees:
    """Trees as plain arrays: splits by value, and class shares of each leaf."""

    trees: list
    shared: Broadcast | None = None

    def votes(self, spark):
        if self.shared is None:
            self.shared = spark.sparkContext.broadcast({"trees": self.trees})
        return self.shared


def _sample(rows, width):
    """Feature vectors of rows with the least seeds."""
    n = rows.count()
    bound = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // width))
    some = rows.filter(F.pmod("seed", F.lit(max(1, n // (2 * bound)))) == 0)
    some = some.groupBy("seed").agg(F.first("features").alias("features")).orderBy("seed").limit(bound)
    return blocks.doubles(some.toArrow()["features"], width)


def _groups(rows, rate):
    """One row for all that are equal in features and label, with the draws expected from it."""
    counted = rows.groupBy("features", "label").agg((F.count("*") * F.lit(float(rate))).alias("rate"))
    return counted.select("features", "label", F.xxhash64("features", "label").alias("seed"), "rate")


def grow(df, width, labels, features, label, trees, max_depth, max_features, max_leaves, max_samples, row_id, vectors=None):
    """``trees`` trees on bootstrap samples of the rows of ``df``; see ``fit_random_forest``.

    ``vectors`` are all the feature vectors that there are, where these are known. Bins
    are then cut from them, and rows of equal features and label are counted first and
    drawn together: a pass over the trees meets one row for each group.
    """
    spark = df.sparkSession
    taken = max(1, int(np.sqrt(width)) if max_features == "sqrt" else round(float(max_features) * width))
    keys = [F.col(c) for c in ([row_id] if row_id in df.columns else []) + [features, label]]
    rows = df.select(F.col(features).alias("features"), F.col(label).cast("int").alias("label"), F.xxhash64(*keys).alias("seed"))
    sample = _sample(rows, width) if vectors is None else vectors
    cuts = [bin_cuts(sample[:, i], BINS) for i in range(width)]
    bins = max(len(c) for c in cuts) + 1
    classes = np.array(labels, np.int64)

    def binned(batches):
        for batch in batches:
            values = blocks.doubles(batch.column(0), width)
            table = np.stack([np.searchsorted(c, values[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
            own = np.searchsorted(classes, batch.column(1).to_numpy()).astype(np.int32)
            ends = pa.py_buffer(np.arange(len(table) + 1, dtype=np.int32) * np.int32(width))
            texts = pa.Array.from_buffers(pa.binary(), len(table), [None, ends, pa.py_buffer(np.ascontiguousarray(table))])
            kept = batch.schema.names[2:]
            yield pa.RecordBatch.from_arrays([texts, pa.array(own), *batch.columns[2:]], names=["bins", "class", *kept])

    chances = poisson(float(max_samples))
    with scratch(spark):
        found = "bins binary, class int, seed long"
        if vectors is not None:
            rows, found = _groups(rows, max_samples), f"{found}, rate double"
        rows = written_table(rows.mapInArrow(binned, found), "forest-rows")
        growing = [Growth(max_depth, max_leaves) for _ in range(trees)]
        while asked := [(t, node) for t, g in enumerate(growing) for node in sorted(g.waiting)]:
            found = evaluated(rows, asked, [g.tree for g in growing], width, taken, bins, len(classes), chances)
            none = {"feature": -1, "bin": 0, "gain": 0.0, "left": np.zeros(len(classes), np.int64), "right": np.zeros(len(classes), np.int64)}
            for t, node in asked:
                growing[t].learn(node, found.get((t, node), none))
            for g in growing:
                g.advance()
    return GrownTrees([_plain(g.finished(), cuts) for g in growing])


def _plain(tree, cuts):
    """(feature, value, left, right) by node, and the leaves' class shares as sparse rows."""
    feature, cut, left, right = tree.arrays()
    value = np.array([cuts[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut)])
    ends, names, shares = [0], [], []
    for f, counts in zip(feature, tree.counts):
        seen = np.flatnonzero(counts) if f < 0 else np.zeros(0, np.int64)
        names.append(seen)
        shares.append(counts[seen] / max(counts.sum(), 1))
        ends.append(ends[-1] + len(seen))
    return feature, value, left, right, np.array(ends), np.concatenate(names), np.concatenate(shares)


def predicted(grown, df, features, width, labels):
    """A column with the label of the highest vote, the lowest on ties."""
    shared = grown.votes(df.sparkSession)
    step = max(1, VOTE_BYTES // (8 * max(len(labels), 1)))
    names = np.array(labels, np.int32)

    @F.arrow_udf("int")
    def vote(column: pa.Array) -> pa.Array:
        first, which = alike(every := blocks.doubles(column, width))
        values = every[first]
        out = np.zeros(len(values), np.int32)
        for low in range(0, len(values), step):
            part = values[low : low + step]
            votes = np.zeros((len(part), len(names)))
            for feature, value, left, right, ends, classes, shares in shared.value["trees"]:
                leaf = _leaves(part, feature, value, left, right)
                sizes = ends[leaf + 1] - ends[leaf]
                row = np.repeat(np.arange(len(part)), sizes)
                at = np.repeat(ends[leaf] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(row))
                np.add.at(votes, (row, classes[at]), shares[at])
            out[low : low + step] = names[votes.argmax(axis=1)]
        return pa.array(out[which])

    return vote(of_width(features, width))


def _leaves(values, feature, value, left, right):
    node, moving = np.zeros(len(values), np.int64), np.arange(len(values))
    while len(moving):
        at = node[moving]
        inner = feature[at] >= 0
        moving, at = moving[inner], at[inner]
        under = values[moving, feature[at]] <= value[at]
        node[moving] = np.where(under, left[at], right[at])
    return node
