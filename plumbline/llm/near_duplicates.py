"""Near duplicates by bottom-k sketches of word shingles, and their connected groups."""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from plumbline.llm.arrow import TEXT, append_columns, column, packed, unpacked
from plumbline.llm.words import WordReader, blocks, run_hashes, spaced_word_bytes, utf8
from plumbline.session import scratch, written_table

WORDS, PERCENT = 5, 80
#: Values that a sketch retains, and the chance that a linked pair shares too few of them.
SKETCH, MISS = 48, 1e-10
BLOCK_BYTES = 1 << 20
#: Sets, a few numbers each, that are broadcast to find their texts.
BROADCAST_SETS = 250_000


def least_common(k, percent, miss=MISS):
    """The most of ``k`` that a linked pair's union sketch shares but for chance ``miss``.

    Each of the union's ``k`` smallest hashes is in both sets with at least the
    chance ``percent``, and then both sketches retain it.
    """
    p, below = percent / 100, 0.0
    for common in range(k + 1):
        below += math.comb(k, common) * p**common * (1 - p) ** (k - common)
        if below > miss:
            return max(common, 1)
    return k


class ShingleReader:
    """Distinct shingle hashes of each text of a block, in order."""

    def __init__(self, words):
        self.words, self.reader = words, WordReader(spaced_word_bytes())

    def sets(self, data, bounds):
        _, _, of, hashes = self.reader.read(data, bounds)
        counts = np.bincount(of, minlength=len(bounds) - 1)
        first = np.concatenate([[0], np.cumsum(counts)])
        runs = run_hashes(hashes, of, self.words)
        for i, n in enumerate(counts):
            a = first[i]
            if n >= self.words:
                yield np.unique(runs[a : a + n - self.words + 1])
            else:
                # All words as one; the number of words goes into the hash.
                yield run_hashes(hashes[a : a + n], of[a : a + n], int(n))[:1]


def ordered_long(values):
    """Unsigned 64-bit numbers as signed ones in the same order."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs, doc_id, text, words, sketch):
    """doc_id, text_key, n_shingles, set_id (of the whole set) and sketch of each row."""

    def start():
        reader = ShingleReader(words)

        def compute(array):
            data, bounds = utf8(array)
            sizes, ids, kept = [], [], []
            for low, high in blocks(bounds, BLOCK_BYTES):
                for found in reader.sets(data, bounds[low : high + 1]):
                    sizes.append(len(found))
                    ids.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest())
                    kept.append(ordered_long(found[:sketch]))
            return [pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), lists_of(kept)]

        return compute

    rows = docs.select(
        column(doc_id).alias("doc_id"), F.md5(column(text)).alias("text_key"), column(text).alias(TEXT)
    )
    fields = [("n_shingles", LongType()), ("set_id", StringType()), ("sketch", ArrayType(LongType()))]
    return append_columns(rows, TEXT, fields, start, carry=["doc_id", "text_key"])


def inverted_lists(sets, percent, sketch):
    """(value, node, n, own): the retained values under which a set is looked for.

    Of a set's sketch these are the rarest ones. Linked sets share at least c of
    their k retained values, so with values in one order, by the number of sets
    that hold them, the first k - c + 1 of both have one in common. Values of one
    set alone come first and need no list.
    """
    n, k = F.col("n"), F.size("sketch")
    # Sets this small, and all that they can be linked with, are retained whole.
    whole = n * 100 <= percent * sketch
    common = F.when(whole, F.ceil(n * percent / 100)).otherwise(least_common(sketch, percent))
    values = sets.select("node", "n", (k - common + 1).alias("places"), k.alias("k"), F.explode("sketch").alias("value"))
    held = values.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    shared = values.join(held, "value").groupBy("node", "n", "places", "k").agg(
        F.array_sort(F.collect_list(F.struct("held", "value"))).alias("shared")
    )
    left = (F.col("places") - (F.col("k") - F.size("shared"))).cast("int")
    own = 1 - F.size("shared") / F.col("k")
    first = shared.filter(left > 0).select("node", "n", own.alias("own"), F.explode(F.slice("shared", 1, left)).alias("s"))
    return first.select("node", "n", "own", F.col("s.value").alias("value"))


def like_sizes(a, b, percent):
    """Linked sets have sizes of this ratio at least."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def likely(pairs, sets, percent, sketch):
    """The pairs (a, b) whose union sketch, the smallest of both, shares enough."""
    left = sets.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, sketch))
    last = F.element_at("u", -1)
    common = F.aggregate(
        F.array_intersect("sa", "sb"), F.lit(0), lambda n, v: n + F.when(v <= last, 1).otherwise(0)
    )
    # A union smaller than a sketch is known in full.
    enough = F.when(F.size("u") < sketch, common * 100 >= F.size("u") * percent).otherwise(
        common >= least_common(sketch, percent)
    )
    return both.filter(enough).select("a", "b")


def full_sets(nodes, sets, docs, doc_id, text, words):
    """(node, shingles): the whole sets of the nodes, read from one text of each."""
    reps = nodes.join(sets.select("node", "rep"), "node").select("node", "rep.*")
    reps = written_table(reps, "near-reps")
    if reps.count() <= BROADCAST_SETS:
        reps = F.broadcast(reps)
    texts = docs.select(
        F.md5(column(text)).alias("key"), column(doc_id).alias("id"), column(text).alias(TEXT)
    ).filter("key IS NOT NULL")
    same = (F.col("key") == F.col("text_key")) & F.col("id").eqNullSafe(F.col("doc_id"))
    found = texts.join(reps, same).select("node", TEXT).dropDuplicates(["node"])

    def shingles(batches):
        reader = ShingleReader(words)
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            found = [
                ordered_long(s)
                for low, high in blocks(bounds, BLOCK_BYTES)
                for s in reader.sets(data, bounds[low : high + 1])
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists_of(found)], names=["node", "shingles"])

    return written_table(found.mapInArrow(shingles, "node long, shingles array<long>"), "near-full")


def lists_of(arrays):
    """Arrays of long numbers as one Arrow array of lists."""
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def linked(pairs, full, percent):
    """The pairs whose full shingle sets are similar enough."""
    both = pairs.join(full.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = both.join(full.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")

    def similar(batches):
        for batch in batches:
            yes = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                yes.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))

    return both.mapInArrow(similar, "a long, b long")


def prefix_lists(full, percent):
    """(value, node, n, alone, before): the values under which whole sets are looked for.

    Values stand in one order, rare ones first; before is the number of a set's
    values that stand before this one, alone that of values no other set has. Only
    the first n - c + 1 values can be the first common one, with c = percent of n.
    """
    values = full.select("node", F.explode("shingles").alias("value"))
    held = values.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    shared = values.join(held, "value").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("held", "value"))).alias("shared")
    )
    rows = full.select("node", F.size("shingles").cast("long").alias("n")).join(shared, "node")
    left = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    alone = F.col("n").cast("int") - F.size("shared")
    rows = rows.filter(left > alone).select(
        "node", "n", alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), left - alone))
    )
    rows = rows.select(
        "node", "n", "alone", (F.col("alone") + F.col("pos")).alias("before"), F.col("col.value").alias("value")
    )
    return written_table(rows, "near-prefixes")


def possible(rows, other, percent):
    """Pairs under one value, of different groups, that may be similar enough.

    At least c = percent / (100 + percent) of both sizes must be common, and none
    of the values before the first common one is.
    """
    other = other.select("value", *[F.col(c).alias(f"{c}_") for c in ("node", "n", "comp", "before")])
    least = F.ceil((F.col("n") + F.col("n_")) * percent / (100 + percent))
    enough = (F.col("n") - F.col("before") >= least) & (F.col("n_") - F.col("before_") >= least)
    pairs = rows.join(other, "value").filter((F.col("comp") != F.col("comp_")) & enough)
    return pairs.select(F.col("node").alias("x"), F.col("node_").alias("y"))


def ordered_pairs(pairs):
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(edges):
    """(node, comp): the smallest node that each node of the edges (a, b) reaches.

    Every round takes the smallest label of a node's neighbours and then the
    label of its label, and is written, so its lineage does not grow; it ends
    when no label changes.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written_table(both.distinct(), "near-edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp"))
    labels = written_table(labels, "near-labels")
    while True:
        theirs = labels.select(F.col("node").alias("b"), F.col("comp").alias("near"))
        near = both.join(theirs, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        moved = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        further = labels.select(F.col("node").alias("next"), F.col("comp").alias("further"))
        moved = moved.join(further, "next").select("node", F.col("comp").alias("old"), F.least("next", "further").alias("comp"))
        moved = written_table(moved, "near-labels")
        labels = moved.select("node", "comp")
        if moved.filter("old <> comp").isEmpty():
            return labels


def grouped(rows, edges):
    """``rows`` with the group (comp) of each node by the edges so far."""
    return rows.join(components(edges), "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def links(lists, sets, docs, doc_id, text, words, percent, sketch):
    """Edges between distinct sets that connect all linked ones.

    Each list is first paired with one member, that with the least share of
    values of its own, the nearest to what the others are copies of; this is
    linear in the list and joins most copies of a text at once. Sets that share a
    list with another group after that are few. Their full sets are looked for
    under their own rare values, again with one member of each list first, and at
    last with every member of another group that the full sets leave possible.
    """
    center = F.min(F.struct("own", F.col("node").alias("x"), F.col("n").alias("nx")))
    centers = lists.groupBy("value").agg(center.alias("c")).select("value", "c.x", "c.nx")
    pairs = lists.join(centers, "value").filter("node <> x").filter(like_sizes(F.col("n"), F.col("nx"), percent))
    pairs = ordered_pairs(pairs.select("x", F.col("node").alias("y")))
    pairs = written_table(likely(pairs, sets, percent, sketch), "near-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    edges = written_table(linked(pairs, full_sets(nodes, sets, docs, doc_id, text, words), percent), "near-links")
    rows = grouped(lists.select("value", "node"), edges)
    several = rows.groupBy("value").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    several = several.filter("low <> high").select("value")
    live = written_table(rows.join(several, "value").select("node").distinct(), "near-live")
    full = full_sets(live, sets, docs, doc_id, text, words)
    prefixes = prefix_lists(full, percent)
    rows = written_table(grouped(prefixes, edges), "near-grouped")
    center = F.min(F.struct("alone", "node", "n", "comp", "before")).alias("c")
    pairs = possible(rows, rows.groupBy("value").agg(center).select("value", "c.*"), percent)
    found = linked(written_table(ordered_pairs(pairs), "near-pairs"), full, percent)
    edges = written_table(edges.unionByName(found), "near-links")
    rows = written_table(grouped(prefixes, edges), "near-grouped")
    pairs = written_table(ordered_pairs(possible(rows, rows, percent).filter("x < y")), "near-pairs")
    return edges.unionByName(linked(pairs, full, percent))


def near_duplicates(docs, doc_id="doc_id", text="text", words=WORDS, percent=PERCENT, sketch=SKETCH):
    """doc_id, n_shingles, component_id and kept of each row, with text_key and group.

    A text's set is that of its distinct ``words``-word shingles, words
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words are one shingle. Texts
    are linked where the common shingles are at least ``percent`` of all of both.
    component_id is the smallest doc_id that links reach, and the row that has it
    is kept. text_key is the MD5 of the text; group tells the rows that are linked
    or have equal sets, whatever their ids, and is null for a row alone.

    Rows with equal sets become one set first, however many they are. A set keeps
    the ``sketch`` smallest hashes of one hash function; lists of sets by retained
    value give the candidates, the sketch of a pair's union an estimate that
    leaves out a linked pair with the chance ``MISS`` at most, and the full sets
    decide.

    Null, empty and blank texts have no shingles and are linked with nothing.
    Repeated rows are returned each, all of them kept if one is. A row with null
    doc_id is linked like others, but does not name a component that has other
    ids. Texts are read whole; other columns are not used; an empty table gives an
    empty one.
    """
    with scratch(docs.sparkSession) as keep:
        rows = written_table(sketches(docs, doc_id, text, words, sketch), "near-sketches")
        sets = rows.filter("n_shingles > 0").groupBy("set_id").agg(
            F.min("doc_id").alias("least_id"),
            F.count("*").alias("copies"),
            F.min(F.struct("text_key", "doc_id")).alias("rep"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
        )
        sets = written_table(sets.withColumn("node", F.monotonically_increasing_id()), "near-sets")
        lists = written_table(inverted_lists(sets, percent, sketch), "near-lists")
        labels = components(links(lists, sets, docs, doc_id, text, words, percent, sketch))
        named = sets.select("node", "set_id", "least_id", "copies").join(labels, "node", "left")
        groups = named.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("least_id").alias("group_id"))
        named = named.filter("comp IS NOT NULL OR copies > 1").join(groups, "comp", "left")
        group = F.coalesce(F.col("comp").cast("string"), "set_id").alias("group")
        named = named.select("set_id", F.coalesce("group_id", "least_id").alias("component_id"), group)
        found = rows.select("doc_id", "n_shingles", "text_key", "set_id").join(named, "set_id", "left")
        found = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
        kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
        return keep(found.select("doc_id", "n_shingles", "component_id", kept, "text_key", "group"), "near-groups")


def without_near_duplicates(docs, doc_id="doc_id", text="text", **options):
    """``docs`` with one row of each group, the one with the smallest doc_id.

    A null doc_id comes after all others, and ties go to the least text_key. Of
    rows that repeat in both, the one whose other columns have the least MD5 as
    JSON stays. Null, empty and blank texts are in no group and stay as they are.
    """
    with scratch(docs.sparkSession) as keep:
        found = near_duplicates(docs, doc_id, text, **options).filter("group IS NOT NULL")
        found = found.select("group", F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
        pairs = written_table(found.groupBy("group", "id", "key").agg(F.count("*").alias("copies")), "near-copies")
        least = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "key", "copies")).alias("least")
        first = written_table(pairs.groupBy("group").agg(least).select("least.*"), "near-first")
        single = first.filter("copies = 1").select(F.col("id").alias("own_id"), F.col("key").alias("own_key"))
        same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key"))
        gone = pairs.join(single, same, "left_anti")
        dropped = keep(gone.select(F.col("id").alias("gone_id"), F.col("key").alias("gone_key")), "near-dropped")
        repeated = first.filter("copies > 1").select(F.col("id").alias("same_id"), F.col("key").alias("same_key"))
        repeated = keep(repeated, "near-repeated")
    names = docs.columns
    rows = docs.select(packed(names), column(doc_id).alias("id"), F.md5(column(text)).alias("key"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & F.col("key").eqNullSafe(F.col("gone_key"))
    kept = unpacked(rows.join(dropped, same, "left_anti").select("row"), names)
    if repeated.isEmpty():
        return kept
    same = F.col("id").eqNullSafe(F.col("same_id")) & F.col("key").eqNullSafe(F.col("same_key"))
    numbered = {n: f"c{i}" for i, n in enumerate(names) if n != text}
    others = F.struct("row.none", *[F.col("row").getField(c).alias(n) for n, c in numbered.items()])
    several = rows.join(repeated, same).select("same_id", "same_key", "row", F.md5(F.to_json(others)).alias("order"))
    one = several.groupBy("same_id", "same_key").agg(F.min_by("row", "order").alias("row"))
    return kept.unionByName(unpacked(one.select("row"), names))
