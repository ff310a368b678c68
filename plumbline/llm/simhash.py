"""Near duplicates by SimHash, with pairs of fingerprints found by pigeonring chains.

The 64 bits of a fingerprint are a ring of segments. If two fingerprints differ in at
most ``most`` bits, there is a segment from which on, for every i, the first i segments
differ in at most i / m of ``most`` bits, rounded down. The segments whose budget is
0 must be equal, and of the two halves of those up to budget 1 at least one is: these
bits are the key under which fingerprints meet. Of those that meet, the chain of
budgets is checked, and what is left by its whole distance.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from plumbline.llm.arrow import append_columns, column
from plumbline.llm.joins import BROADCAST_ROWS, spread_join
from plumbline.llm.near_duplicates import components
from plumbline.session import scratch, written_table

WORDS, MOST, SEED = 3, 3, 42
BITS, SEGMENTS = 64, 8
#: Members of one key that a task compares with each other at once.
BLOCK = 1024
#: Shingles whose bits are counted at once, and pairs that are compared at once.
SHINGLES, PAIRS = 1 << 16, 1 << 20
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text, words, seed=SEED):
    """SimHash of the XXH64 of a text's word shingles, repeats included."""
    found = text.encode().translate(LOWER).split()
    size = min(words, len(found))
    if not size:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(found) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for low in range(0, len(starts), SHINGLES):
        some = zip(starts[low : low + SHINGLES], ends[low : low + SHINGLES])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in some], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    # Bytes of a number stand lowest first, and so do the bits of each.
    over = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(over.view("<u8")[0])


def fingerprints(docs, doc_id, text, words):
    """doc_id and fingerprint, as a signed long, of each row."""

    def start():
        def compute(texts):
            found = np.array([fingerprint(t or "", words) for t in texts.to_pylist()], np.uint64)
            return [pa.array(found.view(np.int64))]

        return compute

    rows = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    return append_columns(rows, "text", [("fingerprint", LongType())], start, carry=["doc_id"])


def budgets(most, segments=SEGMENTS):
    """Bits that the first 1, 2, ... segments of a chain may differ in."""
    return [i * most // segments for i in range(1, segments + 1)]


def chain_keys(node, most, segments=SEGMENTS):
    """The keys of a fingerprint column: two for each segment that a chain can start at."""
    width, budget = BITS // segments, budgets(most, segments)
    equal, one = width * budget.count(0), width * sum(b <= 1 for b in budget)
    half = equal + (one - equal) // 2

    def bits(low, high):
        return ((1 << high) - 1) ^ ((1 << low) - 1)

    keys = []
    for s in range(segments):
        turned = node
        if s:
            turned = F.shiftrightunsigned(node, s * width).bitwiseOR(F.shiftleft(node, BITS - s * width))
        for h, (low, high) in enumerate(((equal, half), (half, one))):
            mask = bits(0, equal) | bits(low, high)
            kept = turned.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask))
            keys.append(F.struct(F.lit(2 * s + h).alias("chain"), kept.alias("bits")))
    return F.array(*keys)


def chained(a, b, start, most, segments=SEGMENTS):
    """Whether pairs of fingerprints keep all budgets of the chain from segment ``start`` on."""
    width, x = BITS // segments, a ^ b
    if start:
        x = (x >> np.uint64(start * width)) | (x << np.uint64(BITS - start * width))
    kept = np.ones(len(x), bool)
    for i, budget in enumerate(budgets(most, segments), 1):
        low = np.uint64((1 << (i * width)) - 1)
        kept &= np.bitwise_count(x & low) <= budget
    return kept


def spanning(values, other, start, most):
    """Links between fingerprints, or those of two blocks, that connect all linked ones.

    One link for each fingerprint that is not yet connected, however many link.
    """
    root = {int(v): int(v) for v in np.concatenate([values, other])}

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    found = []
    step = max(1, PAIRS // max(len(other), 1))
    for low in range(0, len(values), step):
        part = values[low : low + step]
        a, b = np.repeat(part, len(other)), np.tile(other, len(part))
        some = (a != b) & chained(a, b, start, most)
        a, b = a[some], b[some]
        near = np.bitwise_count(a ^ b) <= most
        for pair in zip(a[near].tolist(), b[near].tolist()):
            x, y = map(find, pair)
            if x != y:
                root[max(x, y)] = min(x, y)
                found.append(pair)
    return found


def links(nodes, most, block=BLOCK, broadcast_rows=BROADCAST_ROWS):
    """Edges (a, b) of fingerprints that connect all within ``most`` bits of each other.

    Keys of one fingerprint alone are dropped by their count. The members of a key
    are cut into blocks by a hash, and each two blocks meet in one row, so that a key
    that holds much of the table is compared by many tasks; each gives at most one
    edge for a member, not all pairs.
    """
    keys = nodes.select("node", F.explode(chain_keys(F.col("node"), most)).alias("key"))
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    counts = written_table(counts.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "simhash-keys")
    met = spread_join(keys, counts, "key", "n", broadcast_rows).filter("blocks IS NOT NULL")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.withColumn("own", own).withColumn("other", others)
    met = met.select("key", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    blocks = met.groupBy("key", "i", "j").agg(
        F.collect_list(F.when(F.col("own") == F.col("i"), F.col("node"))).alias("left"),
        F.collect_list(F.when(F.col("own") != F.col("i"), F.col("node"))).alias("right"),
    )

    def compare(batches):
        for batch in batches:
            chains = batch.column("chain").to_pylist()
            edges = []
            for chain, left, right in zip(chains, batch.column("left"), batch.column("right")):
                left, right = (np.asarray(x.values.to_numpy(), np.int64).view(np.uint64) for x in (left, right))
                edges += spanning(left, right if len(right) else left, chain // 2, most)
            ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    found = blocks.filter("i = j OR size(right) > 0").select("key.chain", "left", "right")
    return found.mapInArrow(compare, "a long, b long").distinct()


def simhash_groups(
    docs, doc_id="doc_id", text="text", words=WORDS, most=MOST, block=BLOCK, broadcast_rows=BROADCAST_ROWS
):
    """doc_id, fingerprint (16 hex digits) and component_id of each row.

    A text's shingles are its runs of ``words`` words ``[^\\x20\\x09-\\x0D]+`` with A-Z
    lower-cased, joined by spaces, repeats included; fewer words are one shingle. A bit of
    the fingerprint is 1 if it is set in more than half of their hashes. Fingerprints are
    linked if at most ``most`` of their bits differ; component_id is the smallest doc_id
    that links reach.

    Equal fingerprints are one from the start, however many rows have them; groups return
    to the rows by ``spread_join``, which broadcasts up to ``broadcast_rows`` of them. Only the
    fingerprints that share a key of ``chain_keys`` are compared, in blocks of about
    ``block``; ``most`` must be below the number of segments, so that a key has equal bits.

    Null, empty and blank texts have fingerprint zero, which links like any other.
    Repeated rows are returned each. A row with null doc_id links like others, but
    does not name a component that has other ids. Texts are read whole; other
    columns are not used; an empty table gives an empty one.
    """
    if not 0 <= most < SEGMENTS:
        raise ValueError(f"most must lie between 0 and {SEGMENTS - 1}, not {most}")
    with scratch(docs.sparkSession) as keep:
        rows = written_table(fingerprints(docs, doc_id, text, words), "simhash-rows")
        nodes = rows.groupBy(F.col("fingerprint").alias("node")).agg(
            F.min("doc_id").alias("least_id"), F.count("*").alias("copies")
        )
        nodes = written_table(nodes, "simhash-nodes")
        labels = components(links(nodes.select("node"), most, block, broadcast_rows))
        named = written_table(nodes.join(labels, "node", "left"), "simhash-named")
        groups = named.filter("comp IS NOT NULL").groupBy("comp").agg(
            F.min("least_id").alias("group_id"), F.count("*").alias("members")
        )
        named = spread_join(named, groups, "comp", "members", broadcast_rows).select(
            F.col("node").alias("fingerprint"), F.coalesce("group_id", "least_id").alias("component_id"), "copies"
        )
        named = written_table(named.filter("copies > 1 OR component_id IS NOT NULL"), "simhash-named")
        found = spread_join(rows, named, "fingerprint", "copies", broadcast_rows)
        digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
        found = found.select("doc_id", digits, F.coalesce("component_id", "doc_id").alias("component_id"))
        return keep(found, "simhash-groups")
