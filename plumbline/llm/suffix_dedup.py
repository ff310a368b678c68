"""Repeated byte strings of texts, by a distributed merge sort of sampled suffixes.

A string of SPAN bytes that stands twice is found through its anchor. The anchor
of the span that starts at i is the place of the smallest 8-byte hash among the
WINDOW places from i on; equal spans have it at the same place. Only suffixes that
begin at anchors are sorted, cut where the last span of the anchor ends, each with
the bytes before it back to where its first span starts.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from plumbline.llm.arrow import column, packed, unpacked
from plumbline.llm.words import ONE_BYTES, blocks, byte_values, mixed, utf8
from plumbline.session import scratch, written_table

SPAN, WINDOW, GRAM = 200, 144, 8
#: Bytes that the suffixes of two equal spans have in common at least.
SHARED = SPAN - WINDOW + 1
BLOCK_BYTES = 1 << 20
#: A longer text is read in parts of so many span starts.
PART_STARTS = 4 << 20
#: Suffixes sorted in one run, about, those of one range, and the sample that ranges are cut by.
RUN_SUFFIXES, RANGE_SUFFIXES, SAMPLE_TEXTS, SAMPLE_SUFFIXES = 40_000, 40_000, 4_000, 40_000
#: A range of more than so many times its suffixes is crowded: one beginning has very many contexts.
CROWDED = 4


class AnchorReader:
    """Anchors of the spans of a block of texts."""

    def __init__(self):
        self.values = byte_values()
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(SHARED, ONE_BYTES))

    def read(self, data, bounds):
        """Text, first and last span start, and anchor place for each anchor, as arrays.

        Places count from the start of ``data``. Neighbouring spans with one
        anchor are one entry.
        """
        found = [np.zeros((4, 0), np.int64)]
        for low, high in blocks(bounds, BLOCK_BYTES):
            start, end = bounds[low], bounds[high]
            if high - low > 1 or end - start <= PART_STARTS + SPAN:
                found.append(self._part(data, bounds[low : high + 1], low))
                continue
            for at in range(int(start), int(end) - SPAN + 1, PART_STARTS):
                part = np.array([at, min(at + PART_STARTS + SPAN - 1, end)])
                found.append(self._part(data, part, low))
        return np.concatenate(found, axis=1)

    def _part(self, data, bounds, first_text):
        base, n = bounds[0], int(bounds[-1] - bounds[0])
        sizes = np.diff(bounds)
        starts = np.maximum(sizes - SPAN + 1, 0)
        if not starts.any():
            return np.zeros((4, 0), np.int64)
        padded = np.zeros(n + GRAM, np.uint8)
        padded[:n] = data[base : base + n]
        grams = np.ndarray((n,), "<u8", padded, strides=(1,)).copy()
        mask = np.uint64((1 << 24) - 1)
        with np.errstate(over="ignore"):
            ranked = (mixed(grams) & ~mask) | np.arange(n, dtype=np.uint64)
        least, have = ranked, 1
        while have < WINDOW:
            step = min(have, WINDOW - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        text = np.repeat(np.arange(len(sizes)), starts)
        at = np.arange(len(text)) - np.repeat(np.cumsum(starts) - starts, starts) + (bounds[:-1] - base)[text]
        anchor = (least[at] & mask).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:] - 1, [len(at) - 1]])
        return np.stack([text[first] + first_text, at[first] + base, at[last] + base, anchor[first] + base])

    def hashes(self, data, anchors):
        """Of the ``SHARED`` bytes from each anchor on."""
        out = np.empty(len(anchors), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(0, len(anchors), 1 << 14):
                rows = anchors[i : i + (1 << 14), None] + np.arange(SHARED)
                out[i : i + (1 << 14)] = mixed((self.values[data[rows]] * self.powers).sum(axis=1))
        return out.view(np.int64)


def common_prefix(x, y, known=0):
    """The length of the common prefix of two byte strings that share ``known`` bytes."""
    high = min(len(x), len(y))
    if x[known:high] == y[known:high]:
        return high
    while high - known > 1:
        middle = (known + high) // 2
        if x[known:middle] == y[known:middle]:
            known = middle
        else:
            high = middle
    return known


class LoserTree:
    """Merges sorted runs with known common prefixes without comparing them again.

    A run is a list of byte strings and one of their common prefixes with the
    string before. ``known`` is that of a run's head with the last string given
    out: of two heads the one with the longer prefix comes first, and only equal
    prefixes are compared, from there on. The loser keeps what the comparison
    found, which is its prefix with the winner.
    """

    def __init__(self, runs):
        self.runs = runs
        self.leaves = 1 << max(0, (len(runs) - 1).bit_length())
        self.heads = [0] * self.leaves
        self.known = [0] * self.leaves
        self.losers = [0] * self.leaves
        self.losers[0] = self._build(1)

    def _head(self, leaf):
        if leaf < len(self.runs) and self.heads[leaf] < len(self.runs[leaf][0]):
            return self.runs[leaf][0][self.heads[leaf]]
        return None

    def _build(self, node):
        if node >= self.leaves:
            return node - self.leaves
        winner, loser = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = loser
        return winner

    def _play(self, a, b):
        x, y = self._head(a), self._head(b)
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        known = self.known
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        same = common_prefix(x, y, known[a])
        if x[same:] <= y[same:]:
            known[b] = same
            return a, b
        known[a] = same
        return b, a

    def __iter__(self):
        """(run, place in it, common prefix with the string before) in order."""
        while True:
            winner = self.losers[0]
            if self._head(winner) is None:
                return
            place = self.heads[winner]
            yield winner, place, self.known[winner]
            self.heads[winner] = place + 1
            if self._head(winner) is not None:
                self.known[winner] = self.runs[winner][1][place + 1]
            node = (winner + self.leaves) // 2
            while node:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node //= 2
            self.losers[0] = winner


def front_coded(suffixes, befores, several):
    """One sorted run as bytes: common prefixes, what follows them, and the rest."""
    same = [0, *(common_prefix(x, y) for x, y in zip(suffixes, suffixes[1:]))]
    head = np.array(
        [same, [len(s) for s in suffixes], [len(b) for b in befores], several], np.uint8
    )
    body = b"".join(s[k:] for s, k in zip(suffixes, same))
    raw = head.tobytes() + body + b"".join(befores)
    return pa.compress(raw, codec="zstd", asbytes=True), len(raw)


def front_decoded(packed, size, n):
    """Suffixes, their common prefixes, the bytes before them, and whether several."""
    raw = pa.decompress(packed, size, codec="zstd", asbytes=True)
    same, long, before, several = np.frombuffer(raw, np.uint8, 4 * n).reshape(4, n).tolist()
    at, last, suffixes, befores = 4 * n, b"", [], []
    for k, size_of in zip(same, long):
        last = last[:k] + raw[at : at + size_of - k]
        at += size_of - k
        suffixes.append(last)
    for size_of in before:
        befores.append(raw[at : at + size_of])
        at += size_of
    return suffixes, same, befores, several


def repeated_offsets(lengths, same, befores, counts):
    """For merged suffixes the least and the most bytes before them of a repeated span.

    A span of an anchor begins o bytes before it. Two anchors have it in common if
    their suffixes share SPAN - o bytes and the bytes before share o: both are
    classes of neighbours in sorted order, cut where the common prefix is shorter.
    Spans of one anchor overlap, so the ends are all that is needed; none is (SPAN, -1).
    """
    n = len(lengths)
    low, high = np.full(n, SPAN, np.int64), np.full(n, -1, np.int64)
    near = same >= SHARED
    near[:-1] |= same[1:] >= SHARED
    rows = np.flatnonzero(near | (counts > 1))
    if not len(rows):
        return low, high
    lengths, same, counts = lengths[rows], same[rows], counts[rows]
    turned = [befores[i][::-1] for i in rows]
    order = sorted(range(len(rows)), key=turned.__getitem__)
    alike = np.array([0, *(common_prefix(turned[a], turned[b]) for a, b in zip(order, order[1:]))])
    order = np.array(order)
    least, most = SPAN - lengths, np.array([len(t) for t in turned])
    own_low, own_high = np.full(len(rows), SPAN, np.int64), np.full(len(rows), -1, np.int64)
    classes = np.empty(len(rows), np.int64)
    for o in range(WINDOW):
        there = np.flatnonzero((least <= o) & (o <= most))
        if not len(there):
            continue
        after = np.cumsum(same < SPAN - o)
        classes[order] = np.cumsum(alike < o) if o else 0
        keys = after[there] * (len(rows) + 1) + classes[there]
        _, of = np.unique(keys, return_inverse=True)
        repeated = there[np.bincount(of, counts[there])[of] > 1]
        own_low[repeated] = np.minimum(own_low[repeated], o)
        own_high[repeated] = o
    low[rows], high[rows] = own_low, own_high
    return low, high


def merged_offsets(pieces):
    """Offsets of every suffix of front-coded pieces of one range, piece by piece."""
    runs = [front_decoded(*p) for p in pieces]
    merged = list(LoserTree([(r[0], r[1]) for r in runs]))
    lengths = np.array([len(runs[r][0][i]) for r, i, _ in merged])
    same = np.array([k for _, _, k in merged])
    befores = [runs[r][2][i] for r, i, _ in merged]
    counts = np.array([runs[r][3][i] for r, i, _ in merged])
    found = [np.empty((2, len(r[0])), np.int64) for r in runs]
    low, high = repeated_offsets(lengths, same, befores, counts)
    for (r, i, _), a, b in zip(merged, low, high):
        found[r][:, i] = a, b
    return found


def _anchor_hashes(batches):
    """(hash, content, twice) of the distinct suffix beginnings of each text."""
    reader = AnchorReader()
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        content = batch.column(0).to_numpy(zero_copy_only=False)
        text, _, _, anchor = reader.read(data, bounds)
        hashes = reader.hashes(data, anchor)
        order = np.lexsort((hashes, text))
        text, hashes = text[order], hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
        first = np.flatnonzero(new)
        number = np.diff(np.concatenate([first, [len(order)]]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[first]), pa.array(content[text[first]]), pa.array(number > 1)],
            names=["h", "c", "twice"],
        )


def _suffixes(batches):
    """(id, place, suffix, bytes before) of the anchors of texts that were marked."""
    reader = AnchorReader()
    seen = set()
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        keys, marks = batch.column("key").to_pylist(), batch.column("hs")
        data, bounds = utf8(batch.column("text"))
        text, first, last, anchor = reader.read(data, bounds)
        wanted = np.isin(reader.hashes(data, anchor), marks.flatten().to_numpy(zero_copy_only=False))
        fresh = np.array([not (k in seen or seen.add(k)) for k in keys], bool)
        for i in np.flatnonzero(wanted & fresh[text]):
            t, a = int(text[i]), int(anchor[i])
            yield (
                int(ids[t]),
                a - int(bounds[t]),
                data[a : int(last[i]) + SPAN].tobytes(),
                data[int(first[i]) : a].tobytes(),
            )
        if len(seen) > 1_000_000:
            seen.clear()


def _sorted_pieces(rows, cuts, splits):
    """One sorted run cut into ranges: (range, n, packed, size, refs) for each.

    A range between two cuts is split further by a hash of the beginnings, so there
    are as many ranges as the suffixes need, however few cuts the sample gave. Equal suffixes with equal bytes before are one, however many there are; refs
    has the id and place of each of them, and which one it is.
    """
    rows.sort(key=lambda r: (r[2], r[3]))
    pieces, last = {}, None
    for ident, place, suffix, before in rows:
        if last != (suffix, before):
            last = (suffix, before)
            begin = suffix[:SHARED]
            at = int(np.searchsorted(cuts, begin, "right")) if len(cuts) else 0
            at = at * splits + zlib.crc32(begin) % splits
            piece = pieces.setdefault(at, ([], [], [], []))
            piece[0].append(suffix)
            piece[1].append(before)
            piece[2].append(0)
        piece[2][-1] = min(piece[2][-1] + 1, 2)
        piece[3].append((len(piece[0]) - 1, ident, place))
    for at, (suffixes, befores, several, refs) in pieces.items():
        packed, size = front_coded(suffixes, befores, several)
        yield at, len(suffixes), packed, size, np.array(refs, np.int64).T.tobytes()


def _cuts(texts, total):
    """Suffix beginnings that cut all suffixes into ranges, from a bounded sample,
    and the number of parts that each of these needs yet."""
    ranges = -(-total // RANGE_SUFFIXES)
    if ranges < 2:
        return [], 1

    def beginnings(batches):
        rows = [[s[:SHARED]] for _, _, s, _ in _suffixes(batches)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary())], names=["s"])

    share = min(1.0, SAMPLE_TEXTS / max(texts.count(), 1))
    sample = texts.sample(share, seed=3).mapInArrow(beginnings, "s binary")
    picked = sorted(bytes(r.s) for r in sample.orderBy(F.rand(3)).limit(SAMPLE_SUFFIXES).collect())
    cuts = sorted({picked[len(picked) * i // ranges] for i in range(1, ranges)}) if picked else []
    return cuts, -(-ranges // (len(cuts) + 1))


def _contexts(batches):
    """(piece, i, n, several, whole, before) of every suffix of front-coded pieces."""
    for batch in batches:
        for piece, packed, size, n in zip(*(batch.column(c).to_pylist() for c in ("piece", "packed", "size", "n"))):
            suffixes, _, befores, several = front_decoded(packed, size, n)
            wholes = [b + s for b, s in zip(befores, suffixes)]
            columns = [pa.array([piece] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32())]
            columns += [pa.array(several, pa.int32()), pa.array(wholes, pa.binary())]
            columns.append(pa.array([len(b) for b in befores], pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "i", "n", "several", "whole", "before"])


def crowded_offsets(pieces):
    """(piece, offsets) as ``merged_offsets`` gives them, for pieces of crowded ranges.

    The contexts of one beginning may be too many to meet in one task. Each span
    of theirs goes by its own digest, counted before the shuffle.
    """
    kinds = "piece long, i int, n int, several int, whole binary, before int"
    contexts = written_table(pieces.mapInArrow(_contexts, kinds), "suffix-contexts")
    starts = F.explode(F.sequence(F.lit(0), F.octet_length("whole") - SPAN))
    spans = contexts.select("*", starts.alias("start")).select(
        "piece", "i", "n", "several", (F.col("before") - F.col("start")).alias("o"),
        F.unhex(F.md5(F.substring("whole", F.col("start") + 1, F.lit(SPAN)))).alias("digest"),
    )
    twice = spans.groupBy("digest").agg(F.sum("several").alias("held")).filter("held > 1").select("digest")
    repeated = spans.join(twice, "digest").groupBy("piece", "n", "i").agg(F.min("o").alias("low"), F.max("o").alias("high"))
    # One row for each suffix of a piece, which a run bounds.
    answers = repeated.groupBy("piece", "n").agg(F.collect_list(F.struct("i", "low", "high")).alias("found"))

    def packed(batches):
        for batch in batches:
            offsets = []
            for n, found in zip(batch.column("n").to_pylist(), batch.column("found")):
                i, low, high = (found.values.field(c).to_numpy() for c in range(3))
                out = np.stack([np.full(n, SPAN, np.int64), np.full(n, -1, np.int64)])
                out[:, i] = low, high
                offsets.append(out.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(offsets, pa.binary())], names=["piece", "offsets"])

    return answers.mapInArrow(packed, "piece long, offsets binary")


def repeated_places(docs, key, text):
    """(key, first, end) byte ranges of all texts that lie in repeated spans, but for
    spans that only copies of one whole text have in common.

    Texts are told apart by a hash of the whole; a suffix beginning that only one
    of them has, once, is dropped. The others are sorted in runs, exchanged front-
    coded by ranges of their beginnings and merged by a loser tree. Only the
    distinct suffixes of a run travel; where they stand stays with the run and
    meets the answer by the number of its piece. A crowded range is not gathered:
    its spans are counted by digest.
    """
    rows = docs.select(column(key).alias("key"), F.xxhash64(column(text)).alias("c"), column(text).alias("text"))
    rows = rows.filter(F.octet_length("text") >= SPAN)
    anchors = rows.select("c", "text").mapInArrow(_anchor_hashes, "h long, c long, twice boolean")
    anchors = written_table(anchors, "suffix-anchors")
    dups = anchors.groupBy("h").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.max("twice").alias("twice")
    )
    dups = dups.filter("low <> high OR twice").select("h")
    marks = anchors.select("h", "c").join(dups, "h").groupBy("c").agg(F.collect_set("h").alias("hs"))
    texts = rows.join(marks, "c").select("key", "text", "hs", F.monotonically_increasing_id().alias("id"))
    texts = written_table(texts, "suffix-texts")
    total = texts.agg(F.sum(F.size("hs"))).first()[0] or 0
    cuts, splits = _cuts(texts, total)

    def runs(batches):
        sliced = np.array(cuts, dtype=object)
        held = []
        for row in _suffixes(batches):
            held.append(row)
            if len(held) >= RUN_SUFFIXES:
                yield _piece_batch(_sorted_pieces(held, sliced, splits))
                held = []
        yield _piece_batch(_sorted_pieces(held, sliced, splits))

    pieces = texts.mapInArrow(runs, "range long, n int, packed binary, size long, refs binary")
    pieces = written_table(pieces.withColumn("piece", F.monotonically_increasing_id()), "suffix-pieces")

    def merge(table):
        rows = table.select(["packed", "size", "n"]).to_pylist()
        found = merged_offsets([(r["packed"], r["size"], r["n"]) for r in rows])
        return pa.table({"piece": table.column("piece"), "offsets": pa.array([f.tobytes() for f in found], pa.binary())})

    crowded = pieces.groupBy("range").agg(F.sum("n").alias("total")).filter(F.col("total") > CROWDED * RANGE_SUFFIXES)
    crowded = written_table(crowded.select("range"), "suffix-crowded")
    moved = pieces.select("range", "piece", "packed", "size", "n")
    merged = moved.join(crowded, "range", "left_anti").groupBy("range").applyInArrow(merge, "piece long, offsets binary")
    if not crowded.isEmpty():
        merged = merged.unionByName(crowded_offsets(moved.join(crowded, "range")))

    def placed(batches):
        for batch in batches:
            out = [np.zeros((3, 0), np.int64)]
            for refs, offsets in zip(batch.column("refs"), batch.column("offsets")):
                which, ids, places = np.frombuffer(refs.as_buffer(), np.int64).reshape(3, -1)
                low, high = np.frombuffer(offsets.as_buffer(), np.int64).reshape(2, -1)[:, which]
                there = high >= 0
                out.append(np.stack([ids, places - high, places - low + SPAN])[:, there])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(out, axis=1)], names=["id", "first", "end"])

    answered = pieces.select("piece", "refs").join(merged, "piece").select("refs", "offsets")
    found = answered.mapInArrow(placed, "id long, first long, end long")
    spans = found.groupBy("id").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    return texts.select("id", "key", "text").join(spans, "id")


def _piece_batch(pieces):
    kinds = [("range", pa.int64()), ("n", pa.int32()), ("packed", pa.binary()), ("size", pa.int64()), ("refs", pa.binary())]
    columns = list(zip(*pieces)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])


def union(spans):
    """Ranges as few ranges that neither meet nor overlap, in order."""
    out = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def _cut(raw, spans):
    """What is left of a text without the ranges."""
    at, out = 0, []
    for first, end in spans:
        out.append(raw[at:first])
        at = end
    return b"".join([*out, raw[at:]])


EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def remove_repeats(docs, text="text", carry=None, kept_text=False):
    """``docs`` with n_bytes, n_removed, n_spans and kept_sha256 of each text.

    Every byte that lies in a string of ``SPAN`` bytes which stands anywhere else,
    in another row or in the same, is removed; n_spans counts the maximal removed
    ranges, kept_sha256 is of the other bytes, and with ``kept_text`` they are the
    column kept_text, a character that is cut through becoming U+FFFD and null staying so.

    All copies of a text of at least ``SPAN`` bytes are removed whole; otherwise
    one row stands for equal texts. Null and empty texts have no bytes and lose
    none, as do texts shorter than ``SPAN``. Long texts are read whole, in parts.
    Columns with the names of results give way; an empty table gives an empty one.
    """
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * kept_text
    taken = {m.lower() for m in made}
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in taken]
    rows = docs.select(packed(names), column(text).alias("text"))
    whole_text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.withColumn("key", F.sha2(whole_text, 256))
    rows = rows.withColumn("n_bytes", F.octet_length(whole_text).cast("long"))
    copies = rows.groupBy("key").agg(F.count("*").alias("n"), F.first("n_bytes").alias("size"))
    whole = copies.filter((F.col("n") > 1) & (F.col("size") >= SPAN))

    def results(batches):
        for batch in batches:
            keys, removed, numbers, digests, texts = batch.column("key"), [], [], [], []
            for raw, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = raw.encode()
                spans = union((s["first"], s["end"]) for s in spans)
                left = _cut(raw, spans)
                removed.append(len(raw) - len(left))
                numbers.append(len(spans))
                digests.append(hashlib.sha256(left).hexdigest())
                texts.append(left.decode(errors="replace") if kept_text else None)
            columns = [keys, pa.array(removed, pa.int64()), pa.array(numbers, pa.int64())]
            columns += [pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    kinds = [("key", StringType()), ("n_removed", LongType()), ("n_spans", LongType())]
    kinds += [("kept_sha256", StringType()), ("kept_text", StringType())]
    schema = StructType([StructField(n, t) for n, t in kinds])
    gone = whole.select(
        "key",
        F.col("size").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.lit(EMPTY_SHA).alias("kept_sha256"),
        F.lit("").alias("kept_text"),
    )
    with scratch(docs.sparkSession) as keep:
        found = repeated_places(rows, "key", "text")
        found = found.join(whole.select("key"), "key", "left_anti")
        cut = found.select("key", "text", "spans").mapInArrow(results, schema)
        changed = keep(cut.unionByName(gone), "suffix-results")
    shown = rows if kept_text else rows.drop("text")
    answered = shown.join(changed, "key", "left").select(
        "row",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "key").alias("kept_sha256"),
        *([F.coalesce("kept_text", "text").alias("kept_text")] if kept_text else []),
    )
    return unpacked(answered, names)
