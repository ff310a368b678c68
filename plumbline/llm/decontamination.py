"""Words of documents that occur in benchmark items, found by winnowed fingerprints."""

import hashlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType

from plumbline.llm.arrow import append_columns, column, free_of, packed, unpacked
from plumbline.llm.joins import spread_join
from plumbline.llm.words import NONE, WordReader, blocks, plain_word_bytes, run_hashes, utf8, window_minima
from plumbline.session import scratch, written_table

SPAN = 13
GRAM = 5
BLOCK_BYTES = 1 << 20
#: A benchmark of at most so many bytes is broadcast; fingerprints of a larger one are joined.
BROADCAST_BYTES = 16 << 20
#: Items that a document is compared with at once where fingerprints are joined, about.
PART_ITEMS = 64


def winnowed(hashes, of, span, gram):
    """Places of the smallest of the ``span - gram + 1`` hashes in each window.

    Equal spans of ``span`` words have equal smallest hashes, so two texts that
    share a span share one of these at the same place in it.
    """
    grams = run_hashes(hashes, of, gram)
    w = span - gram + 1
    if w == 1:
        return np.flatnonzero(grams != NONE), grams
    least = window_minima(grams, w)
    kept = np.zeros(len(grams), bool)
    for step in range(w):
        kept[step:] |= grams[step:] == least[: len(grams) - step]
    return np.flatnonzero(kept & (grams != NONE)), grams


class Items:
    """Fingerprints of one part of the benchmark, ready to be looked up.

    Items of fewer than ``span`` words are windows by themselves: they are kept
    by their number of words and looked up at every place.
    """

    def __init__(self, ids, texts, span, gram):
        reader = WordReader(plain_word_bytes())
        self.span, self.ids, self.words, self.hashes = span, ids, [], []
        places = defaultdict(lambda: defaultdict(list))
        for number, text in enumerate(texts):
            raw = np.frombuffer(text.encode(), np.uint8)
            first, end, of, hashes = reader.read(raw, np.array([0, len(raw)]))
            lower = bytes(reader.lower[raw])
            self.words.append([lower[a:b] for a, b in zip(first, end)])
            self.hashes.append(hashes)
            n = len(hashes)
            if n:
                shape = (span, gram) if n >= span else (n, n)
                kept, grams = winnowed(hashes, of, *shape)
                for p in kept:
                    places[shape][int(grams[p])].append((number, int(p)))
        self.shapes = [
            (*shape, np.array(sorted(found), np.uint64), dict(found)) for shape, found in sorted(places.items())
        ]


class Scanner:
    """Finds in blocks of texts every place of an item's window."""

    def __init__(self):
        self.reader = WordReader(plain_word_bytes())

    def scan(self, items, data, bounds):
        """Numbers of words of the texts, and hits as {text: [(first, end word, item)]}."""
        first, end, of, hashes = self.reader.read(data, bounds)
        numbers = np.bincount(of, minlength=len(bounds) - 1)
        offsets = np.concatenate([[0], np.cumsum(numbers)])
        hits = defaultdict(list)
        for span, gram, known, places in items.shapes:
            kept, grams = winnowed(hashes, of, span, gram)
            at = np.searchsorted(known, grams[kept])
            at[at == len(known)] = 0
            done = {}
            for p in kept[known[at] == grams[kept]]:
                text = int(of[p])
                low, high = int(offsets[text]), int(offsets[text + 1])
                for item, q in places[int(grams[p])]:
                    line = (text, item, int(p) - q)
                    if done.get(line, -1) > p:
                        continue
                    a, b = self._extended(items, item, hashes, int(p), q, gram, low, high)
                    done[line] = b
                    if b - a >= span and self._same(items, item, data, first, end, a, b, a - (int(p) - q)):
                        hits[text].append((a - low, b - low, item))
        return numbers, hits

    def _extended(self, items, item, hashes, p, q, gram, low, high):
        theirs = items.hashes[item]
        left = min(p - low, q)
        same = hashes[p - left : p] == theirs[q - left : q]
        unlike = np.flatnonzero(~same)
        a = p - left + (int(unlike[-1]) + 1 if len(unlike) else 0)
        right = min(high - p, len(theirs) - q)
        unlike = np.flatnonzero(hashes[p : p + right] != theirs[q : q + right])
        return a, p + (int(unlike[0]) if len(unlike) else right)

    def _same(self, items, item, data, first, end, a, b, at):
        lower = self.reader.lower
        return all(bytes(lower[data[first[i] : end[i]]]) == items.words[item][at + i - a] for i in range(a, b))


def covered(ranges):
    """The number of words in a union of ranges."""
    total, reach = 0, 0
    for a, b in sorted(ranges):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _windows_by_place(hashes, of, span, gram):
    """Each kept place of ``winnowed`` with the hashes of the windows that keep it.

    Gives (places, gram hashes, numbers of windows, window hashes one place after the
    other). Equal windows have their place at the same distance, so two texts share a
    window exactly where they share a gram hash and, of that, a window hash.
    """
    kept, grams = winnowed(hashes, of, span, gram)
    windows, w = run_hashes(hashes, of, span), span - gram + 1
    least = window_minima(grams, w)
    place, found = [], []
    for back in range(w):
        at = kept[kept >= back]
        start = at - back
        own = (windows[start] != NONE) & (grams[at] == least[start]) & (of[start] == of[at])
        place.append(at[own])
        found.append(windows[start[own]])
    place, found = np.concatenate(place), np.concatenate(found)
    order = np.argsort(place, kind="stable")
    kept, counts = np.unique(place, return_counts=True)
    return kept, grams[kept], counts, found[order]


def _fingerprints(batches, shapes=None):
    """(size, hash, windows, key) of the fingerprints of each text: of an item's own window
    size, or those of ``shapes`` for a document."""
    reader = WordReader(plain_word_bytes())
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        for low, high in blocks(bounds, BLOCK_BYTES):
            _, _, of, words = reader.read(data, bounds[low : high + 1])
            numbers = np.bincount(of, minlength=high - low)
            for size, span, gram in shapes(numbers):
                kept, grams, counts, windows = _windows_by_place(words, of, span, gram)
                if shapes.own:
                    there = np.minimum(numbers[of[kept]], shapes.span) == size
                    windows = windows[np.repeat(there, counts)]
                    kept, grams, counts = kept[there], grams[there], counts[there]
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(windows.view(np.int64)))
                keys = batch.column(0).take(pa.array(of[kept] + low))
                columns = [pa.array(np.full(len(kept), size, np.int32)), pa.array(grams.view(np.int64)), lists, keys]
                yield pa.RecordBatch.from_arrays(columns, names=["size", "hash", "windows", "key"])


@dataclass(frozen=True)
class Shapes:
    """(window size, span, gram) of the windows to be fingerprinted in texts of so many words."""

    span: int
    gram: int
    sizes: tuple = ()
    own: bool = False

    def __call__(self, numbers):
        sizes = np.unique(np.minimum(numbers[numbers > 0], self.span)) if self.own else self.sizes
        return [(int(n), self.span, self.gram) if n == self.span else (int(n), int(n), int(n)) for n in sizes]


def _contained(rows, items, span, gram):
    """(key, ranges, items): hit words and items of each text of ``rows`` that has any.

    ``rows`` has key and text, ``items`` item, id and text. A document's fingerprints
    that no item has are dropped first; the others bring the hashes of the windows
    that keep them, and a document meets an item only under a window that both have,
    not under every phrase of ``gram`` words. Both are then compared in full,
    ``PART_ITEMS`` items at a time, so no document's items meet in one place.
    """
    kinds = "size int, hash long, windows array<long>, key"
    own = Shapes(span, gram, own=True)
    theirs = items.select("item", "text").mapInArrow(lambda b: _fingerprints(b, own), f"{kinds} long")
    theirs = written_table(theirs.withColumnRenamed("key", "item"), "leak-items")
    # One size for each number of words up to the span.
    sizes = tuple(r["size"] for r in theirs.select("size").distinct().collect())
    every = Shapes(span, gram, sizes)
    known = theirs.groupBy(F.xxhash64("size", "hash").alias("print")).agg(F.count("*").alias("copies"), F.lit(True).alias("known"))
    known = written_table(known, "leak-prints")
    ours = rows.mapInArrow(lambda b: _fingerprints(b, every), f"{kinds} string")
    ours = ours.withColumn("print", F.xxhash64("size", "hash"))
    ours = spread_join(ours, known, "print", "copies", local=False).filter("known")
    ours = ours.select("size", "key", F.explode("windows").alias("window")).distinct()
    theirs = theirs.select("size", "item", F.explode("windows").alias("window")).distinct()
    pairs = written_table(ours.join(theirs, ["size", "window"]).select("key", "item").distinct(), "leak-pairs")
    met = pairs.groupBy("key").agg(F.ceil(F.count("*") / PART_ITEMS).alias("parts"))
    some = pairs.join(met, "key").withColumn("part", F.pmod(F.xxhash64("item"), F.col("parts")))
    some = some.join(items.withColumnRenamed("text", "item_text"), "item")
    some = some.groupBy("key", "part").agg(F.collect_list(F.struct("id", "item_text")).alias("items"))
    texts = rows.join(met.select("key"), "key", "left_semi").dropDuplicates(["key"])

    def compare(batches):
        scanner = Scanner()
        for batch in batches:
            keys, ranges, names = [], [], []
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                raw = np.frombuffer(row["text"].encode(), np.uint8)
                held = Items([i["id"] for i in row["items"]], [i["item_text"] for i in row["items"]], span, gram)
                hits = scanner.scan(held, raw, np.array([0, len(raw)]))[1].get(0)
                if hits:
                    keys.append(row["key"])
                    ranges.append([{"a": a, "b": b} for a, b in {(int(a), int(b)) for a, b, _ in hits}])
                    names.append(list({held.ids[i] for _, _, i in hits}))
            kinds = [pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.list_(pa.string())]
            columns = [pa.array(v, t) for v, t in zip((keys, ranges, names), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "ranges", "items"])

    schema = "key string, ranges array<struct<a: long, b: long>>, items array<string>"
    found = texts.join(some, "key").select("key", "text", "items").mapInArrow(compare, schema)
    return found.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ranges")))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def _join_contamination(docs, items, text, span, gram, share, carry):
    """The result of ``find_contamination`` for a benchmark that is not broadcast."""
    whole = F.coalesce(column(text), F.lit(""))
    key = F.sha2(whole, 256)
    with scratch(docs.sparkSession) as keep:
        items = written_table(items.withColumn("item", F.monotonically_increasing_id()), "leak-benchmark")
        found = _contained(docs.select(key.alias("key"), whole.alias("text")), items, span, gram)
        found = keep(found, "leak-hits")

    def start():
        reader = WordReader(plain_word_bytes())

        def compute(array):
            data, bounds = utf8(array)
            numbers = np.zeros(len(array), np.int64)
            for low, high in blocks(bounds, BLOCK_BYTES):
                of = reader.read(data, bounds[low : high + 1])[2]
                numbers[low:high] = np.bincount(of, minlength=high - low)
            return [pa.array(numbers)]

        return compute

    made = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"]
    kept = free_of(docs.columns if carry is None else carry, made)
    rows = docs.select(packed(kept), key.alias("key"), whole.alias("text"))
    rows = append_columns(rows, "text", [("n_words", LongType())], start, carry=["row", "key"])
    zero = F.lit(0).cast("long")

    def add(state, r):
        more = F.greatest(zero, r["b"] - F.greatest(r["a"], state["reach"]))
        return F.struct((state["total"] + more).alias("total"), F.greatest(state["reach"], r["b"]).alias("reach"))

    start_state = F.struct(zero.alias("total"), zero.alias("reach"))
    hit = F.coalesce(F.aggregate("ranges", start_state, add, lambda state: state["total"]), zero)
    names = F.coalesce(F.array_join("items", ","), F.lit(""))
    answered = rows.join(found, "key", "left").select(
        "row",
        "n_words",
        hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        names.alias("items"),
        F.sha2(names, 256).alias("items_sha256"),
    )
    answered = answered.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
    return unpacked(answered, kept)


def find_contamination(
    docs,
    benchmark,
    text="text",
    item_id="item_id",
    item_text="text",
    span=SPAN,
    gram=GRAM,
    share=20,
    broadcast_bytes=BROADCAST_BYTES,
    carry=None,
    unnamed=False,
):
    """``docs`` with the words that lie in a benchmark window, and the items met.

    New columns: n_words, n_hit, n_items, items (their ids, sorted as strings),
    contaminated (``share * n_hit >= n_words`` and any hit). A window is ``span``
    consecutive words of an item, or a shorter item's words. Both sides keep the
    smallest ``gram``-word hash of each window, which guarantees a common one for
    each shared span; what the look-up finds is extended to the left and right
    and compared word by word.

    A benchmark of at most ``broadcast_bytes`` goes to every task, and the
    documents do not move. Fingerprints of a larger one are joined with those of
    the documents by a shuffle. Both ways give the same rows.

    Null and empty texts have no words and no hits; items with null text are left
    out, and so are those with null id but with ``unnamed``: their windows then
    count for n_hit and contaminated, all of them are one of n_items, and items
    does not list them. Items with one id count once. Repeated rows are judged each,
    long texts are read whole, a column with the name of a result gives way, and
    an empty benchmark hits nothing.
    """
    if not 0 < gram <= span:
        raise ValueError("a fingerprint has 1 to span words")
    items = benchmark.select(column(item_id).cast("string").alias("id"), column(item_text).alias("text"))
    items = items.dropna(subset=["text"] if unnamed else ["id", "text"])
    bytes_of = F.octet_length("text") + F.coalesce(F.octet_length("id"), F.lit(0)) + 16
    size = items.agg(F.sum(bytes_of)).first()[0] or 0
    if size > broadcast_bytes:
        return _join_contamination(docs, items, text, span, gram, share, carry)
    whole = items.toArrow()
    whole = whole["id"].to_pylist(), whole["text"].to_pylist()
    shared = docs.sparkSession.sparkContext.broadcast(whole)

    def start():
        scanner, items = Scanner(), Items(*shared.value, span, gram)

        def compute(array):
            data, bounds = utf8(array)
            numbers, hit = np.zeros(len(array), np.int64), np.zeros(len(array), np.int64)
            names, met = [[] for _ in range(len(array))], np.zeros(len(array), np.int64)
            for low, high in blocks(bounds, BLOCK_BYTES):
                n, hits = scanner.scan(items, data, bounds[low : high + 1])
                numbers[low:high] = n
                for number, found in hits.items():
                    hit[low + number] = covered((a, b) for a, b, _ in found)
                    ids = {items.ids[i] for _, _, i in found}
                    met[low + number] = len(ids)
                    names[low + number] = sorted(ids - {None})
            return [
                pa.array(numbers),
                pa.array(hit),
                pa.array(met),
                pa.array([",".join(x) for x in names], pa.string()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
                pa.array((hit > 0) & (share * hit >= numbers)),
            ]

        return compute

    fields = [
        ("n_words", LongType()),
        ("n_hit", LongType()),
        ("n_items", LongType()),
        ("items", StringType()),
        ("items_sha256", StringType()),
        ("contaminated", BooleanType()),
    ]
    return append_columns(docs, text, fields, start, carry)


def decontaminated(docs, benchmark, text="text", **options):
    """The documents that are not contaminated, with the columns they came with."""
    rows = docs.select(packed(docs.columns), column(text).alias("text"))
    judged = find_contamination(rows, benchmark, "text", carry=["row"], **options)
    return unpacked(judged.filter(~F.col("contaminated")).select("row"), docs.columns)
