"""Vector codes: equal parts of vectors by their nearest codebook entries."""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from plumbline.llm import vectors
from plumbline.llm.arrow import column, free_of
from plumbline.llm.joins import spread_join

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Two hex digits name an entry.
MOST_ENTRIES = 256
WORD = 64

def above_root(squares):
    """Whole numbers above the square roots."""
    if squares.dtype == object:
        return np.array([math.isqrt(n) + 1 for n in squares.tolist()], dtype=object)
    return np.sqrt(squares.astype(np.float64)).astype(np.int64) + 1



class Codebook:
    """Finds the nearest entry of one part position's codebook by bitmasks.

    In each dimension the entries' coordinates stand in order, and with each place
    goes the mask of the entries before it. A row's distance to its neighbours in
    that order gives a radius; the entries within the radius in one dimension are
    the difference of two masks, and those within it in all dimensions the common
    bits. Their distances are computed, and the lowest of the nearest wins.
    """

    def __init__(self, entries, dims):
        self.exact = np.array(entries, dtype=object).reshape(len(entries), dims)
        self.sides = {}

    def side(self, kind):
        """Coordinates as this type, in order of each dimension, and the masks there."""
        if kind not in self.sides:
            values = self.exact.astype(kind)
            n, dims = values.shape
            bits = np.zeros((n, -(-n // WORD)), np.uint64)
            bits[np.arange(n), np.arange(n) // WORD] = np.uint64(1) << (np.arange(n) % WORD).astype(np.uint64)
            order = [np.argsort(values[:, d], kind="stable") for d in range(dims)]
            none = np.zeros((1, bits.shape[1]), np.uint64)
            masks = [np.concatenate([none, np.bitwise_or.accumulate(bits[o])]) for o in order]
            self.sides[kind] = values, order, [values[o, d] for d, o in enumerate(order)], masks
        return self.sides[kind]

    def candidates(self, rows):
        """One mask of entries for each row, which has all nearest ones."""
        values, order, coordinates, masks = self.side(rows.dtype)
        radius = None
        for d, (o, c) in enumerate(zip(order, coordinates)):
            place = np.searchsorted(c, rows[:, d])
            for near in (np.maximum(place - 1, 0), np.minimum(place, len(c) - 1)):
                gap = rows - values[o[near]]
                distance = (gap * gap).sum(axis=1)
                radius = distance if radius is None else np.minimum(radius, distance)
        reach = above_root(radius)
        found = None
        for d, (c, m) in enumerate(zip(coordinates, masks)):
            low = np.searchsorted(c, rows[:, d] - reach, "left")
            high = np.searchsorted(c, rows[:, d] + reach, "right")
            within = m[high] & ~m[low]
            found = within if found is None else found & within
        return found

    def nearest(self, rows):
        """Lowest number of the nearest entries of each row, and the squared distance."""
        masks = self.candidates(rows)
        values = self.side(rows.dtype)[0]
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)
        gap = rows[row] - values[entry]
        distance = (gap * gap).sum(axis=1)
        first = np.searchsorted(row, np.arange(len(rows)))
        least = np.minimum.reduceat(distance, first) if len(rows) else distance
        best = np.flatnonzero(distance == least[row])
        won = best[np.searchsorted(row[best], np.arange(len(rows)))]
        return entry[won], distance[won]


class Coder:
    """All codebooks of a width: lists of entries, lists of whole numbers, by part."""

    def __init__(self, books, width):
        self.dims = width // len(books)
        self.books = [Codebook(entries, self.dims) for entries in books]
        bound = vectors.small_bound(width)
        self.small = all((abs(b.exact) <= bound).all() for b in self.books)

    def parts(self, rows):
        """(part, its components, nearest entries, distances) for each part."""
        for p, book in enumerate(self.books):
            own = np.ascontiguousarray(rows[:, p * self.dims : (p + 1) * self.dims])
            yield p, own, *book.nearest(own)


def _sums(books, width, scale):
    """Per task and part: rows of each entry, then their components, summed."""

    def run(batches):
        coder = Coder(books, width)
        n, dims = len(books[0]), coder.dims
        sums = {p: np.zeros(n * (1 + dims), object) for p in range(len(books))}
        for batch in batches:
            for _, rows in vectors.integer_rows(batch.column(0), width, scale, coder.small):
                for p, own, entry, _ in coder.parts(rows):
                    sums[p][:n] += np.bincount(entry, minlength=n)
                    order = np.argsort(entry, kind="stable")
                    seen, first = np.unique(entry[order], return_index=True)
                    sums[p][n:].reshape(n, dims)[seen] += np.add.reduceat(own[order], first, axis=0)
        yield vectors.sums_batch(sums)

    return run


def moved(books, sums):
    """Each entry at the floor of the mean of its parts; one without any stays."""
    out = []
    for p, entries in enumerate(books):
        n, dims = len(entries), len(entries[0])
        total = sums[p]
        out.append(
            [
                [s // total[e] for s in total[n + e * dims : n + (e + 1) * dims]] if total[e] else entry
                for e, entry in enumerate(entries)
            ]
        )
    return out


def fit_codebooks(df, vector, usable, first, parts, entries, rounds, width, scale):
    """The codebooks after all rounds, from the vectors that ``first`` puts first."""
    start = df.filter(usable).orderBy(*first).limit(entries).select(vector.alias("v")).collect()
    whole = [vectors.integers_of(r["v"], scale) for r in start]
    dims = width // parts
    books = [[v[p * dims : (p + 1) * dims] for v in whole] for p in range(parts)]
    for _ in range(rounds if whole else 0):
        books = moved(books, vectors.totals(df, vector, usable, _sums(books, width, scale)))
    return books


def _coded(books, width, scale):
    digits = np.array([f"{i:02x}" for i in range(MOST_ENTRIES)])

    def run(batches):
        coder = Coder(books, width)
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(books)), np.int64)
            errors = np.zeros(batch.num_rows, object)
            for at, rows in vectors.integer_rows(batch.column(1), width, scale, coder.small):
                error = np.zeros(len(rows), rows.dtype)
                for p, _, entry, distance in coder.parts(rows):
                    codes[at, p] = entry
                    error = error + distance
                errors[at] = error
            texts = ["".join(c) for c in digits[codes]]
            columns = [batch.column(0), pa.array(texts, pa.string()), vectors.longs(errors)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "code", "error"])

    return run


def code_vectors(
    df,
    vec_id="vec_id",
    vector="embedding",
    label="label",
    parts=PARTS,
    entries=ENTRIES,
    rounds=ROUNDS,
    scale=SCALE,
    width=None,
    carry=None,
):
    """The usable rows of ``df`` with code, error, label_error and codebooks_sha256.

    A component x counts as the whole number floor(``scale`` * x), and vectors are cut
    into ``parts`` equal consecutive parts. The codebook of each part position starts as
    that part of the vectors with the least ids. In each round every part goes to
    the nearest entry, by squared distance and then number, and an entry with parts
    moves to the floor of their mean. code names the entries of a vector, two hex
    digits for each part; error is the sum of the distances, label_error that of
    error over the rows of one label, null labels together. codebooks_sha256 is of
    all last entries' components by part, entry and place, joined by commas.

    Each round reads the table once; tasks give one row for each part position,
    which are added without meeting in one task. Only the codebooks, ``entries`` times
    ``width`` numbers, and bounded numbers of labels reach the driver. ``entries``
    is at most 256, all that two digits can name.

    ``width`` is that of the vector with the least id if it is not given. Rows are
    left out whose vector is null, has a null or non-finite component, or has another
    width. Rows with null id count and come last; repeated rows count each, equal
    ids in the order of their vectors. With fewer vectors than ``entries`` the
    codebooks are smaller. Components of any size are exact; an error that is no
    64-bit number is null, and so is the label_error that it or the sum belongs to.
    Columns with names of results give way, and an empty table gives an empty one.
    """
    if not 1 <= entries <= MOST_ENTRIES:
        raise ValueError(f"entries must lie between 1 and {MOST_ENTRIES}, not {entries}")
    values = column(vector)
    usable = vectors.finite(values)
    first = [column(vec_id).asc_nulls_last(), values]
    if width is None:
        found = df.filter(usable & (F.size(values) > 0)).orderBy(*first).select(F.size(values)).first()
        width = found[0] if found else parts
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    usable = usable & (F.size(values) == width)
    results = ("code", "error", "label_error", "codebooks_sha256")
    kept = free_of(df.columns if carry is None else carry, results)
    books = fit_codebooks(df, values, usable, first, parts, entries, rounds, width, scale)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    named = [f"k{i}" for i in range(len(kept))]
    rows = df.select(
        *[column(k).alias(n) for k, n in zip(kept, named)], column(label).alias("label"), values.alias("vector")
    )
    fields = [("code", StringType()), ("error", LongType())]
    columns, own = [*named, "label"], F.col("vector")
    usable = vectors.finite(own) & (F.size(own) == width)
    coded = vectors.scanned(rows, own, usable, columns, _coded(books, width, scale), fields)
    total = F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error")
    sums = coded.groupBy("label").agg(total, F.count("*").alias("copies"))
    found = spread_join(coded, sums, "label", "copies")
    return found.select(
        *[F.col(n).alias(k) for k, n in zip(kept, named)],
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
