"""Row positions without moving a table through one task.

DataFrames have no order, so a position is always taken from a unique key: an integer,
string, date or decimal. Cutting a table at a position only looks for the key
found there: the cut is then a range filter on the key, which is pushed into the scan.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.session import written_table

HISTOGRAM_BINS = 4096
SORT_ROWS = 100_000
ROWS_PER_PART = 500_000
INTEGRAL = {"tinyint", "smallint", "int", "bigint"}
ORDERED = INTEGRAL | {"string", "date", "decimal"}
#: Keys that cut what is left of a table, so many counts in one pass.
SPLITTERS = 64


def _require_ordered(df, key):
    found = dict(df.dtypes)[key]
    if found.split("(")[0] not in ORDERED:
        raise TypeError(f"row order needs an integer, string, date or decimal key, {key!r} is {found}")
    return found


def _not_unique(key, position):
    return ValueError(f"{key!r} is not unique at position {position}")


def key_at(df, key, position):
    """The key at a 0-based position of the ordered table, None past its end.

    Integers are counted by histograms of the key range that still holds the position,
    other keys between splitters sampled from it; each pass keeps one part of the
    range, until the rest is small enough to sort.
    """
    kind = _require_ordered(df, key)
    here = F.col(key)
    seen = df.agg(F.count("*").alias("rows"), F.count(here).alias("n")).first()
    if seen["n"] < seen["rows"]:
        raise ValueError(f"{key!r} holds nulls, so it does not order the rows")
    if position >= seen["n"]:
        return None
    if kind in INTEGRAL:
        keys, before = _by_histograms(df.select(here.cast("long").alias("k")), seen["n"], position)
    else:
        keys, before = _by_splitters(df.select(here.alias("k")), seen["n"], position)
    start = max(before - 1, 0)
    found = [r["k"] for r in keys.orderBy("k").offset(start).limit(2).collect()]
    at = found[before - start]
    if before > start and found[0] == at:
        raise _not_unique(key, position)
    return at


def _by_histograms(keys, n, before):
    """Few keys among which the position lies, and the position among them."""
    low, high = keys.agg(F.min("k"), F.max("k")).first()
    while n > SORT_ROWS and high > low:
        step = (high - low) // HISTOGRAM_BINS + 1
        bins = (
            keys.groupBy(F.floor((F.col("k") - F.lit(low)) / F.lit(step)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
            .orderBy("bin")
            .collect()
        )
        for row in bins:
            if before < row["n"]:
                n, low, high = row["n"], row["lo"], row["hi"]
                break
            before -= row["n"]
        keys = keys.filter(F.col("k").between(low, high))
    if low == high:
        return keys.limit(2), min(before, 1)
    return keys, before


def _by_splitters(keys, n, before):
    """As ``_by_histograms``, for keys without arithmetic.

    Splitters are different keys with the least hashes, in the order that Spark
    gives keys, so that they cut the rest into parts of about equal size.
    """
    low = None
    while n > SORT_ROWS:
        stride = F.lit(max(1, n // (8 * SPLITTERS)))
        some = keys.filter(F.pmod(F.xxhash64("k"), stride) == 0).distinct().orderBy(F.xxhash64("k"), "k").limit(SPLITTERS)
        cuts = [r["k"] for r in some.orderBy("k").collect() if r["k"] != low]
        if not cuts:
            # One key, or so few kinds that none was sampled: their rows are counted each.
            some = keys.groupBy("k").count().orderBy(F.desc("count"), "k").limit(SPLITTERS)
            cuts = [r["k"] for r in some.orderBy("k").collect() if r["k"] != low]
            if not cuts:
                return keys.limit(2), min(before, 1)
        below = keys.agg(*[F.count_if(F.col("k") < F.lit(c)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        at = sum(b <= before for b in below)
        high = cuts[at] if at < len(cuts) else None
        least = below[at - 1] if at else 0
        n = (below[at] if at < len(cuts) else n) - least
        before -= least
        if at:
            low = cuts[at - 1]
            keys = keys.filter(F.col("k") >= F.lit(low))
        if high is not None:
            keys = keys.filter(F.col("k") < F.lit(high))
    return keys, before


def cap_rows(df, rows, key="row_id"):
    """The first ``rows`` rows by key; zero or less keeps the whole table."""
    if rows <= 0:
        return df
    cut = key_at(df, key, rows)
    return df if cut is None else df.filter(F.col(key) < cut)


def with_row_id(df, key, name="row_id"):
    """Dense 0-based position of every row by a unique key.

    The rows are ranged by key into partitions of about ``ROWS_PER_PART``, sorted
    and written once with their place; a position is the place in the partition
    plus the rows of those before. A null or repeated key is an error at every size.
    """
    _require_ordered(df, key)
    here = F.col(key)
    seen = df.agg(F.count("*").alias("n"), F.count(here).alias("keys"), F.count_distinct(here).alias("kinds")).first()
    if seen["keys"] < seen["n"]:
        raise ValueError(f"{key!r} holds nulls, so it does not order the rows")
    if seen["kinds"] < seen["n"]:
        raise ValueError(f"{key!r} is not unique")
    ranged = df.repartitionByRange(seen["n"] // ROWS_PER_PART + 1, key).sortWithinPartitions(key)
    placed = written_table(
        ranged.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), "ranged"
    )
    # One row for each partition.
    parts = placed.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    shifts = parts.select("_part", offset.alias("_shift"))
    numbered = placed.join(shifts, "_part").withColumn(name, F.col("_place") + F.col("_shift"))
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)
