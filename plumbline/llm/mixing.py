"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.llm.arrow import column, free_of, packed, unpacked
from plumbline.session import scratch, written_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
#: Documents of one source and size that are ranked in one task, about.
CELL_ROWS = 20_000

WORD_BREAK = r"[\x20\x09-\x0D]+"


def n_words(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column; null has none."""
    parts = F.size(F.split(text, WORD_BREAK))
    first = text.rlike(r"^[\x20\x09-\x0D]").cast("int")
    last = text.rlike(r"[\x20\x09-\x0D]\z").cast("int")
    # A text of breaks alone is split into two empty parts, an empty one into one.
    return F.when(text.isNull() | (text == ""), 0).otherwise(parts - first - last).cast("long")


def source_targets(sizes, weights=WEIGHTS, share=SHARE, most=MOST):
    """One row per source of ``sizes`` (source, source_size): its target size.

    Sources in code point order, null last, have the weights in turn, repeating,
    and share ``share`` of all sizes by weight. No target is above ``most`` times
    the source's size; the excess goes to the others by weight until none is.
    That is the level L at which the sum of min(most * size, L * weight) is the
    whole: the sources with the least size per weight are full, and L follows
    from the first number of full sources for which the next one is not.

    The windows run over one row per source, not over documents.
    """
    by_source = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(by_source) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("whole"),
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
    )
    level = (F.col("whole") - F.col("full")) / F.col("open")
    rows = rows.withColumn("level", level).withColumn(
        "level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(everything)
    )
    target = F.least(F.col("most"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def mix_sources(docs, doc_id="doc_id", text="text", source="source", weights=WEIGHTS, seed="mix", carry=()):
    """Each document with the copies that the mix takes of it, all sources near their targets.

    Columns: doc_id, size (words), source_size, target, copies, taken (copies
    times size), and those of ``carry``, which give way to equal names.

    A document's expected copies are its source's target by its size. Within a
    source the documents stand by size, then by md5 of the id; the prefix sum of
    expected copies, moved by one offset in [0, 1) for each source, gives a
    document one copy for each whole number it passes. Neighbours have like
    sizes, so the taken words stay within about one of the longest documents of
    the target, and no document is taken more than twice. The offset is a hash of
    the source and ``seed``, so every run takes the same.

    The position of a document is the number of those of smaller size, from
    counts by size, those of earlier parts of its own size, and its rank in its
    part; parts are ranges of the md5 with about ``CELL_ROWS`` rows, so a hot
    source or size is ranked by many tasks.

    A null text has size 0; a null source is a source, the last one. Null ids
    stand first of their size. Rows with equal ids and sizes stand in any order
    among themselves, so that copies of a row may differ in what is taken, but
    their number does not. An empty table gives an empty mix.
    """
    kept = free_of(carry, ["doc_id", "size", "source_size", "target", "copies", "taken"])
    with scratch(docs.sparkSession) as keep:
        sized = written_table(
            docs.select(
                column(doc_id).alias("doc_id"),
                column(source).alias("source"),
                n_words(column(text)).alias("size"),
                F.coalesce(F.md5(column(doc_id).cast("string")), F.lit("0" * 32)).alias("hash"),
                packed(kept),
            ),
            "mix-sizes",
        )
        counts = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
        cells = written_table(_cells(counts, weights), "mix-cells")
        cell = F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("size") == F.col("cell_size"))
        part = F.floor(_unit("hash") * F.ceil(F.col("n") / CELL_ROWS))
        rows = sized.join(cells, cell).withColumn("part", part)
        rows = written_table(rows.drop("cell_source", "cell_size"), "mix-rows")
        by_part = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = rows.groupBy("cell", "part").agg(F.count("*").alias("m"))
        parts = parts.select("cell", "part", F.coalesce(F.sum("m").over(by_part), F.lit(0)).alias("earlier"))
        in_part = Window.partitionBy("cell", "part").orderBy("hash", "doc_id")
        placed = rows.withColumn("rank", F.row_number().over(in_part)).join(parts, ["cell", "part"])
        place = F.col("smaller") + F.col("earlier") + F.col("rank")
        expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        offset = _unit(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))))
        copies = F.floor(place * expected + offset) - F.floor((place - 1) * expected + offset)
        mixed = placed.select(
            "doc_id",
            "size",
            "source_size",
            "target",
            copies.cast("long").alias("copies"),
            (copies * F.col("size")).cast("long").alias("taken"),
            "row",
        )
        return keep(unpacked(mixed, kept), "mix")


def _unit(hexadecimal):
    """The first 32 bits of a hexadecimal string as a number in [0, 1)."""
    return F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def _cells(counts, weights):
    """One row per source and size: its documents, those of smaller size, and the target."""
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, weights).withColumnRenamed("source", "of")
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.withColumn("smaller", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
    return rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        F.monotonically_increasing_id().alias("cell"),
        F.col("source").alias("cell_source"),
        F.col("size").alias("cell_size"),
        F.col("n").alias("n"),
        "smaller",
        "source_size",
        "target",
    )
