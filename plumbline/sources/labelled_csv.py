"""Labelled CSV files as ``(row_id, features, label)`` tables."""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.parse import bad_cells, feature_array, parse_label
from plumbline.operators.labels import encode_first_seen
from plumbline.session import written_table

CORRUPT = "_corrupt_record"
BROADCAST_BYTES = 16 << 20
#: A row cap up to this many cells is read to the driver, file by file from the start.
TAKEN_CELLS = 100_000

# Label columns that would give each other away as features.
SIBLING_LABELS = {"is_malicious": ["attack_type"], "attack_type": ["is_malicious"]}


@dataclass(frozen=True)
class LabelledTable:
    rows: DataFrame
    feature_names: list[str]
    class_names: DataFrame | None = None
    rejects: DataFrame | None = None


def _header(reader, path):
    first = reader.option("header", False).csv(path).first()
    if first is None:
        raise ValueError("empty dataset")
    return [cell or "" for cell in first]


def _with_file_position(raw):
    """Dense position of each row in file order, from one read of the files.

    The rows are written once with the file split they came from and their place
    in it. Splits are ordered by file name and offset and their counts summed up;
    a row's position is its place in its split plus the rows of all splits before.
    """
    split = ["_file", "_start"]
    placed = raw.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
    )
    placed = written_table(placed, "csv-rows")
    splits = placed.groupBy(*split).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    # One row for each split of a file, so the window is small.
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    offsets = written_table(splits.select(*split, offset.alias("_offset")), "csv-splits")
    size = offsets.agg(F.sum(F.octet_length("_file") + 16)).first()[0] or 0
    joined = placed.join(F.broadcast(offsets) if size <= BROADCAST_BYTES else offsets, split)
    return joined.withColumn("row_id", F.col("_place") + F.col("_offset")).drop("_start", "_place", "_offset")


def _files(raw):
    """The files by name, as the scan's ``file_path`` has them."""
    return sorted(re.sub("^([A-Za-z0-9+.-]+):///", r"\1:/", f) for f in raw.inputFiles())


def _first_rows(raw, rows):
    """The first rows of the files, by name, with their file and position.

    Each file is read from its start, one split after the other, and no further than
    to the last row that is wanted.
    """
    found = []
    placed = raw.select("*", F.col("_metadata.file_path").alias("_file"))
    for file in _files(raw):
        found += placed.filter(F.col("_metadata.file_path") == file).take(rows - len(found))
        if len(found) >= rows:
            break
    numbered = [(*row, i) for i, row in enumerate(found)]
    schema = T.StructType([*placed.schema.fields, T.StructField("row_id", T.LongType())])
    return raw.sparkSession.createDataFrame(numbered, schema)


def _first_files(raw, rows):
    """As many of the files, by name, as hold the first ``rows`` rows."""
    files = _files(raw)
    taken = 1
    while taken < len(files):
        found = raw.filter(F.col("_metadata.file_path").isin(files[:taken]))
        if found.limit(rows).count() == rows:
            return found
        taken *= 2
    return raw


def load_labelled_csv(
    spark, path, label, max_rows=-1, text_label=False, exclude=None, multi_line=False, rejects=False
):
    """Reads CSV with a header row; every column but the label is a feature.

    Cells are numbers or True/False, a text label is numbered by first
    appearance. The other of two sibling labels, or the columns in ``exclude``,
    are left out. ``max_rows`` above zero keeps the first rows of the file; a cap of
    up to ``TAKEN_CELLS`` cells reads no split behind them. A cell that does not
    parse or a row with too few or too many cells fails the job that reads it; the
    message has the column, the cell and the row's position.

    With ``rejects`` such rows are left out instead, their positions too, and listed in
    the table's ``rejects``: file, row_id, column and cell, for each bad cell. A row with
    a wrong number of cells is listed once, without column, the cell being the row.
    """
    reader = spark.read.options(quote='"', escape='"', multiLine=multi_line)
    header = _header(reader, path)
    if label not in header:
        raise ValueError(f"label column {label!r} not found")
    if len(set(header)) < len(header):
        raise ValueError("duplicate column names in the header")
    left_out = {label, *(SIBLING_LABELS.get(label, []) if exclude is None else exclude)}
    features = [name for name in header if name not in left_out]

    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*header, CORRUPT]])
    raw = (
        reader.options(header=True, enforceSchema=False, mode="PERMISSIVE", columnPruning=False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
        .csv(path)
    )
    if not raw.take(1):
        raise ValueError("empty dataset")
    escaped = "`" + label.replace("`", "``") + "`"
    cell = F.coalesce(F.col(escaped), F.lit(""))
    # Naming the label keeps a data column in the scan: Spark refuses one of bad lines only.
    ragged = F.raise_error(
        F.concat(F.lit("wrong number of fields, label '"), cell, F.lit("': "), F.col(CORRUPT), F.lit(", row "), F.col("row_id"))
    )
    whole = F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(ragged.cast("boolean"))
    if 0 < max_rows and max_rows * len(header) <= TAKEN_CELLS:
        placed = _first_rows(raw, max_rows)
    else:
        placed = _with_file_position(_first_files(raw, max_rows) if max_rows > 0 else raw)
        if max_rows > 0:
            placed = placed.filter(F.col("row_id") < max_rows)
    listed = None
    if rejects:
        bad = bad_cells(features, None if text_label else label)
        line = F.struct(F.lit(None).cast("string").alias("column"), F.col(CORRUPT).alias("cell"))
        bad = F.when(F.col(CORRUPT).isNotNull(), F.array(line)).otherwise(bad)
        # Judged once and written, for both tables read it.
        placed = written_table(placed.withColumn("_bad", bad), "csv-judged")
        listed = placed.select(F.col("_file").alias("file"), "row_id", F.explode("_bad").alias("bad"))
        listed = listed.select("file", "row_id", "bad.column", "bad.cell")
        placed = placed.filter(F.size("_bad") == 0)
    else:
        placed = placed.filter(whole)
    target = cell if text_label else parse_label(label, F.col("row_id"))
    values = feature_array(features, F.col("row_id")).alias("features")
    table = placed.select("row_id", values, target.alias("label"))
    if not text_label:
        return LabelledTable(table, features, rejects=listed)
    encoded, names = encode_first_seen(table, "label")
    return LabelledTable(encoded, features, names, listed)
