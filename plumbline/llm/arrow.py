"""Columns computed from whole texts, batch by batch, beside the row's own columns."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

TEXT = "__text__"


def column(name):
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_of(names, taken):
    """The names that are not among the taken ones; case does not matter."""
    taken = {t.lower() for t in taken}
    return [n for n in names if n.lower() not in taken]


def packed(names):
    """The named columns as one struct ``row``, so that they clash with no others.

    Fields are numbered; the first, always null, is there for rows without columns.
    """
    kept = [column(n).alias(f"c{i}") for i, n in enumerate(names)]
    return F.struct(F.lit(None).cast("int").alias("none"), *kept).alias("row")


def unpacked(df, names, *more):
    """The columns of ``row`` by their names, then ``more``, by default all others."""
    kept = [F.col("row").getField(f"c{i}").alias(n) for i, n in enumerate(names)]
    return df.select(*kept, *(more or [column(c) for c in df.columns if c != "row"]))


def append_columns(docs, text, fields, start, carry=None):
    """``docs`` with new columns that a Python function finds from the text column.

    ``start()`` is called once in each task and returns a function from an Arrow
    array of texts to one Arrow array for each of ``fields``, names with types.
    No row moves to another task. ``carry`` names the columns to keep, all by
    default; one that has the name of a new column gives way to it.
    """
    kept = free_of(docs.columns if carry is None else carry, [n for n, _ in fields])
    rows = docs.select(packed(kept), column(text).alias("text"))
    schema = StructType([rows.schema["row"], *[StructField(n, t) for n, t in fields]])
    names = schema.names

    def run(batches):
        compute = start()
        for batch in batches:
            made = compute(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=names)

    found = rows.mapInArrow(run, schema)
    return unpacked(found, kept, *[column(n) for n, _ in fields])
