"""Finite vectors as exact whole numbers, and exact sums of them over all tasks."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from plumbline.llm.arrow import packed, unpacked

#: Partial sums of one number meet in so many groups of tasks first, then in one row.
MERGE_TREE = 64
PARTIAL = "id int, sums array<string>"
LONGEST = (1 << 63) - 1


def finite(vector):
    """Whether an array column is there and all its components are finite numbers."""
    number = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(number, F.lit(False))


def small_bound(width):
    """Whole components up to this have distances and products that fit 64 bits."""
    return math.isqrt((1 << 60) // max(width, 1))


def _whole(x, scale):
    return int(x) * scale if abs(x) >= 1 << 52 else math.floor(x * scale)


def components(column, width, scale):
    """An Arrow column of lists as (rows, width) doubles, floored after scaling."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    with np.errstate(over="ignore"):
        return x, np.floor(scale * x)


def integer_rows(column, width, scale, small):
    """Parts of a batch as (row numbers, whole components).

    Rows up to ``small_bound`` are 64-bit numbers, where ``small`` allows that; all
    others are Python's, which are exact for every finite component.
    """
    x, floors = components(column, width, scale)
    plain = (np.abs(floors) <= small_bound(width)).all(axis=1) & small
    if plain.any():
        yield np.flatnonzero(plain), floors[plain].astype(np.int64)
    if not plain.all():
        exact = [[_whole(v, scale) for v in row] for row in x[~plain].tolist()]
        yield np.flatnonzero(~plain), np.array(exact, dtype=object).reshape(-1, width)


def integers_of(values, scale):
    """The whole components of one vector on the driver."""
    return [_whole(float(v), scale) for v in values]


def exact_sum(numbers):
    """The sum of an array of numbers not below zero, which may be beyond 64 bits."""
    if numbers.dtype == object:
        return int(numbers.sum()) if len(numbers) else 0
    low = numbers & 0xFFFFFFFF
    return (int((numbers >> 32).sum()) << 32) + int(low.sum())


def longs(numbers):
    """Whole numbers as an Arrow column, null where one does not fit."""
    return pa.array([n if -LONGEST <= n <= LONGEST else None for n in map(int, numbers)], pa.int64())


def scanned(df, vector, usable, columns, run, fields):
    """``columns`` of the usable rows beside what ``run(batches)`` finds of their vectors."""
    rows = df.filter(usable).select(packed(columns), vector.cast("array<double>").alias("vector"))
    schema = StructType([rows.schema["row"], *[StructField(n, t) for n, t in fields]])
    return unpacked(rows.mapInArrow(run, schema), columns)


def totals(df, vector, usable, run):
    """Sums over all tasks, as lists of exact numbers by id.

    ``run(batches)`` yields ``sums_batch`` rows, few for each task. They are added
    in ``MERGE_TREE`` groups for each id and then in one row, so that no task and
    not the driver meets the rows of all tasks.
    """
    partial = df.filter(usable).select(vector.cast("array<double>").alias("vector")).mapInArrow(run, PARTIAL)
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_TREE))
    merged = partial.withColumn("part", part).groupBy("id", "part").applyInArrow(_added, PARTIAL)
    found = merged.groupBy("id").applyInArrow(_added, PARTIAL).toArrow().to_pydict()
    return {i: [int(s) for s in sums] for i, sums in zip(found["id"], found["sums"])}


def sums_batch(sums):
    """Lists of numbers by id as a batch of partial sums."""
    texts = [[str(n) for n in numbers] for numbers in sums.values()]
    columns = [pa.array(list(sums), pa.int32()), pa.array(texts, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, names=["id", "sums"])


def _added(rows):
    sums = None
    for texts in rows["sums"].to_pylist():
        numbers = [int(t) for t in texts]
        sums = numbers if sums is None else [a + b for a, b in zip(sums, numbers)]
    return pa.Table.from_batches([sums_batch({rows["id"][0].as_py(): sums})])
