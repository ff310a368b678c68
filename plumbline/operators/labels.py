"""Class ids for text labels, in order of first appearance."""

from pyspark.sql import functions as F

from plumbline.operators.order import with_row_id
from plumbline.session import checkpoint_root

BROADCAST_CLASSES = 100_000
BROADCAST_BYTES = 16 << 20


def encode_first_seen(df, label, row_id="row_id", name="label"):
    """Class ids 0, 1, 2, ... by first row, as ``(encoded rows, class names)``.

    The dictionary is written once to the checkpoint folder. It is broadcast
    when it is small; else it is joined by shuffle, where adaptive execution
    splits a label that holds much of the table.
    """
    checkpoint_root(df.sparkSession)
    text = F.coalesce(F.col(label), F.lit(""))
    rows = df.withColumn("_text", text)
    classes = rows.groupBy("_text").agg(F.min(row_id).alias("_first")).checkpoint()
    names = with_row_id(classes, "_first", "class_id").select(
        F.col("class_id").cast("int").alias("class_id"), F.col("_text").alias("class_name")
    )
    size = names.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("class_name")).alias("bytes")
    ).first()
    small = size["n"] <= BROADCAST_CLASSES and (size["bytes"] or 0) <= BROADCAST_BYTES
    lookup = names.select(F.col("class_name").alias("_text"), F.col("class_id").alias("_id"))
    joined = rows.join(F.broadcast(lookup) if small else lookup, "_text")
    encoded = joined.drop("_text", name).withColumnRenamed("_id", name)
    return encoded, names
