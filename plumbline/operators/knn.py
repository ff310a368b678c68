"""Exact k-nearest-neighbour classification."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from plumbline.functions.vectors import majority
from plumbline.operators.evaluate import training_shape
from plumbline.operators.nearest import PointSet, nearest_neighbors, with_neighbors

DEFAULT_K = 5


@dataclass
class KnnModel:
    points: PointSet
    k: int

    def neighbors(self, df, features="features", row_id="row_id"):
        """The k nearest training rows of each row, one row per neighbour."""
        return nearest_neighbors(df, self.points, self.k, features, row_id)

    def predict(self, df, features="features", row_id="row_id", prediction="prediction"):
        """Adds the majority label of the k nearest; the lowest label wins a tie.

        Rows are answered each, whatever their ids, of any size of training table.
        """
        if df.isStreaming:
            raise ValueError("k-NN scores tables: use score_stream for a stream")
        found = with_neighbors(df, self.points, self.k, features, "_neighbors")
        vote = majority(F.col("_neighbors.label"))
        return found.withColumn(prediction, vote).drop("_neighbors")

    def unpersist(self):
        """Removes the stored reference; predictions not yet computed need it."""
        self.points.release()


def fit_knn(df, k=DEFAULT_K, features="features", label="label", row_id="row_id", **limits):
    """Keeps the training rows; with fewer than k of them, all vote."""
    if k < 1:
        raise ValueError(f"k must be at least 1, not {k}")
    rows, width = training_shape(df, features, label)
    table = df.select(
        F.col(row_id).cast("long").alias("train_id"),
        F.col(label).cast("int").alias("label"),
        F.col(features).alias("features"),
    )
    return KnnModel(PointSet(table, rows, width, **limits), k)
