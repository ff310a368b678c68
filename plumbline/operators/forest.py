"""Random-forest classification: Spark ML trees, or trees grown best leaf first."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from plumbline.functions import blocks
from plumbline.functions.vectors import of_width
from plumbline.operators import grown_forest
from plumbline.operators.evaluate import training_shape

DEFAULT_TREES = 100
DEFAULT_DEPTH = 16
#: Spark ML numbers nodes by their path, which ends here; deeper trees are grown.
DEEPEST = 30
BINS = 128
SEED = 42
# A partition of the training table holds about so many values.
PART_VALUES, LEAST_PARTS = 2_000_000, 8
BROADCAST_CLASSES = 1_000_000
# Spark ML keeps a number for each row and tree; beyond so many, tables of few
# different feature vectors are grown.
DRAWN_VALUES = 100_000_000


@dataclass
class ForestModel:
    trees: RandomForestClassificationModel
    classes: list[int]
    width: int

    def predict(self, df, features="features", prediction="prediction"):
        """Adds the class with the highest vote, leaf class shares summed over the trees."""
        vectors = df.withColumn("_vector", array_to_vector(of_width(features, self.width)))
        scored = self.trees.transform(vectors).drop("_vector")
        names = _class_table(df.sparkSession, self.classes).withColumnRenamed("_name", prediction)
        return scored.drop(prediction).join(names, "_class", "left").drop("_class")


@dataclass
class GrownForestModel:
    trees: grown_forest.GrownTrees
    classes: list[int]
    width: int

    def predict(self, df, features="features", prediction="prediction"):
        """Adds the class with the highest vote, leaf class shares summed over the trees."""
        vote = grown_forest.predicted(self.trees, df, features, self.width, self.classes)
        return df.withColumn(prediction, vote)


def _class_table(spark, classes):
    """Class numbers as the trees give them, with the labels; a few bytes each."""
    rows = pa.table({"_class": pa.array(np.arange(len(classes), dtype=np.float64)), "_name": pa.array(classes, pa.int32())})
    table = spark.createDataFrame(rows)
    return F.broadcast(table) if len(classes) <= BROADCAST_CLASSES else table


def _classes(df, label):
    """The distinct labels, which the trees need numbered without gaps.

    The trees keep one count for each of them at every node on the driver.
    """
    found = df.select(F.col(label).cast("int").alias("c")).distinct().collect()
    return sorted(r["c"] for r in found)


def _few_vectors(df, features, width):
    """All feature vectors of a table that has no more of them than bins, else None."""
    column = F.col(features).alias("features")
    if df.agg(F.approx_count_distinct(column)).first()[0] > 2 * BINS:
        return None
    found = df.select(column).distinct().limit(BINS + 1).toArrow()["features"]
    return blocks.doubles(found, width) if len(found) <= BINS else None


def _share(max_features, width):
    """The share of the columns that Spark ML tries at a node, which it rounds up."""
    return np.ceil(np.sqrt(width) if max_features == "sqrt" else float(max_features) * width) / width


def _parts(rows, width, row_id, values):
    """The rows in partitions that depend on nothing but the rows.

    Bootstrap samples are drawn by partition and place in it. Rows go by a hash of
    their id, if they have one, and all values, and stand in that order; only rows
    that are equal in all of them may change places.
    """
    count = rows * width // PART_VALUES + LEAST_PARTS
    keys = sorted(values.columns, key=lambda c: c != row_id)
    return values.repartition(int(count), F.xxhash64(*keys)).sortWithinPartitions(*keys)


def fit_random_forest(
    df,
    trees=DEFAULT_TREES,
    max_depth=DEFAULT_DEPTH,
    max_features="sqrt",
    max_leaves=-1,
    max_samples=1.0,
    features="features",
    label="label",
    memory_mb=512,
    row_id="row_id",
):
    """Gini trees on bootstrap samples with the square root of the columns per node.

    ``max_features`` also takes a share of the columns between 0 and 1. With
    ``max_leaves`` each tree has at most that many leaves, always splitting the leaf
    whose split lowers the impurity of its rows most; -1 is no limit. Such trees, and
    those deeper than Spark ML's, come from ``grown_forest``: a pass over the rows for
    every level of unlimited trees, or for every few splits of limited ones. So do those
    of a large table that has no more different feature vectors than a column has bins:
    rows of equal features and label are counted, and a tree draws from each group as
    often as from all its rows one by one, as one Poisson number of the summed rate. A
    model of either kind depends on the rows only, not on their order or partitions.
    """
    if max_leaves != -1 and max_leaves < 1:
        raise ValueError(f"max_leaves must be -1 or at least 1, not {max_leaves}")
    if max_depth < 0:
        raise ValueError(f"max_depth must not be negative, but it is {max_depth}")
    rows_found, width = training_shape(df, features, label)
    classes = _classes(df, label)
    if max_leaves != -1 or max_depth > DEEPEST:
        grown = grown_forest.grow(
            df, width, classes, features, label, trees, max_depth, max_features, max_leaves, max_samples, row_id
        )
        return GrownForestModel(grown, classes, width)
    vectors = _few_vectors(df, features, width) if rows_found * trees > DRAWN_VALUES else None
    if vectors is not None:
        share = _share(max_features, width)
        grown = grown_forest.grow(
            df, width, classes, features, label, trees, max_depth, share, -1, max_samples, row_id, vectors
        )
        return GrownForestModel(grown, classes, width)
    nominal = {"ml_attr": {"type": "nominal", "num_vals": max(2, len(classes))}}
    kept = [row_id] if row_id in df.columns else []
    values = df.select(*kept, F.col(features).alias("_features"), F.col(label).cast("int").alias("_name"))
    parted = _parts(rows_found, width, row_id, values.join(_class_table(df.sparkSession, classes), "_name"))
    rows = parted.select(
        array_to_vector(F.col("_features")).alias("_vector"),
        F.col("_class").alias("_label", metadata=nominal),
    ).persist()
    estimator = RandomForestClassifier(
        featuresCol="_vector",
        labelCol="_label",
        predictionCol="_class",
        probabilityCol="",
        rawPredictionCol="",
        numTrees=trees,
        maxDepth=max_depth,
        maxBins=BINS,
        minInstancesPerNode=1,
        minInfoGain=0.0,
        impurity="gini",
        featureSubsetStrategy=max_features if max_features == "sqrt" else str(float(max_features)),
        subsamplingRate=max_samples,
        bootstrap=True,
        seed=SEED,
        maxMemoryInMB=memory_mb,
    )
    fitted = estimator.fit(rows)
    rows.unpersist()
    return ForestModel(fitted, classes, width)
