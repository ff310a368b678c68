"""Array-of-float feature expressions that stay inside the JVM."""

from pyspark.sql import functions as F

UNROLL_WIDTH = 64


def numeric_features(columns):
    """Numeric columns as one float array, in the order given."""
    return F.array(*[F.col(c).cast("float") for c in columns]).cast("array<float>")


def of_width(features, width):
    """The feature array itself; a row of another width fails the job."""
    column = F.col(features)
    message = F.concat(
        F.lit(f"feature width differs from the {width} columns the model was fitted on: "),
        F.coalesce(F.size(column), F.lit(0)).cast("string"),
    )
    return F.when(F.size(column) == width, column).otherwise(F.raise_error(message))


def squared_distance(left, right, width=None):
    """Squared Euclidean distance of two float arrays, summed in double."""
    a, b = F.col(left), F.col(right)

    def square(x, y):
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    if width is not None and width <= UNROLL_WIDTH:
        total = F.lit(0.0)
        for i in range(width):
            total = total + square(a[i], b[i])
        return total
    return F.aggregate(F.zip_with(a, b, square), F.lit(0.0), lambda acc, x: acc + x)


def majority(labels):
    """Most frequent value of an int array; the lowest wins a tie."""
    votes = F.transform(
        F.array_distinct(labels),
        lambda c: F.struct(
            F.size(F.filter(labels, lambda x: x == c)).alias("n"),
            (-c.cast("long")).alias("minus_label"),
        ),
    )
    return (-F.array_max(votes)["minus_label"]).cast("int")
