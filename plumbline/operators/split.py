"""Positional train/test split."""

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.order import key_at

TRAIN_RATIO = 0.8


@dataclass(frozen=True)
class Split:
    train: DataFrame
    test: DataFrame
    train_rows: int
    test_rows: int


def train_size(rows, ratio=TRAIN_RATIO):
    """Rows of the training part: the product rounded down."""
    return int(rows * Fraction(str(ratio)))


def split_by_key(df, key="row_id", ratio=TRAIN_RATIO):
    """The first part of the table by key to train on, the rest to test on.

    Both parts are range filters on the key, so nothing is shuffled and the
    scan skips the other part.
    """
    if not 0 <= ratio <= 1:
        raise ValueError(f"ratio must lie between 0 and 1, not {ratio}")
    rows = df.count()
    cut_position = train_size(rows, ratio)
    cut = key_at(df, key, cut_position)
    here = F.col(key)
    if cut is None:
        train, test = df, df.filter(F.lit(False))
    else:
        train, test = df.filter(here < cut), df.filter(here >= cut)
    return Split(train, test, cut_position, rows - cut_position)
