"""Strict text-to-number expressions for labelled CSV cells."""

from pyspark.sql import functions as F

# The spellings of a number that are accepted, besides True/False.
DECIMAL = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
HEXADECIMAL = r"[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?\d+"
INFINITE = r"[+-]?(?i:inf|infinity)"
NOT_A_NUMBER = r"(?i:nan)"
INTEGER = r"[+-]?\d+"

FINITE_TEXT = f"^({DECIMAL}|{HEXADECIMAL})$"
SPECIAL_TEXT = f"^({INFINITE}|{NOT_A_NUMBER})$"


def _reject(kind, name, cell, row):
    place = [] if row is None else [F.lit(", row "), row.cast("string")]
    return F.raise_error(
        F.concat(
            F.lit(f"invalid {kind} in column '"),
            name,
            F.lit("': '"),
            F.coalesce(cell, F.lit("")),
            F.lit("'"),
            *place,
        )
    )


def _column(name):
    return F.col("`" + name.replace("`", "``") + "`")


def _feature(cell):
    """True/False to 1/0, else a float; null for any other cell.

    A bare cast is looser than that: it trims, takes a trailing ``f`` or ``d``
    and turns out-of-range text into infinity.
    """
    value = cell.try_cast("float")
    in_range = cell.rlike(FINITE_TEXT) & (F.abs(value) < float("inf"))
    return (
        F.when(in_range, value)
        .when(cell == "True", F.lit(1.0).cast("float"))
        .when(cell == "False", F.lit(0.0).cast("float"))
        .when(cell.rlike(SPECIAL_TEXT), value)
    )


def _strict_feature(cell, name, row):
    return F.coalesce(_feature(cell), _reject("feature", name, cell, row).cast("float"))


def parse_feature(name, row=None):
    """A text column as a feature; a bad cell fails the job, ``row`` named with it."""
    return _strict_feature(_column(name), F.lit(name), row)


def feature_array(names, row=None):
    """Text cells of the named columns, in that order, as one float array.

    The cells go through one expression as an array: generated code for each of
    many columns would outgrow what the JVM compiles.
    """
    titles = F.array(*[F.lit(n) for n in names])
    return F.transform(
        F.array(*[_column(n) for n in names]), lambda cell, i: _strict_feature(cell, titles[i], row)
    )


def bad_cells(names, label=None):
    """Structs of column and cell for the features, and the label, that do not parse."""
    titles = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    cells = F.array(*[_column(n) for n in names]).cast("array<string>")
    pairs = F.zip_with(titles, cells, lambda t, c: F.struct(t.alias("column"), c.alias("cell")))
    bad = F.filter(pairs, lambda p: _feature(p["cell"]).isNull())
    if label is None:
        return bad
    own = F.struct(F.lit(label).alias("column"), _column(label).alias("cell"))
    return F.concat(bad, F.when(_label(_column(label)).isNull(), F.array(own)).otherwise(F.slice(F.array(own), 1, 0)))


def _label(cell):
    value = cell.try_cast("int")
    return (
        F.when(cell == "True", F.lit(1))
        .when(cell == "False", F.lit(0))
        .when(cell.rlike(f"^{INTEGER}$") & value.isNotNull(), value)
    )


def parse_label(name, row=None):
    """True/False to 1/0, else a 32-bit integer; any other cell fails the job."""
    cell = _column(name)
    return F.coalesce(_label(cell), _reject("label", F.lit(name), cell, row).cast("int"))
