"""Joins of rows with values by a key that may be common to much of a table."""

from pyspark.sql import functions as F

#: A lookup of so many small rows is broadcast; of a larger one its most frequent keys are.
BROADCAST_ROWS, FREQUENT = 250_000, 10_000


def spread_join(rows, lookup, key, copies, broadcast_rows=BROADCAST_ROWS, local=True):
    """``rows`` with the columns of ``lookup`` for their key, null where it has none.

    ``lookup`` has one row for each key, with ``copies``, the number of rows that hold
    it. With ``broadcast_rows`` rows at most it is broadcast. Of a larger one the most
    frequent keys are, up to ``FREQUENT``, and only rows with other keys are
    shuffled, none of which holds more than one in ``FREQUENT`` of all rows. Null keys
    are equal. With ``local`` the broadcast rows go through the driver, so that
    ``lookup`` is computed once; else they are read again, which suits a written table.
    """
    names = [c for c in lookup.columns if c not in (key, copies)]
    all_of_it = lookup.select(key, *names).limit(broadcast_rows + 1)
    if local:
        held = all_of_it.toArrow()
        small, some = held.num_rows <= broadcast_rows, lookup.sparkSession.createDataFrame(held, all_of_it.schema)
    else:
        small, some = all_of_it.count() <= broadcast_rows, lookup.select(key, *names)
    if not small:
        some = lookup.orderBy(F.col(copies).desc(), key).limit(min(FREQUENT, broadcast_rows)).select(key, *names)
    some = F.broadcast(some.withColumnRenamed(key, "__key"))
    same = F.col(key).eqNullSafe(F.col("__key"))
    if small:
        return rows.join(some, same, "left").drop("__key")
    keys = some.select("__key")
    hot = rows.join(keys, same, "left_semi").join(some, same, "left")
    cold, rest = rows.join(keys, same, "left_anti"), lookup.select(F.col(key).alias("__key"), *names)
    # Rows without a key may be many, even where the lookup has no such key.
    none = F.broadcast(rest.filter("__key IS NULL"))
    nameless = cold.filter(F.col(key).isNull()).join(none, same, "left")
    named = cold.filter(F.col(key).isNotNull()).join(rest, F.col(key) == F.col("__key"), "left")
    return hot.unionByName(nameless).unionByName(named).drop("__key")
