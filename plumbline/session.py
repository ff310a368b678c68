"""Session settings and the shared folder that intermediate tables go to."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_written = ContextVar("written", default=None)


def build_session(app_name="plumbline", cpus="*", shuffle_partitions=8, **conf):
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark):
    """The cluster's shared checkpoint folder, read from the session."""
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="plumbline-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_folder(spark, name):
    """A path for one run's table below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_table(df, name, **options):
    """The table written once below the checkpoint folder, and read from there.

    For rows that many passes read and that are costly to compute: unlike a
    cache it outlives lost executors, and scans of it still skip and prune.
    """
    return df.sparkSession.read.parquet(written_folder(df, name, **options))


def written_folder(df, name, **options):
    """Where ``written_table`` puts the table, for those who remove it themselves.

    ``options`` are those of the Parquet writer.
    """
    path = shared_folder(df.sparkSession, name)
    if _written.get() is not None:
        _written.get().append(path)
    df.write.parquet(path, **options)
    return path


def remove_folder(spark, path):
    """Deletes a folder of the shared store, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark):
    """Removes the tables that ``written_table`` writes inside the block when it ends.

    Gives a function that writes a table to stay: what is returned from the block
    and is not in memory must have gone through it.
    """
    paths = []
    outer = _written.set(paths)

    def keep(df, name):
        path = shared_folder(spark, name)
        df.write.parquet(path)
        kept.append(path)
        return spark.read.parquet(path)

    kept = []
    try:
        yield keep
    finally:
        _written.reset(outer)
        if _written.get() is not None:
            _written.get().extend(kept)
        for path in paths:
            remove_folder(spark, path)
