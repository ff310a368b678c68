"""Running average and peak of utilisation samples."""

import pandas as pd
from pyspark.sql import functions as F


def utilization_stream(samples, window, late="1 minute", run="run_id", ts="ts", value="util"):
    """Average, peak (not below 0) and number of samples per run and time window.

    The watermark bounds the state: a window is closed, and its samples no
    longer accepted, once ``late`` has passed since its end.
    """
    found = (
        samples.withWatermark(ts, late)
        .groupBy(F.window(ts, window), F.col(run))
        .agg(
            F.avg(value).alias("util_avg"),
            F.greatest(F.max(value), F.lit(0.0)).alias("util_peak"),
            F.count(value).alias("n_samples"),
        )
    )
    return found.select(
        run,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "util_avg",
        "util_peak",
        "n_samples",
    )


# The kinds of rows in a stream of runs. At one instant a start comes first,
# then readings, then a stop, so that readings at both ends count.
START, READING, STOP = 0, 1, 2
STATE = (
    "run array<string>, started array<long>, total array<double>, peak array<double>, n array<long>, "
    "running array<boolean>, at array<int>, ts array<long>, kind array<int>, value array<double>"
)
PART = "part int, started_at timestamp, stopped_at timestamp, total double, peak double, n_samples long"
#: Groups that the runs are dealt to, by a hash; a task takes one group after the other.
RUN_GROUPS = 4096


class _Run:
    """One run's readings so far, and the rows whose time has not come yet."""

    def __init__(self, started=0, total=0.0, peak=0.0, n=0, running=False):
        self.started, self.total, self.peak, self.n, self.running = started, total, peak, n, running
        self.waiting = []

    def take(self, rows):
        self.waiting = sorted(self.waiting + rows)

    def until(self, instant):
        """Rows up to an instant, in order: each stop gives the run that it ends."""
        done = 0
        for ts, kind, value in self.waiting:
            if ts > instant:
                break
            done += 1
            if kind == START:
                self.started, self.total, self.peak, self.n, self.running = ts, 0.0, 0.0, 0, True
            elif kind == STOP:
                if self.running:
                    yield self.started, ts, self.total, self.peak, self.n
                self.running = False
            elif self.running:
                self.total, self.peak, self.n = self.total + value, max(self.peak, value), self.n + 1
        self.waiting = self.waiting[done:]


def _held(state):
    """The runs of a group, by name."""
    if not state.exists:
        return {}
    names, *sums, at, ts, kind, value = state.get
    runs = [_Run(*own) for own in zip(*sums)]
    for i, *row in zip(at, ts, kind, value):
        runs[i].waiting.append(tuple(row))
    return dict(zip(names, runs))


def _keep(runs, state, watermark):
    kept = {name: run for name, run in runs.items() if run.running or run.waiting}
    if not kept:
        state.remove()
        return
    sums = [[getattr(run, name) for run in kept.values()] for name in ("started", "total", "peak", "n", "running")]
    rows = [(i, *row) for i, run in enumerate(kept.values()) for row in run.waiting]
    at, ts, kind, value = (list(x) for x in zip(*rows)) if rows else ([], [], [], [])
    state.update((list(kept), *sums, at, ts, kind, value))
    if rows:
        state.setTimeoutTimestamp(max(watermark + 1, -(-min(ts) // 1000)))


def utilization_runs(rows, late="1 minute", run="run_id", ts="ts", value="util", kind="kind", salts=1, groups=RUN_GROUPS):
    """Readings of each run between its start and stop, from a stream, as parts of sums.

    ``kind`` is ``start``, ``stop`` or any other word for a reading. Rows may come in
    any order: those of a run wait until the watermark, ``late`` behind the latest
    row, has passed their time, and are then taken in order of time. A start sets
    the sums to zero, whatever was before; a stop gives the run's row and clears them;
    readings outside of a run and a stop without a start count for nothing. Rows
    later than the watermark are dropped, and so are rows without run or time and
    readings without a value. A run whose stop the watermark never passes gives no row.

    The state of a run is its sums and the rows of the last ``late``. Runs are dealt to
    ``groups`` groups, by a hash, each with one state for all of its runs, since Spark
    spends far more on a key than on a row. With ``salts`` the
    readings of each run are dealt to so many keys, by a hash, and starts and stops
    go to all, so that a run that holds much of the stream is not one task's. The
    result has one row for each run and salt; ``merge_run_parts`` adds them up. ``run`` is
    of any type that casts to a string and back.
    """
    words = F.lower(F.col(kind))
    code = F.when(words == "start", START).when(words == "stop", STOP).otherwise(READING)
    taken = rows.withWatermark(ts, late).filter(F.col(run).isNotNull() & F.col(ts).isNotNull())
    taken = taken.select(
        F.col(run).cast("string").alias("run"), F.col(ts).alias("at"), code.alias("kind"), F.col(value).cast("double").alias("value")
    ).filter((F.col("kind") != READING) | F.col("value").isNotNull())
    one = F.array(F.pmod(F.xxhash64("at", "value"), F.lit(salts)).cast("int"))
    every = F.array(*[F.lit(i) for i in range(salts)])
    taken = taken.withColumn("part", F.explode(F.when(F.col("kind") == READING, one).otherwise(every)))
    group = F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int").alias("group")
    kept = taken.select(group, "part", "run", "at", F.unix_micros("at").alias("ts"), "kind", F.coalesce("value", F.lit(0.0)).alias("value"))

    def follow(key, batches, state):
        runs, watermark, new = _held(state), state.getCurrentWatermarkMs(), {}
        for batch in batches:
            batch = batch[batch["ts"] > watermark * 1000] if watermark > 0 else batch
            for name, *row in zip(*(batch[c].tolist() for c in ("run", "ts", "kind", "value"))):
                new.setdefault(name, []).append(tuple(row))
        for name, rows in new.items():
            runs.setdefault(name, _Run()).take(rows)
        found = [(name, key[1], *ended) for name, run in runs.items() for ended in run.until(watermark * 1000)]
        _keep(runs, state, watermark)
        if found:
            columns = ["run", "part", "started_at", "stopped_at", "total", "peak", "n_samples"]
            ended = pd.DataFrame(found, columns=columns)
            for instant in ("started_at", "stopped_at"):
                ended[instant] = pd.to_datetime(ended[instant], unit="us")
            yield ended

    of = rows.schema[run].dataType
    found = kept.groupBy("group", "part").applyInPandasWithState(
        follow, f"run string, {PART}", STATE, "append", "EventTimeTimeout"
    )
    return found.withColumn("run", F.col("run").cast(of)).withColumnRenamed("run", run)


def merge_run_parts(parts, run="run_id"):
    """Average, peak (not below 0) and number of readings of each run, from its parts."""
    n = F.sum("n_samples")
    return parts.groupBy(run, "started_at", "stopped_at").agg(
        F.coalesce(F.sum("total") / F.nullif(n, F.lit(0)), F.lit(0.0)).alias("util_avg"),
        F.max("peak").alias("util_peak"),
        n.alias("n_samples"),
    )
