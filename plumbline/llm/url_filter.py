"""Host and path rules for URLs, met in one sorted sweep over canonical keys."""

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.llm.arrow import column
from plumbline.session import scratch, written_table

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"
#: Keys of one range, about, and the sample that the ranges are cut by.
RANGE_ROWS, SAMPLE_ROWS, BATCH_ROWS = 200_000, 20_000, 10_000


def host_and_path(url):
    """Host with A-Z lower-cased and path of a URL column; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, CAPITALS, SMALL), path


def host_key(host):
    """Labels in reverse, each with a dot behind: subdomains of a host begin with its key."""
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, "."), F.lit("."))


def sweep(rows):
    """Rules and URLs in key order; yields (id, rule) with the longest rule that fits.

    The stack holds the rule hosts whose intervals are open, each nested in the
    one below. A rule comes before the URLs it covers, for its key begins theirs.
    """

    def rank(rule):
        return len(rule["rule"]), rule["rule"]

    stack = []
    for key, ident, path, rules in rows:
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if rules is not None:
            if stack and stack[-1][0] == key:
                continue
            held = {}
            for rule in rules:
                held.setdefault(len(rule["path"]), {})[rule["path"]] = rule
            stack.append((key, held))
            continue
        best = None
        for _, held in stack:
            for size, by_path in held.items():
                rule = by_path.get(path[:size]) if size <= len(path) else None
                if rule is not None and (best is None or rank(rule) > rank(best)):
                    best = rule
        yield ident, best


def filter_urls(pages, rules, page_id="page_id", url="url", default=DEFAULT, range_rows=RANGE_ROWS):
    """page_id, host, path, rule and verdict of each row of ``pages``.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains
    where the URL's path begins with its own; the longest rule (host and path as
    one string) wins, of equally long ones the last in order. Without a rule the
    verdict is ``default``.

    Hosts become keys of their labels in reverse, so a rule's host is an interval
    of keys and intervals are nested or apart. Distinct hosts and paths are cut
    into ranges of about ``range_rows`` by a sample of their keys; the key goes on
    with the path, so one host may fill many ranges. A rule's host goes to every
    range that its interval meets. Each range is sorted and swept once with a
    stack of the open intervals. The verdicts return by host and path.

    A null URL, or one without ``://``, has empty host and path and fits no rule.
    Rules without host, path or verdict are left out; of rules with one host and
    path, the first verdict in order counts. Repeated pages are answered each.
    Other columns are not used. An empty table gives an empty one.
    """
    host, path = host_and_path(column(url))
    found = pages.select(column(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    with scratch(pages.sparkSession) as keep:
        verdicts = judged_urls(found.select("host", "path").distinct().filter(F.col("host") != ""), rules, range_rows)
        # Pages without a host may be many and fit no rule.
        named = found.filter(F.col("host") != "").join(verdicts, ["host", "path"], "left")
        nothing = F.lit(None).cast("string")
        nameless = found.filter(F.col("host") == "").withColumns({"rule": nothing, "verdict": nothing})
        answered = named.unionByName(nameless).select(
            "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
        )
        return keep(answered, "url-verdicts")


def judged_urls(places, rules, range_rows):
    """(host, path, rule, verdict) of the distinct hosts and paths that a rule fits."""
    keyed = places.withColumn("key", F.concat(host_key(F.col("host")), F.lit("\0"), "path"))
    keyed = written_table(keyed, "url-keys")
    hosts = rules.select(F.translate("host", CAPITALS, SMALL).alias("host"), "path", "verdict").dropna()
    hosts = hosts.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    held = F.struct("path", F.concat("host", "path").alias("rule"), "verdict")
    hosts = hosts.groupBy("host").agg(F.sort_array(F.collect_list(held)).alias("rules"))
    hosts = hosts.withColumn("key", host_key(F.col("host")))
    kind = hosts.schema["rules"].dataType.simpleString()
    nothing = F.lit(None)
    sides = keyed.select(
        "key", nothing.cast("string").alias("last"), "host", "path", nothing.cast(kind).alias("rules")
    ).unionByName(
        hosts.select("key", key_end(F.col("key")).alias("last"), "host", F.lit("").alias("path"), "rules")
    )
    cuts = range_cuts(keyed, range_rows)

    def place(batches):
        for batch in batches:
            firsts = [bisect_right(cuts, k.encode()) for k in batch.column("key").to_pylist()]
            ends = batch.column("last").to_pylist()
            lasts = [a if e is None else bisect_right(cuts, e.encode()) for a, e in zip(firsts, ends)]
            spans = [range(a, b + 1) for a, b in zip(firsts, lasts)]
            rows = batch.take(pa.array([i for i, span in enumerate(spans) for _ in span], pa.int64()))
            at = pa.array([k for span in spans for k in span], pa.int32())
            yield pa.RecordBatch.from_arrays([at, *rows.columns], names=["range", *rows.schema.names])

    def judge(batches):
        def rows():
            now = None
            for batch in batches:
                for r in batch.to_pylist():
                    if r["range"] != now:
                        now = r["range"]
                        yield "", None, "", ()
                    yield r["key"], (r["host"], r["path"]), r["path"], r["rules"]

        out = []
        for (own_host, own_path), rule in sweep(rows()):
            if rule is not None:
                out.append((own_host, own_path, rule["rule"], rule["verdict"]))
            if len(out) == BATCH_ROWS:
                yield _batch(out)
                out = []
        yield _batch(out)

    schema = f"range int, key string, last string, host string, path string, rules {kind}"
    placed = sides.mapInArrow(place, schema).repartition(len(cuts) + 1, "range")
    ordered = placed.sortWithinPartitions("range", "key", F.col("rules").isNull())
    return ordered.mapInArrow(judge, "host string, path string, rule string, verdict string")


def key_end(key):
    """The least key above all that begin with this one, which ends in a dot."""
    return F.concat(F.regexp_replace(key, r"\.\z", ""), F.lit("/"))


def range_cuts(keyed, range_rows):
    """Keys that cut the table into ranges of about ``range_rows``, from a bounded sample."""
    n = keyed.count()
    ranges = -(-n // range_rows)
    if ranges < 2:
        return []
    sample = keyed.select("key").sample(min(1.0, SAMPLE_ROWS / n), seed=7).limit(2 * SAMPLE_ROWS)
    picked = sorted(r.key.encode() for r in sample.collect())
    return sorted({picked[len(picked) * i // ranges] for i in range(1, ranges)}) if picked else []


def _batch(rows):
    names = ("host", "path", "rule", "verdict")
    return pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.string()) for i, n in enumerate(names)})
