"""Quality rules as a short-circuit cascade, in DataFrame operations only."""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm.arrow import column, free_of, packed, unpacked
from plumbline.llm.license_scan import let
from plumbline.llm.mixing import n_words

SPACES = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: The documented bound of the sample that costs and rejections are estimated on.
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 20_000


@dataclass(frozen=True)
class Fact:
    """A number that rules are stated in.

    ``value`` gives it from the text column. ``work`` gives the characters that
    finding it touches, from n_chars and the facts of a text as arrays.
    """

    value: Callable
    work: Callable


@dataclass(frozen=True)
class Rule:
    """A text fails the rule where ``fails`` of the facts, as columns, holds."""

    name: str
    facts: tuple
    fails: Callable

    def failed(self, columns):
        return F.coalesce(self.fails(*[columns[f] for f in self.facts]), F.lit(False))


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 50),
    Rule("repeats", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
)
#: Wide limits: they reject symbol tables, shouting and line spam, not prose.
RULES = (
    Rule("short_words", ("word_chars", "n_words"), lambda c, n: c < 2 * n),
    Rule("long_words", ("word_chars", "n_words"), lambda c, n: c > 20 * n),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("same_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
    Rule("capitals", ("n_capitals", "n_letters"), lambda c, n: 2 * c > n),
    Rule("few_letters", ("n_letters", "word_chars"), lambda n, c: 2 * n < c),
)


def _kept_chars(text, dropped):
    return F.length(F.regexp_replace(text, dropped, "")).cast("long")


def word_chars(text):
    return _kept_chars(text, f"{SPACES}+")


def n_symbols(text):
    return _kept_chars(text, "[^#*$%&|<>]+")


def n_letters(text):
    return _kept_chars(text, r"\P{L}+")


def n_capitals(text):
    return _kept_chars(text, r"\P{Lu}+")


def _lines(text):
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_lines(text):
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text):
    return let(_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(text):
    """Words in 3-word windows that stand twice or more in the text.

    The windows of most texts are all different, which one hash set tells; only
    others are sorted to find the places of equal ones.
    """

    def windows(words):
        of = F.sequence(F.lit(1), F.size(words) - 2)
        return F.transform(
            of,
            lambda i: F.concat_ws(
                " ", F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)
            ),
        )

    def places(found):
        """Of the windows whose neighbour in sorted order is the same."""
        ordered = F.array_sort(F.transform(found, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def twins(s):
            def same(a, b):
                return F.coalesce(F.get(s, a)["w"] == F.get(s, b)["w"], F.lit(False))

            numbers = F.sequence(F.lit(0), F.size(s) - 1)
            kept = F.filter(numbers, lambda j: same(j, j - 1) | same(j, j + 1))
            return F.transform(kept, lambda j: F.get(s, j)["i"])

        return let(ordered, twins)

    def covered(found):
        each = F.transform(places(found), lambda p: F.array(p, p + 1, p + 2))
        several = F.size(F.array_distinct(F.flatten(each)))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(several)

    def counted(words):
        return F.when(F.size(words) < 3, 0).otherwise(let(windows(words), covered))

    words = F.filter(F.split(text, f"{SPACES}+"), lambda w: w != "")
    return let(words, counted).cast("long")


def once(facts):
    return facts["n_chars"]


#: Facts by name. A pass of a pattern touches each character once, a split copies them;
#: three-word windows hold each word three times and are built and hashed, and texts with
#: equal ones sort them.
FACTS = {
    "n_words": Fact(n_words, lambda f: 2 * f["n_chars"]),
    "word_chars": Fact(word_chars, once),
    "n_symbols": Fact(n_symbols, once),
    "n_letters": Fact(n_letters, once),
    "n_capitals": Fact(n_capitals, once),
    "n_lines": Fact(n_lines, lambda f: 2 * f["n_chars"]),
    "n_dup_lines": Fact(n_dup_lines, lambda f: 3 * f["n_chars"]),
    "n_repeat_words": Fact(
        n_repeat_words,
        lambda f: 2 * f["n_chars"]
        + 6 * f["word_chars"]
        + np.where(f["n_repeat_words"] > 0, 6 * f["word_chars"] * np.log2(f["n_words"] + 2), 0),
    ),
}
#: Facts that ``work`` is stated in besides a rule's own.
MEASURES = ("n_words", "word_chars")


def sampled(rows, sample_rows=SAMPLE_ROWS, sample_chars=SAMPLE_CHARS):
    """(text, copies): at most ``sample_rows`` distinct rows by a hash of all their columns.

    The hash takes rows at a rate from the number of rows, and of those the ones
    with the least hashes: a table gives the same sample however it is cut. Equal
    rows are one with their number, so that copies do not fill it.
    """
    stride = max(1, rows.count() // (2 * sample_rows))
    digest = F.xxhash64(F.to_json(F.struct("row")), "text")
    some = rows.select(digest.alias("digest"), F.substring("text", 1, sample_chars).alias("text"))
    some = some.filter(F.pmod("digest", F.lit(stride)) == 0)
    distinct = some.groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return distinct.orderBy("digest").limit(sample_rows).select("text", "copies")


def estimated_order(rows, rules, known=(), sample_rows=SAMPLE_ROWS):
    """The rules by falling rejection per cost, both estimated on a sample of ``rows``.

    The sample is that of ``sampled``, texts cut at ``SAMPLE_CHARS``; it only sets the
    order. Costs are the characters that the facts of a rule touch, those facts
    left out that are ``known`` or that an earlier rule has found. Rejections and
    costs count the rows that the rules before have left, so each place goes to the
    rule that does best after those. Equal rules stand by cost and name; the same
    rows give the same order each time.
    """
    names = sorted({f for rule in rules for f in rule.facts} | set(MEASURES))
    some = sampled(rows, sample_rows).select("copies", F.length("text").alias("n_chars"), *_facts(names))
    here = {n: F.col(n) for n in names}
    some = some.select("*", *[r.failed(here).alias(f"fails_{i}") for i, r in enumerate(rules)])
    found = some.toArrow()
    facts = {n: found[n].to_numpy() for n in ("n_chars", *names)}
    fails = {r.name: found[f"fails_{i}"].to_numpy(zero_copy_only=False) for i, r in enumerate(rules)}
    work = {n: FACTS[n].work(facts) for n in names}
    passed, known, order = found["copies"].to_numpy().astype(float), set(known), []

    def place(rule):
        cost = sum(float((work[f] * passed).sum()) for f in rule.facts if f not in known)
        rejected = float((fails[rule.name] * passed).sum())
        return -(rejected / cost if cost else float("inf")), cost, rule.name

    left = list(rules)
    while left:
        order.append(min(left, key=place))
        left.remove(order[-1])
        known |= set(order[-1].facts)
        passed = passed * ~fails[order[-1].name]
    return order


def _facts(names):
    return [FACTS[n].value(F.col("text")).alias(n) for n in names]


def cascade(rules, text, known):
    """The name of the first rule in order that a row fails, null if none.

    Facts that are not ``known`` columns stand inside the branch that needs them, each
    bound once for the rules from there on. A row that fails a rule never finds
    the facts that only later rules need.
    """
    if not rules:
        return F.lit(None).cast("string")
    rule = rules[0]
    wanted = [f for f in rule.facts if f not in known]
    if wanted:
        return let(FACTS[wanted[0]].value(text), lambda v: cascade(rules, text, known | {wanted[0]: v}))
    return F.when(rule.failed(known), rule.name).otherwise(cascade(rules[1:], text, known))


def apply_quality_rules(
    docs, text="text", rules=BASE_RULES + RULES, facts=(), sample_rows=SAMPLE_ROWS, carry=None
):
    """``docs`` with the facts asked for, failed_rule and kept.

    The order of the rules is found first: cost and rejection are estimated on a
    bounded sample, and the rules stand by rejection per cost. Then each row goes
    through the rules in that order up to the one it fails. Facts asked for as
    columns are found for every row; all others only where a rule comes up that
    needs them. The order decides what is computed and which of several failed rules
    is named, never which rows are kept.

    Null and empty texts have no words, characters or lines. Repeated rows are
    judged each, whole texts are read, columns with the names of results give
    way, and an empty table gives an empty one.
    """
    kept = free_of(docs.columns if carry is None else carry, [*facts, "failed_rule", "kept"])
    rows = docs.select(packed(kept), F.coalesce(column(text), F.lit("")).alias("text"))
    order = estimated_order(rows, rules, facts, sample_rows)
    return unpacked(judged(rows, order, facts), kept)


def judged(rows, order, facts=()):
    """The rows with ``facts``, failed_rule and kept, by rules in the order given."""
    found = rows.select("row", "text", *_facts(facts))
    found = found.select("row", *facts, cascade(order, F.col("text"), {f: F.col(f) for f in facts}).alias("failed_rule"))
    return found.withColumn("kept", F.col("failed_rule").isNull())
