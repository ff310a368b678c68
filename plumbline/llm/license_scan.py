"""License notices in texts: phrases at their places, and templates by set similarity.

DataFrame operations only.
"""

import math
import re

from pyspark.sql import functions as F

from plumbline.llm.arrow import column, free_of, packed, unpacked
from plumbline.llm.joins import spread_join
from plumbline.session import scratch, written_table

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Paragraphs are the text blocks that templates are looked for in.
BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*\n"

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices that the licenses ask their users to give, or openings of the licenses.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version",
    ),
    ("cc", "Licensed under CC BY NC 4.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
]
THRESHOLD = 0.8
#: A template of fewer distinct words must be there whole: one word of so few can be
#: the license's name.
WHOLE_WORDS = 12


def least_words(n, threshold=THRESHOLD, whole_words=WHOLE_WORDS):
    """Words of a template of ``n`` distinct words that a paragraph must hold."""
    return n if n < whole_words else math.ceil(threshold * n - 1e-9)


def template_words(text):
    return sorted(set(w for w in re.split(GAP, text.translate(str.maketrans(CAPITALS, SMALL))) if w))


def words(text):
    """Words of lower-cased text; an empty one may stand first and last."""
    return F.split(text, f"{GAP}+")


def word_count(parts):
    """Of a split text without the empty parts at its ends."""
    ends = (F.element_at(parts, 1) == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    return F.when((F.size(parts) == 1) & (F.element_at(parts, 1) == ""), 0).otherwise(F.size(parts) - ends)


def let(value, body):
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def phrase_places(text, phrases):
    """Starts of all places of the phrases and their labels, as an array of structs."""

    def places(parts):
        skipped = (F.element_at(parts, 1) == "").cast("int")
        found = []
        for phrase, label in phrases.items():
            at = F.filter(places_in(parts), _stands(parts, phrase.split()))
            found.append(F.transform(at, _place(skipped, label)))
        return F.concat(*found)

    return let(words(text), places)


def places_in(parts):
    return F.sequence(F.lit(0), F.size(parts) - 1)


def _place(skipped, label):
    return lambda i: F.struct((i - skipped).cast("long").alias("at"), F.lit(label).alias("label"))


def _stands(parts, sought):
    def test(i):
        found = F.lit(True)
        for k, word in enumerate(sought):
            found = found & F.coalesce(F.get(parts, i + k) == word, F.lit(False))
        return found

    return test


def scan_licenses(
    docs,
    text="text",
    templates=TEMPLATES,
    threshold=THRESHOLD,
    whole_words=WHOLE_WORDS,
    phrases=PHRASES,
    carry=None,
):
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base are the places where a phrase's words stand one after the other. The
    method is an exact set-similarity join of the text's paragraphs with the
    templates: a template is found where a paragraph holds at least ``threshold``
    of its distinct words, or all of them where they are fewer than ``whole_words``.
    score is the greatest such share, 0 where there is none.

    The words of the templates are counted over all paragraphs and put in order,
    rare ones first. A paragraph is the list, in that order, of the words it
    shares with the templates, for others cannot match. With a template of T words
    at least c = least_words(T) must be common, so one of the template's
    first T - c + 1 words is among the first b - c + 1 of a paragraph of b: the
    join is on these (prefix filter). Shorter lists (length filter) and first
    common words with too few words after them (positional filter) are left out,
    and what remains is compared in full. Only distinct lists are joined, so
    copies of a text, however many, are one row there, and the result returns to
    the documents by a join on the list.

    Null and empty texts have no words, no places (null first and last) and no
    labels. Repeated rows are each returned, texts are read whole, columns with
    the names of results give way, an empty table gives an empty one. Templates
    without a word are left out.
    """
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kept = free_of(docs.columns if carry is None else carry, made)
    sought = [(label, template_words(t)) for label, t in templates]
    sought = [(label, ws) for label, ws in sought if ws]
    lower = F.translate(F.coalesce(column(text), F.lit("")), CAPITALS, SMALL)
    rows = docs.select(packed(kept), lower.alias("text"))
    order = _rare_first(rows, sorted({w for _, ws in sought for w in ws}))
    rank = {w: i for i, w in enumerate(order)}
    shapes = []
    for number, (label, ws) in enumerate(sought):
        least = least_words(len(ws), threshold, whole_words)
        ws = sorted(ws, key=rank.get)
        shapes += [(number, label, w, place, len(ws), least, ws) for place, w in enumerate(ws[: len(ws) - least + 1])]
    fewest = min((s[5] for s in shapes), default=1)
    heads = sorted({s[2] for s in shapes})

    def head(block):
        return F.slice(block, 1, F.greatest(F.size(block) - (fewest - 1), F.lit(0)))

    blocks = F.transform(F.split("text", BLANK_LINE), lambda p: F.array_intersect(_strings(order), words(p)))
    blocks = F.filter(blocks, lambda b: F.arrays_overlap(head(b), _strings(heads)))
    hinted = F.col("text").rlike("|".join(f"{GAP}+".join(map(re.escape, p.split())) for p in phrases) or "(?!)")
    no_places = F.array().cast("array<struct<at:bigint,label:string>>")
    places = F.when(hinted, phrase_places(F.col("text"), phrases)).otherwise(no_places) if phrases else no_places
    found = rows.select(
        "row",
        let(words(F.col("text")), word_count).cast("long").alias("n_words"),
        places.alias("places"),
        F.when(F.size(blocks) > 0, F.to_json(F.array_sort(F.array_distinct(blocks)))).alias("blocks"),
    )
    with scratch(docs.sparkSession) as keep:
        found = written_table(found, "license-rows")
        lists = found.filter("blocks IS NOT NULL").groupBy("blocks").agg(F.count("*").alias("copies"))
        matched = written_table(_joined(lists, shapes, fewest), "license-lists")
        found = spread_join(found, matched, "blocks", "copies", local=False)
        base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
        both = F.array_sort(F.array_distinct(F.concat(base, F.coalesce(F.col("found"), _strings([])))))
        starts = F.transform("places", lambda p: p["at"])
        found = found.select(
            "row",
            "n_words",
            F.size("places").cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            F.array_join(base, ",").alias("base_labels"),
            F.array_join(both, ",").alias("labels"),
            F.coalesce("share", F.lit(0.0)).alias("score"),
        )
        return keep(unpacked(found, kept), "license-scan")


def _strings(values):
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _rare_first(rows, vocabulary):
    """The templates' words by the number of texts that hold them, over all texts."""
    counts = rows.select(F.explode(F.array_intersect(_strings(vocabulary), words(F.col("text")))).alias("w"))
    counts = {r.w: r.n for r in counts.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _joined(lists, shapes, fewest):
    """Labels and best share of each list of paragraphs that holds a template."""
    spark = lists.sparkSession
    kinds = "template int, label string, word string, place int, n int, least int, words array<string>"
    heads = spark.createDataFrame(shapes, kinds)
    blocks = lists.select("blocks", "copies", F.explode(F.from_json("blocks", "array<array<string>>")).alias("block"))
    sides = blocks.select("block").distinct().withColumn("size", F.size("block"))
    first = sides.select("*", F.posexplode(F.slice("block", F.lit(1), F.col("size") - (fewest - 1))).alias("at", "word"))
    common = first.join(heads, "word").filter("size >= least AND at <= size - least")
    # The first common word of a pair stands lowest on both sides.
    pairs = common.groupBy("block", "size", "template", "label", "n", "least", "words").agg(
        F.min("at").alias("at"), F.min("place").alias("place")
    )
    pairs = pairs.filter("1 + least(size - at - 1, n - place - 1) >= least")
    shared = pairs.withColumn("shared", F.size(F.array_intersect("block", "words"))).filter("shared >= least")
    verdicts = shared.groupBy("block").agg(
        F.collect_set("label").alias("labels"), F.max(F.col("shared") / F.col("n")).alias("share")
    )
    labels = F.array_distinct(F.flatten(F.collect_set("labels"))).alias("found")
    return blocks.join(verdicts, "block").groupBy("blocks", "copies").agg(labels, F.max("share").alias("share"))
