"""Token counts, language, licenses, quality and decontamination of small texts."""

import random
import zlib

import duckdb
import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from plumbline.llm import decontamination, queries
from plumbline.llm.decontamination import decontaminated, find_contamination
from plumbline.llm.language_id import ByteNetwork, fit_language_id, is_held_out, predict_language
from plumbline.llm.license_scan import scan_licenses
from plumbline.llm.quality_rules import BASE_RULES, FACTS, RULES, Fact, Rule, apply_quality_rules, estimated_order, judged
from plumbline.llm.token_counts import count_tokens, packed, pre_token_pattern, unpacked

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n", "  a  b ", "\n\n x\ny  ", "▁▁x ▁", "a²b½c é中文 字x9 \u3000\t<s> </s>▁<unk> ﬁn", "١٢a",
    "x\r\n;\r\n  }\r\n", "日本語のテキスト English 123abc", "🙂🙂 a🙂b", "\x00\x01 a", "same", "same", "word " * 30_000,
]

TINY = "/root/testdata/sf0.001"


def rows(frame, *columns):
    return [tuple(r) for r in frame.orderBy("doc_id").select(*columns).collect()]


def test_token_counts_equal_the_library(spark, docs_of):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = rows(count_tokens(docs_of(ODD), MODEL, limit=9), "n_bytes", "n_tokens", "over_limit", "n_words")
    for text, (size, tokens, over, kept) in zip(ODD, found):
        expected = len(model.encode(text or ""))
        assert (size, tokens, over, kept) == (len((text or "").encode()), expected, expected > 9, "x")


def test_token_counts_of_the_table(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    for r in queries.op1_token_counts(spark, TINY).collect():
        assert r.n_tokens == len(model.encode(texts[r.doc_id] or ""))


def test_token_counts_of_small_blocks(spark, docs_of):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for limit in (1, 50):
        found = rows(count_tokens(docs_of(ODD * 3), MODEL, carry=["doc_id", "text"], block_chars=limit), "text", "n_tokens")
        assert found == [(t, len(model.encode(t or ""))) for t in ODD * 3]


def test_frequencies_round_trip():
    for places, numbers in (([], []), ([70_000, 3, 0], [1, 255, 256]), ([5], [100_000])):
        at, n = unpacked(packed(np.array(places, np.int64), np.array(numbers, np.int64)))
        assert n.max(initial=0) <= 255
        assert [int(n[at == p].sum()) for p in places] == numbers


def test_pre_tokens_must_stand_alone():
    with pytest.raises(ValueError):
        pre_token_pattern(["▁a", "a▁b"])


def test_empty_table(spark, docs_of):
    none = docs_of(["x"]).limit(0)
    assert count_tokens(none, MODEL).count() == 0
    assert find_contamination(none, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    assert scan_licenses(none).count() == 0
    assert apply_quality_rules(none).count() == 0
    network = fit_language_id(none, F.lit(True))
    assert network.languages == [] and predict_language(docs_of(["abc"]), network).first().lang_pred == "und"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    network = ByteNetwork(["a", "b", "c"], units=3)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    sizes = np.array([7, 5, 3])
    windows = rng.integers(0, 5, (3, 7)).astype(np.uint8)
    labels = np.array([0, 2, 1])

    def loss():
        p = network.probabilities(windows, sizes).astype(np.float64)
        there = np.arange(7)[:, None] < sizes
        return -np.log(p[:, labels, np.arange(3)])[there].mean()

    found = network.gradients(windows, sizes, labels)
    for name in ("state_f", "out_b", "byte_b", "bias"):
        flat = network.weights[name].reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 7)):
            kept = flat[i]
            flat[i] = kept + 1e-2
            up = loss()
            flat[i] = kept - 1e-2
            down = loss()
            flat[i] = kept
            assert found[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_windows_do_not_change_the_score():
    network = ByteNetwork(["a", "b"])
    text = ("abc dé " * 200).encode()
    alone = network.score(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    both = np.frombuffer(b"xy" + text + b"z", np.uint8)
    beside = network.score(both, np.array([0, 2, 2 + len(text), 3 + len(text)]))
    assert np.allclose(alone[0], beside[1], atol=1e-5)


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    found = queries.op2_language_id(spark, TINY).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in found)


def test_texts_without_letters_have_no_language(spark, docs_of):
    texts = [None, "", "12 3!", "the a of " * 9, "the a of " * 9, "der die " * 4000]
    docs = docs_of(texts, langs=["en", None, "en", "en", "en", "de"])
    found = rows(predict_language(docs, fit_language_id(docs, F.lit(True))), "lang_pred", "score")
    assert [f[0] for f in found[:3]] == ["und"] * 3 and found[0][1] == 0.0
    assert found[3] == found[4] and found[5][0] == "de"


LICENSES = [
    None, "", "MIT License", "the mit\nlicense. Mit  license!", "Submit license", "mit licenses", "mit élicense",
    "General Public License and Apache-License", "Some text.\n\nLicensed under CC BY-NC 4.0.\n\nMore.",
    "permission is hereby granted to any person", "mit license " * 9000, "!mit license", "İ mit license",
]


def test_license_places(spark, docs_of):
    found = rows(scan_licenses(docs_of(LICENSES)), "n_words", "n_base", "first_word", "last_word", "base_labels")
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    for text, row in zip(LICENSES, found):
        words = brute.plain_words(text)
        at = [(i, l) for p, l in phrases.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
        places = [i for i, _ in at]
        labels = ",".join(sorted({l for _, l in at}))
        assert row == (len(words), len(at), min(places, default=None), max(places, default=None), labels)


def test_license_templates(spark, docs_of):
    found = rows(scan_licenses(docs_of(LICENSES)), "labels", "score")
    assert found[8] == ("cc", 1.0) and found[9][0] == "" and found[0] == ("", 0.0)
    templates = [("t", "one two three four five"), ("u", "six"), ("none", "!")]
    texts = ["five x four three two", "one two three", "six\n\none two three four", None]
    found = rows(scan_licenses(docs_of(texts), templates=templates, phrases={}, whole_words=0), "labels", "score")
    assert found == [("t", 0.8), ("", 0.0), ("t,u", 1.0), ("", 0.0)]
    found = rows(scan_licenses(docs_of(texts), templates=templates, phrases={}), "labels", "score")
    assert found == [("", 0.0), ("", 0.0), ("u", 1.0), ("", 0.0)]


def test_notices_of_other_licenses_get_no_label(spark, docs_of):
    texts = [
        "The book was released by the press under a license from the author.",
        "Educational Community License, Version 2.0: licensed under the terms",
        "This was released under the Apache license.",
        "Released under the MIT License.",
        "Licensed under the Apache License, Version 2.0 (the License)",
        "This work is licensed under the Academic Free License, version 3",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Permission is hereby granted to the visitors of this house, free of charge, to use the garden.",
    ]
    found = rows(scan_licenses(docs_of(texts)), "labels")
    assert [f[0] for f in found] == ["", "", "apache", "mit", "apache", "", "cc", ""]


def test_quality_cascade(spark, docs_of):
    texts = [None, "", "a b c a b c", "w " * 60, "x1 x2\nx1 x2\n \nx1 x2", "## " * 60, " ".join(f"word{i}" for i in range(80))]
    facts = ("n_words", "n_repeat_words", "n_dup_lines", "n_symbols", "word_chars")
    found = rows(apply_quality_rules(docs_of(texts), facts=facts), *facts, "kept")
    for text, row in zip(texts, found):
        words = brute.SPACED.findall(text or "")
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        lines = [l for l in (text or "").split("\n") if l.strip(" \t\n\x0b\x0c\r")]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        assert row[:5] == (len(words), len(hit), len(lines) - len(set(lines)), symbols, sum(map(len, words)))
    assert [r[5] for r in found] == [False] * 6 + [True]


def packed_rows(docs):
    return docs.select(F.struct(F.col("doc_id")).alias("row"), F.coalesce("text", F.lit("")).alias("text"))


def test_rules_stand_by_rejection_per_cost(spark, docs_of):
    docs = packed_rows(docs_of(["a b " * 50] * 40))
    never, always = Rule("never", ("n_words",), lambda n: n < 0), Rule("always", ("n_words",), lambda n: n > 0)
    assert [r.name for r in estimated_order(docs, [never, always])] == ["always", "never"]
    dear = Rule("dear", ("n_repeat_words",), lambda n: n > 0)
    assert [r.name for r in estimated_order(docs, [dear, always])] == ["always", "dear"]
    # What is known already costs nothing.
    assert [r.name for r in estimated_order(docs, [always, dear], ("n_repeat_words",))] == ["dear", "always"]
    assert all(f in FACTS for r in RULES for f in r.facts)


def test_rule_order_is_the_same_each_time(spark):
    docs = packed_rows(spark.read.parquet(f"{TINY}/documents.parquet"))
    orders = {
        tuple(r.name for r in estimated_order(docs.repartition(n), BASE_RULES + RULES, sample_rows=50))
        for n in range(1, 11)
    }
    assert len(orders) == 1


def test_failed_rows_find_no_later_facts(spark, docs_of, monkeypatch):
    """A fact that fails the job where it is found is not found behind a failed rule."""

    def trap(text):
        return F.when(text.contains("word"), F.length(text)).otherwise(F.raise_error(F.lit("found"))).cast("long")

    monkeypatch.setitem(FACTS, "trap", Fact(trap, lambda f: 1000 * f["n_chars"]))
    short = Rule("short", ("n_words",), lambda n: n < 50)
    trapped = Rule("trapped", ("trap",), lambda n: n < 0)
    long = " ".join(f"word{i}" for i in range(80))
    docs = packed_rows(docs_of([None, "", "a b", long, "x " * 49]))
    kept = judged(docs, (short, trapped)).orderBy("row").select("failed_rule").collect()
    assert [r.failed_rule for r in kept] == ["short", "short", "short", None, "short"]
    with pytest.raises(Exception, match="found"):
        judged(docs, (trapped, short)).collect()


def test_plan_finds_rule_facts_inside_the_cascade(spark, docs_of):
    plan = apply_quality_rules(docs_of(["a b"]), carry=["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    upper, lower = plan.rsplit("Project", 1)
    for fact in (r"\P{Lu}+", "[^#*$%&|<>]+", r"\P{L}+", "sequence("):
        assert fact not in lower and upper.count(fact) <= 2
        assert "CASE WHEN" in upper[: upper.index(fact)] and upper.index(fact) < upper.index("AS failed_rule")


def contaminated_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "X-ray", "o'clock"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 12, 13, 14, 40])))) for i in range(40)]
    items += [(7, "repeated id of an item"), (None, "w1"), (99, None)]
    texts = [None, "", "w1"]
    for _ in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 80)))]
        for _ in range(rng.randint(0, 3)):
            got = (rng.choice(items)[1] or "").upper().split()
            at = rng.randint(0, max(0, len(got) - 5))
            parts += [", ".join(got[at : at + rng.randint(1, 30)]), " ".join(rng.choices(words, k=5))]
        texts.append("\n".join(parts))
    return texts + [texts[-1], "ww " * 20_000], items


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_decontamination_equals_brute_force(spark, docs_of, limit):
    texts, items = contaminated_texts()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(docs_of(texts), benchmark, broadcast_bytes=limit)
    known = [(i, t) for i, t in items if i is not None and t is not None]
    expected = brute.contamination(texts, known)
    assert rows(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected
    kept = decontaminated(docs_of(texts), benchmark)
    assert kept.columns == docs_of(["x"]).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, e in enumerate(expected) if not e[4]}


def test_a_common_phrase_joins_no_pairs(spark, docs_of, monkeypatch):
    """Every text and item has one phrase of nine words: only true windows make pairs."""
    rng = random.Random(6)
    phrase = "it is a truth that everyone here will know"
    text = lambda: " ".join(f"u{rng.randrange(10**6)}" for _ in range(30))
    texts = [f"{text()} {phrase} {text()}" for _ in range(120)]
    items = [(i, f"{text()} {phrase} {text()}") for i in range(80)]
    items += [(1000 + i, " ".join(texts[i].split()[i : i + 13])) for i in range(20)]
    items += [(2000, phrase)]
    written, sizes = decontamination.written_table, {}

    def watch(df, name, **options):
        table = written(df, name, **options)
        sizes[name] = table.count()
        return table

    monkeypatch.setattr(decontamination, "written_table", watch)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(docs_of(texts), benchmark, broadcast_bytes=0)
    assert rows(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute.contamination(texts, items)
    assert sizes["leak-pairs"] == 120 + 20


def test_items_without_id_contaminate(spark, docs_of, tmp_path):
    words = [f"n{i}" for i in range(30)]
    items = [(None, " ".join(words[:20])), (None, "lone"), (3, " ".join(words[10:])), (5, None), (None, None)]
    texts = [" ".join(words[:14]), "lone", "lone " + " ".join(words), " ".join(words[12:]), "other words", None]
    docs = docs_of(texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    expected = sorted(con.execute(queries.SQL["op9_decontamination"]).fetchall())
    assert [(e[2], e[3], e[5]) for e in expected[:4]] == [(14, 1, True), (1, 1, True), (31, 2, True), (18, 1, True)]
    found = queries.op9_decontamination(spark, str(tmp_path))
    assert rows(found, *found.columns) == expected
    benchmark = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
    joined = find_contamination(docs, benchmark, broadcast_bytes=0, carry=["doc_id"], unnamed=True)
    assert rows(joined, *found.columns) == expected
    clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert {r.doc_id for r in clean.collect()} == {4, 5}
