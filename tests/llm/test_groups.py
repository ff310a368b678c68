"""Near duplicates, repeated strings, mixing, URLs, dialogues and the pipeline."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from plumbline.llm import chat_format, queries, suffix_dedup
from plumbline.llm.chat_format import rotate
from plumbline.llm.mixing import mix_sources
from plumbline.llm.near_duplicates import least_common, near_duplicates, without_near_duplicates
from plumbline.llm.url_filter import filter_urls

TINY = "/root/testdata/sf0.001"


def rows(frame, *columns):
    return [tuple(r) for r in frame.orderBy("doc_id").select(*columns).collect()]


def varied_texts(seed, n):
    """Texts, exact and near copies of them in groups, short, empty and null ones."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(300)]
    texts = [None, "", " \n", "one", "one two", "ONE two", "one two three"]
    while len(texts) < n:
        base = rng.choices(words, k=rng.choice([5, 30, 90, 400]))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
        texts.append(texts[-1])
    return texts


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, docs_of, words, percent):
    texts = varied_texts(words, 180)
    found = near_duplicates(docs_of(texts), words=words, percent=percent)
    expected = brute.near_groups(texts, words, percent)
    assert rows(found, "n_shingles", "component_id") == expected
    assert rows(found, "kept") == [(i == e[1],) for i, e in enumerate(expected)]


def test_one_document_of_each_group_stays(spark, docs_of):
    texts = varied_texts(9, 60)
    kept = without_near_duplicates(docs_of(texts))
    groups = brute.near_groups(texts, 5, 80)
    assert {r.doc_id for r in kept.collect()} == {i for i, g in enumerate(groups) if g[1] == i}
    assert near_duplicates(docs_of(["x"]).limit(0)).count() == 0


def test_repeated_and_missing_ids(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (None, "other words here")], "doc_id long, text string")
    found = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_duplicates(docs).collect())
    assert found == [(-1, -1, True), (-1, 4, False), (4, 4, True), (4, 4, True)]


def test_sketches_lose_no_linked_pair():
    assert least_common(48, 85) == 22 and least_common(1, 85) == 1


def repeated_texts():
    rng = random.Random(4)
    passages = ["".join(rng.choices("abcdefg hé\n", k=rng.choice([150, 199, 200, 260, 700]))) for _ in range(12)]
    texts = [None, "", "short", "x" * 199, "y" * 200, "z" * 201, "Ab cd " * 200]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 3)):
            p = rng.choice(passages)
            parts += ["".join(rng.choices("klmnop ", k=rng.randint(0, 200))), p[rng.randint(0, 20) :]]
        texts.append("".join(parts))
    return [*texts, texts[-1], texts[-2]]


@pytest.mark.parametrize("sizes,crowded", [(None, None), ((30, 25), 4), ((30, 25), 0), ((50, 200), 0.3)])
def test_repeats_equal_brute_force(spark, docs_of, monkeypatch, sizes, crowded):
    if sizes:
        monkeypatch.setattr(suffix_dedup, "RUN_SUFFIXES", sizes[0])
        monkeypatch.setattr(suffix_dedup, "RANGE_SUFFIXES", sizes[1])
        monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
        monkeypatch.setattr(suffix_dedup, "PART_STARTS", 90)
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 500)
    texts = repeated_texts()
    found = suffix_dedup.remove_repeats(docs_of(texts), kept_text=True)
    assert rows(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(texts)
    left = rows(found, "kept_text", "n_bytes", "n_removed")
    assert left[0] == (None, 0, 0)
    assert all(len(t.encode()) == b - r for t, b, r in left[1:] if "\ufffd" not in t)
    assert suffix_dedup.remove_repeats(docs_of(["x"]).limit(0)).count() == 0


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(2)
    strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 9))) for _ in range(800)]
    runs = []
    for i in range(5):
        run = sorted(strings[i::5])
        runs.append((run, [0, *(suffix_dedup.common_prefix(a, b) for a, b in zip(run, run[1:]))]))
    out = [(runs[r][0][i], k) for r, i, k in suffix_dedup.LoserTree([*runs, ([], [])])]
    assert [s for s, _ in out] == sorted(strings)
    assert all(k == suffix_dedup.common_prefix(a, b) for (a, _), (b, k) in zip(out, out[1:]))


def test_mix_meets_its_targets(spark):
    rng = random.Random(3)
    data = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "c", "d", None])) for i in range(800)]
    data += [(i, "same words", "a") for i in range(800, 1200)] + [(None, None, "empty")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = [r.asDict() for r in mix_sources(docs, carry=["source", "size"]).collect()]
    assert len(found) == len(data)
    whole, targets = 0, {}
    for source in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == source]
        size = sum(r["size"] for r in own)
        whole, targets[source] = whole + size, own[0]["target"]
        assert {r["source_size"] for r in own} == {size} and len({r["target"] for r in own}) == 1
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2 * max(r["size"] for r in own)
        assert own[0]["target"] <= 2 * size + 1e-9
    assert sum(targets.values()) == pytest.approx(1.5 * whole)
    assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] in (0, 1, 2) for r in found)
    again = [r.asDict() for r in mix_sources(docs.repartition(7), carry=["source", "size"]).collect()]
    key = lambda r: (r["doc_id"] is None, r["doc_id"])
    assert sorted(found, key=key) == sorted(again, key=key)
    assert mix_sources(docs.limit(0)).count() == 0


URLS = [
    None, "", "no scheme", "http://example.com", "http://EXAMPLE.com/en/x?q#f", "http://www.example.com/en/", "https://a.b.net/es/1",
    "http://net/fr/", "http://net.org/fr/", "ftp://x.example.com/en/1", "x://notexample.com/en/", "http://a.net/EN/", "http://com/#/x",
    "http://example.com/en/x", "a://b://net/fr/",
]


@pytest.mark.parametrize("range_rows", [2, 1000])
def test_url_rules_equal_brute_force(spark, range_rows):
    from plumbline.llm.queries import URL_RULES

    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 3)], "page_id long, url string, rule string")
    rules = spark.createDataFrame([*URL_RULES, (None, "/", "block")], "host string, path string, verdict string")
    found = {r.page_id: tuple(r)[1:] for r in filter_urls(pages, rules, range_rows=range_rows).collect()}
    for i, url in enumerate(URLS * 3):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = rest.replace("?", "/").replace("#", "/").split("/")[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = host.translate(brute.CAPITALS)
        fits = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        assert found[i] == (host, path, best and best[0] + best[1], best[2] if best else "allow")
    assert filter_urls(pages.limit(0), rules).count() == 0


CHATS = "conv_id long, turn long, role string, text string, speaker string"


def dialogues(messages, part_chars, opening_chars):
    """(conv, speaker, part) to (messages, rendered, learned texts), by plain Python."""
    out = {}
    unique = {(c, t, r or "unknown", x or "") for c, t, r, x in messages}
    for conv in {m[0] for m in unique}:
        own = sorted((m[1] is None, m[1] or 0, m[2], m[3]) for m in unique if m[0] == conv)
        parts, opening, before, opened = {}, [], 0, False
        for _, _, role, text in own:
            opened |= role != "system"
            if not opened and before < opening_chars:
                opening.append((role, text))
            parts.setdefault(before // part_chars, []).append((role, text))
            before += len(role) + len(text) + 24
        for part, said in parts.items():
            said = (opening if part else []) + said
            for speaker in {m[2] for m in own} - {"system"}:
                lines, learned = [], []
                for role, text in said:
                    kind = "assistant" if role == speaker else "system" if role == "system" else "user"
                    name = f"{role}: " if kind == "user" else ""
                    lines.append(f"<|{kind}|>\n{name}{text}<|end|>\n")
                    if role == speaker:
                        learned.append(f"{text}<|end|>")
                out[conv, speaker, part] = (len(said), "".join(lines), learned)
    return out


def found_dialogues(frame):
    return {
        (r.conv_id, r.speaker, r.part): (r.n_messages, r.rendered, [r.rendered[m.first : m.end] for m in r.mask])
        for r in frame.collect()
    }


def some_dialogues():
    rng = random.Random(3)
    said = [(1, 0, "system", "Be kind."), (1, 100, "ann", "Hi"), (1, 200, "bob", "Hello <|end|>"), (1, 200, "bob", "Hello <|end|>")]
    # Sparse and null turns, many messages of one turn, null ids, roles and texts, a system message late.
    said += [(2, t, "ann" if t % 2 else "bob", f"turn {t} é") for t in range(200)]
    said += [(2, -1, "system", "first"), (2, -1, "system", "second"), (2, 77, "system", "late")]
    said += [(2, None, "bob", "no turn"), (2, None, None, None), (3, 10**12, "cy", None), (3, 5, "cy", "x" * 500)]
    said += [(None, i, rng.choice(["p", "q"]), "lost") for i in range(5)] + [(4, 1, "system", "alone")]
    return said + [(5, 7, f"r{i % 3}", f"{i}") for i in range(60)]


@pytest.mark.parametrize("part_chars,opening_chars", [(1 << 20, 1 << 16), (300, 60), (80, 0), (1, 1)])
def test_dialogues_rotate(spark, monkeypatch, part_chars, opening_chars):
    monkeypatch.setattr(chat_format, "RANGE_ROWS", 20)
    monkeypatch.setattr(chat_format, "BROADCAST_OPENINGS", 2)
    said = some_dialogues()
    frame = spark.createDataFrame([(*m, "clash") for m in said], CHATS).repartition(4)
    found = found_dialogues(rotate(frame, part_chars=part_chars, opening_chars=opening_chars))
    assert found == dialogues(said, part_chars, opening_chars)
    if part_chars == 1 << 20:
        assert all(part == 0 for _, _, part in found) and found[2, "ann", 0][0] == 205
    assert rotate(frame.limit(0)).count() == 0


def test_a_long_dialogue_equals_its_sql(spark, tmp_path):
    said = some_dialogues() + [(9, i, ["ann", "bob"][i % 2], f"{i} " * 300) for i in range(2500)]
    said += [(9, -5, "system", "Be brief."), (9, -5, "system", "z" * 70_000), (9, -4, "system", "not repeated")]
    said += [(8, None, "ann", "w" * 1_100_000), (8, 3, "system", "late"), (8, 1, "bob", "v" * 1_100_000)]
    spark.createDataFrame([(*m, None) for m in said], CHATS).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    theirs = con.execute(queries.SQL["op10_chat_format"]).fetchall()
    ours = queries.op10_chat_format(spark, str(tmp_path)).collect()
    assert {r.part for r in ours if r.conv_id == 9} == {0, 1, 2, 3}
    assert sorted(map(str, map(tuple, ours))) == sorted(map(str, theirs))


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["language"](spark, docs, TINY)
    assert kept.columns == columns and kept.count() >= 0.99 * len(texts)
    near = steps["near_duplicates"](spark, docs, TINY).collect()
    order = sorted(texts)
    groups = brute.near_groups([texts[i] for i in order], 5, 80)
    assert {r.doc_id for r in near} == {order[g] for _, g in groups}
    cut = steps["repeated_strings"](spark, docs, TINY)
    expected = dict(zip(order, brute.repeats([texts[i] for i in order])))
    found = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == columns
    assert set(found) == {i for i, e in expected.items() if e[1] == 0 or e[1] < e[0]}
    assert all(r.n_chars == len(r.text) for i, r in found.items() if expected[i][1])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    clean = steps["decontamination"](spark, docs, TINY)
    judged = brute.contamination([texts[i] for i in order], items)
    assert {r.doc_id for r in clean.collect()} == {i for i, j in zip(order, judged) if not j[4]}
    result = corpus_pipeline.run(spark, TINY)
    assert result.count() > 0 and result.filter(F.col("copies") < 1).count() == 0


def test_one_row_of_repeated_rows_passes_the_stages(spark):
    rng = random.Random(11)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    repeated, nameless, near, several, alone = (text() for _ in range(5))
    data = [
        (4, repeated, "a"), (4, repeated, "a"), (4, repeated, "b"), (None, nameless, "a"), (None, nameless, "a"),
        (None, near + " x", "a"), (None, near + " y", "a"), (8, several + " x", "a"), (8, several + " y", "a"),
        (9, alone, "a"), (10, " ", "a"), (10, " ", "a"), (None, None, "a"), (None, None, "a"),
    ]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in data], "doc_id long, text string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, TINY)
    assert kept.columns == docs.columns
    texts = sorted((r.text or "") for r in kept.collect())
    assert len(texts) == 9
    for one in ([repeated], [nameless], [near + " x", near + " y"], [several + " x", several + " y"], [alone]):
        assert sum(texts.count(t) for t in one) == 1
    left = corpus_pipeline.repeated_strings(spark, kept, TINY)
    assert sorted((r.text or "") for r in left.collect()) == texts
    again = corpus_pipeline.near_duplicates(spark, docs.repartition(5), TINY)
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))
