"""Columns of any name pass through every operator and stage, and working tables go."""

from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import queries
from plumbline.llm.centroid_clusters import cluster_vectors
from plumbline.llm.chat_format import rotate
from plumbline.llm.decontamination import decontaminated, find_contamination
from plumbline.llm.language_id import fit_language_id, predict_language, sample
from plumbline.llm.license_scan import scan_licenses
from plumbline.llm.mixing import mix_sources
from plumbline.llm.near_duplicates import near_duplicates, without_near_duplicates
from plumbline.llm.quality_rules import apply_quality_rules
from plumbline.llm.simhash import simhash_groups
from plumbline.llm.suffix_dedup import remove_repeats
from plumbline.llm.token_counts import count_tokens
from plumbline.llm.url_filter import filter_urls
from plumbline.llm.vector_codes import code_vectors
from plumbline.session import checkpoint_root

TINY = "/root/testdata/sf0.001"
#: Names that operators use, or used, inside.
NAMES = [
    "__text__", "__key", "__blocks", "__places", "__letters__", "__hash", "__source", "__none", "__id", "__part", "row",
    "none", "c0", "key", "id", "part", "copies", "text_key", "hash", "cell", "label", "vector", "a.b", "`q`", "n",
]


def odd(docs, *own):
    """The table with a column of every odd name that says so, null in each second row."""
    taken = {c.lower() for c in (*docs.columns, *own)}
    names = [n for n in NAMES if n not in taken]
    first = F.col(docs.columns[0])
    values = [F.when(first.cast("long") % 2 == 0, F.lit(f"in {n}")).alias(n) for n in names]
    return docs.select("*", *values), names


def kept(found, names, key, expected):
    """Every odd column is there, once, with what it had."""
    columns = [F.col("`" + n.replace("`", "``") + "`") for n in names]
    rows = found.select(F.col(key).alias("__own"), F.array(*columns).alias("__values")).collect()
    assert len(rows) == expected
    for r in rows:
        assert r[1] == ([f"in {n}" for n in names] if r[0] % 2 == 0 else [None] * len(names))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet").filter("doc_id < 60").cache()


OPERATORS = {
    "count_tokens": lambda d: count_tokens(d, public_tokenizers.path("piece_bpe_32k.model")),
    "predict_language": lambda d: predict_language(d, fit_language_id(d, F.lit(True), rows=20)),
    "scan_licenses": scan_licenses,
    "apply_quality_rules": apply_quality_rules,
    "remove_repeats": lambda d: remove_repeats(d, kept_text=True),
    "find_contamination": lambda d: find_contamination(d, d.limit(3), item_id="doc_id"),
    "joined contamination": lambda d: find_contamination(d, d.limit(3), item_id="doc_id", broadcast_bytes=0),
    "decontaminated": lambda d: decontaminated(d, d.limit(0), item_id="doc_id"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operators_keep_odd_columns(docs, name):
    table, names = odd(docs)
    found = OPERATORS[name](table)
    kept(found, [n for n in names if n in found.columns], "doc_id", 60)
    made = {"n_tokens", "lang_pred", "labels", "kept", "n_removed", "n_hit"}
    assert set(names) - set(found.columns) <= {"n"} and (made & set(found.columns) or name == "decontaminated")


def test_other_operators_take_odd_columns(spark, docs):
    table, names = odd(docs)
    kept(mix_sources(table, carry=[n for n in names if n != "copies"]), [n for n in names if n != "copies"], "doc_id", 60)
    few = without_near_duplicates(table)
    assert few.columns == table.columns
    kept(few, names, "doc_id", few.count())
    assert near_duplicates(table).count() == simhash_groups(table).count() == 60
    points, names = odd(spark.read.parquet(f"{TINY}/embeddings.parquet").filter("vec_id < 50"))
    kept(cluster_vectors(points), names, "vec_id", 50)
    kept(code_vectors(points), names, "vec_id", 50)
    turns, _ = odd(spark.read.parquet(f"{TINY}/conversations.parquet"))
    assert rotate(turns).count() > 0
    pages, _ = odd(spark.read.parquet(f"{TINY}/pages.parquet"))
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    assert filter_urls(pages, rules).count() == pages.count()


def test_stages_keep_odd_columns(spark, docs):
    table, names = odd(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, table, TINY)
        assert found.columns == table.columns
        kept(found, names, "doc_id", found.count())
    assert corpus_pipeline.mixing(spark, table, TINY).count() > 0


def folders(spark):
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    return {p.name for p in root.iterdir()} if root.exists() else set()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_a_query_leaves_its_result_only(spark, name):
    before = folders(spark)
    queries.QUERIES[name](spark, TINY).count()
    assert len(folders(spark) - before) <= 1


def test_the_pipeline_leaves_its_result_only(spark):
    before = folders(spark)
    assert corpus_pipeline.run(spark, TINY).count() > 0
    assert len(folders(spark) - before) == 1


def test_language_sample_has_a_hard_bound(spark):
    rows = [(7, f"wort {i} " * 3, "de") for i in range(300)] + [(i, f"word {i} " * 3, "en") for i in range(300)]
    rows += [(None, f"mot {i} " * 3, "fr") for i in range(300)] + [(3, "copy of one", "it")] * 500
    rows += [(i, f"l{i} x{i}", f"l{i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    found = sample(docs, F.lit(True), "doc_id", "text", "lang", 20, 0)
    counts = {}
    for lang, _, pieces in found:
        counts[lang] = counts.get(lang, 0) + 1
        assert len(pieces) == 3
    assert {k: v for k, v in counts.items() if v > 1} == {"de": 20, "en": 20, "fr": 20}
    assert len(counts) == 104 and counts["it"] == 1
    again = sample(docs.repartition(3), F.lit(True), "doc_id", "text", "lang", 20, 0)
    assert again == found


def test_no_language_is_lost_with_its_ids(spark):
    rows = [(5, " ".join(["the", "house", f"no{i}", "stands"]), "en") for i in range(60)]
    rows += [(None, " ".join(["das", "haus", f"nr{i}", "steht"]), "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = fit_language_id(docs, F.lit(True), rows=30)
    assert network.languages == ["de", "en"]
    found = predict_language(docs, network).filter("lang = lang_pred").count()
    assert found >= 110
