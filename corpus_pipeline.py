"""A corpus pipeline: each stage works on what the one before kept."""

from pyspark.sql import functions as F

from plumbline.llm.arrow import column, packed, unpacked
from plumbline.llm.decontamination import decontaminated
from plumbline.llm.language_id import UNKNOWN, fit_language_id, is_held_out, predict_language
from plumbline.llm.mixing import mix_sources
from plumbline.llm.near_duplicates import without_near_duplicates
from plumbline.llm.suffix_dedup import remove_repeats
from plumbline.session import remove_folder, scratch, shared_folder

#: A document whose likeliest language has a smaller share of it is rejected.
LEAST_SCORE = 0.35


def language(spark, docs, sf_dir):
    """Documents in a language that the network can tell; the rest go."""
    network = fit_language_id(docs, ~is_held_out("doc_id"))
    rows = docs.select(packed(docs.columns), column("text").alias("text"))
    found = predict_language(rows, network, carry=["row"])
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return unpacked(kept.select("row"), docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates, five words and 0.8."""
    return without_near_duplicates(docs)


def repeated_strings(spark, docs, sf_dir):
    """Texts without the bytes of repeated 200-byte strings; emptied ones go.

    n_chars follows the text. A document that had no text before stays.
    """
    found = remove_repeats(docs, carry=[c for c in docs.columns if c != "text"], kept_text=True)
    cut = F.col("n_removed") > 0
    found = found.filter(~cut | (F.col("n_removed") < F.col("n_bytes")))
    changed = {
        "text": F.col("kept_text"),
        "n_chars": F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }
    return found.select(*[changed.get(c, column(c)).alias(c) for c in docs.columns])


def decontamination(spark, docs, sf_dir):
    """Documents of which less than a twentieth lies in benchmark windows."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), unnamed=True)


def mixing(spark, docs, sf_dir):
    """The documents that the mix takes, with the number of times and words."""
    mixed = mix_sources(docs, carry=["source", "lang"])
    return mixed.filter("copies > 0").select("doc_id", "source", "lang", "size", "copies", "taken")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The network of the first stage cannot be stated in SQL; the tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each is written and read again by the next.

    A stage's table and all it wrote on the way go when the next one is written, so
    that two copies of the corpus are there at most, and only the result stays.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove_folder(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
