"""A corpus from raw documents to packed sequences: each stage reads what the one before has kept and written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import mixing, near_duplicates, packing, quality_rules
from martloom.llm import toxicity as toxic
from martloom.llm.catalog import table, tokenizer
from martloom.llm.names import back, marks, number_of, numbered, one_of_alike
from martloom.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are scored as toxic. Labels are read from the table beside the documents'."""
    scored = toxic.toxicity(docs.select("doc_id", "text", *marks(docs)), table(spark, sf_dir, "labels"), marks=("_a", "_b"))
    gone = scored.filter(F.col("predicted") == 1).select("_a", "_b").distinct()
    return numbered(docs).join(gone, ["_a", "_b"], "left_anti").select(*back(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes failing lines, and documents that fail a rule or lose too much text with their lines."""
    text, n_chars = number_of(docs, "text"), number_of(docs, "n_chars")
    judged = quality_rules.quality_rules(numbered(docs).drop("_a", "_b"), text).filter("kept")
    cut = F.col("lost") > 0
    chars = F.when(cut, F.length("clean_text")).otherwise(F.col(n_chars)).cast(docs.schema[int(n_chars[2:])].dataType)
    fresh = judged.withColumns({text: F.when(cut, F.col("clean_text")).otherwise(F.col(text)), n_chars: chars})
    return fresh.select(*back(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies, and all that are in no group (texts without words)."""
    grouped = near_duplicates.near_duplicates(docs.select("doc_id", "text", *marks(docs)), marks=("_a", "_b"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_a", "_b"))
    kept = grouped.filter(F.col("group").isNotNull()).groupBy("group").agg(first.alias("f")).select("f._a", "f._b")
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(f"[^{mixing.BLANKS}]")
    found = one_of_alike(docs.filter(worded)).join(kept, ["_a", "_b"]).select(*back(docs))
    return found.union(docs.filter(~worded))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as the mix has copies of it."""
    return mixing.mixed(docs, mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences: one row per piece."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("quality_rules", quality), ("ngram_jaccard_join", one_of_each_group),
    ("mixing", mix), ("best_fit_packing", pack),
]

#: The classifier cannot be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
