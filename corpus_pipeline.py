"""From raw documents to packed training sequences, in stages that each work on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm import language, line_dedup, near_dup, packing, quality
from muster.llm.common import in_training, read_table, written
from muster.llm.queries import tokenizer_path

#: A document is let through from this language score on: most of its words are in one language that is known.
LEAST_LANGUAGE_SCORE = 0.3


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality; the labels of the corpus teach what that is."""
    labels = read_table(spark, sf_dir, "labels").where(in_training("doc_id"))
    model = quality.train(docs, labels)
    scored = docs.select(F.struct("*").alias("document"), quality.score_quality(F.col("text"), model)["score"].alias("score"))
    return scored.where(F.col("score") >= quality.THRESHOLD).select("document.*")


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has learnt; without letters or of many languages they go."""
    model = language.train(docs.where(in_training("doc_id")))
    labelled = docs.select(F.struct("*").alias("document"), language.label_language(F.col("text"), model).alias("label"))
    known = (F.col("label.lang") != language.UNDETERMINED) & (F.col("label.score") >= LEAST_LANGUAGE_SCORE)
    return labelled.where(known).select("document.*")


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    deduped = line_dedup.dedup_lines(docs).select("document.*", "kept_text")
    return deduped.withColumns({"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}).drop("kept_text")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.near_duplicates(docs).where("kept").select("document.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of bounded length."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_documents),
    ("language ID", known_languages),
    ("line dedup", own_lines),
    ("MinHash near-dedup", distinct_documents),
    ("best-fit packing", packed_sequences),
]

#: SQL can express neither the models nor the packing; the tests compare each stage with a plain account of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
