"""The queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroids, fingerprints, language, line_dedup, near_dup, packing, periodic_runs, piece_bpe, quality, topk, toxicity, url_filters
from .common import held_out, in_training, read_table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge_urls(pages, url_filters.rule_table(spark))
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, tokenizer_path("word_bpe_49k.json"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dup.near_duplicates(documents, shingle_words=4)
    return found.select("document.doc_id", "n_shingles", "component_id", "kept")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    documents = read_table(spark, sf_dir, "documents")
    coded = byte_bpe.encode_and_decode(F.col("text"), path, public_tokenizers.PATTERN)
    both = documents.select("doc_id", coded.alias("coded")).select("doc_id", "coded.ids", "coded.decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = language.train(documents.where(in_training("doc_id")))
    labelled = documents.select(
        "doc_id", held_out("doc_id").alias("held_out"), language.label_language(F.col("text"), model).alias("label")
    )
    return labelled.select("doc_id", "held_out", F.col("label.lang").alias("lang_pred"), "label.score")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(documents).select(
        "document.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("vector")
    )
    found = topk.top_k(rows, rows.where(F.col("id") % 50 == 0))
    return found.select("query_id", "rank", "vec_id", "score")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(read_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(in_training("doc_id"))
    model = toxicity.train(documents, labels)
    scored = documents.select("doc_id", toxicity.score_toxicity(F.col("text"), model).alias("t"))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("t.severity"),
        F.col("t.at_least")[0].alias("score"),
        (F.col("t.at_least")[0] >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(in_training("doc_id"))
    model = quality.train(documents, labels)
    scored = documents.select("doc_id", quality.score_quality(F.col("text"), model)["score"].alias("score"))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    coded = piece_bpe.encode_and_decode(F.col("text"), tokenizer_path("piece_bpe_32k.model"))
    both = documents.select("doc_id", coded.alias("coded")).select("doc_id", "coded.ids", "coded.decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = periodic_runs.planted(read_table(spark, sf_dir, "documents"))
    found = documents.select("doc_id", periodic_runs.find_runs(F.col("text")).alias("found"))
    longest = periodic_runs.longest_run(F.col("found.runs"))
    rows = found.select("doc_id", "found.runs", "found.collapsed", longest.alias("longest"))
    line = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", centroids.quantised(F.col("embedding")).alias("vector"))
    return centroids.with_inertia(*centroids.cluster(rows))


QUERIES = {
    query.__name__: query
    for query in (
        op1_url_filters,
        op2_best_fit_packing,
        op3_minhash_near_dedup,
        op4_byte_bpe,
        op5_language_id,
        op6_line_dedup,
        op7_exact_topk,
        op8_fingerprints,
        op9_toxicity,
        op10_quality,
        op11_piece_bpe,
        op12_periodic_runs,
        op13_centroid_clustering,
    )
}
