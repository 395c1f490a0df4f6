"""The text operators as registered queries over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepflow.catalog.registry import query

from . import alignment, archives, decontaminate, licenses, mixing, ngram_model, pii, quality, set_join, substrings, tokens, toxicity, vector_codes
from .common import table

HELD_OUT = "crc32(cast(doc_id AS string)) % 5 = 0"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_repair_tokens")
def op1_repair_tokens(spark: SparkSession, folder: str) -> DataFrame:
    shards = tokens.write_shards(table(spark, folder, "documents"), vocabulary(), end_id=2)
    return tokens.read_documents(shards)


@query("op2_jaccard_join", set_join.JOIN_SQL)
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return set_join.join_sets(table(spark, folder, "documents"), n=3, threshold="0.9").drop("rid")


@query("op3_license_rules")
def op3_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("detections")


@query("op4_disclosure_pii")
def op4_disclosure_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.sanitise(table(spark, folder, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in pii.PATTERNS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


@query("op5_soft_mixing")
def op5_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rated = mixing.rate_documents(docs, docs, table(spark, folder, "labels"))
    return rated.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), *[F.col("p")[i].alias(f"p_{n}") for i, n in enumerate(mixing.TARGETS)], "rate", "copies")


@query("op6_zip_warc", archives.ARCHIVE_SQL)
def op6_zip_warc(spark: SparkSession, folder: str) -> DataFrame:
    written = archives.write_archives(archives.mark_revisits(table(spark, folder, "pages"), min_bytes=0))
    return archives.read_archives(written).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_mil_toxicity")
def op7_mil_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels").where(f"NOT {HELD_OUT}"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted", F.size("sentences").alias("n_sentences"))


@query("op8_fm_substrings", substrings.REPEATS_SQL)
def op8_fm_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents"), window=35).drop("spans")


@query("op9_containment", decontaminate.MARK_SQL)
def op9_containment(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.mark(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")


@query("op10_rule_cascade")
def op10_rule_cascade(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[0]


@query("op12_ngram_trie")
def op12_ngram_trie(spark: SparkSession, folder: str) -> DataFrame:
    held_out = "crc32(cast(doc_id AS string)) % 10 = 0"
    model, scores = ngram_model.fit(table(spark, folder, "documents"), f"NOT {held_out}", keep_levels=False)
    return scores.select("doc_id", F.expr(held_out).alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query("op13_resident_codes", vector_codes.compress_sql())
def op13_resident_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))
