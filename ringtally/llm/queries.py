"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ringtally.llm import (
    adaptive_scan,
    byte_bpe,
    fixity,
    importance_resampling,
    kd_sharding,
    language_mixture,
    mixing,
    near_dedup,
    quality_rules,
    sanitisation,
    spelling_variants,
    template_removal,
    url_lists,
)
from ringtally.llm.common import table

SHARDS = 40


def tokenizer() -> tuple[str, str]:
    """Rank file and pattern of the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_fixity(spark, folder):
    """Pages as WARC records, against a copy with known faults."""
    records = fixity.placed(fixity.warc_records(table(spark, folder, "pages")))
    return fixity.audit(records, fixity.damaged_copy(records))


def op2_adaptive_scan(spark, folder):
    return adaptive_scan.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_url_lists(spark, folder):
    """Pages as captures, against list histories drawn for the domains that occur."""
    pages = table(spark, folder, "pages")
    found = url_lists.judge(url_lists.dated_captures(pages), url_lists.sample_changes(pages))
    return found.withColumn("fetched", F.col("fetched").cast("string"))


def op5_template_removal(spark, folder):
    found = template_removal.extract(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_kd_sharding(spark, folder):
    placed = kd_sharding.kd_shards(table(spark, folder, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_mixing(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


def op7_near_dedup(spark, folder):
    return near_dedup.groups(table(spark, folder, "documents"))


def op8_quality_rules(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_rules.judged(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op9_byte_bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return byte_bpe.digests(byte_bpe.round_trip(docs, *tokenizer()))


def op10_language_mixture(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language_mixture.languages(docs).select(
        "row.doc_id", "held_out", "lang_pred", "score", "mixture"
    )


def op11_spelling_variants(spark, folder):
    return spelling_variants.variants(table(spark, folder, "documents").select("doc_id", "text"))


def op12_importance_resampling(spark, folder):
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = importance_resampling.resample(docs.select("doc_id", "text"), target)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_sanitisation(spark, folder):
    found = sanitisation.private(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans",
    )


QUERIES = {
    "op1_fixity": op1_fixity,
    "op2_adaptive_scan": op2_adaptive_scan,
    "op3_url_lists": op3_url_lists,
    "op5_template_removal": op5_template_removal,
    "op4_kd_sharding": op4_kd_sharding,
    "op6_mixing": op6_mixing,
    "op7_near_dedup": op7_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_language_mixture": op10_language_mixture,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_sanitisation": op13_sanitisation,
}
