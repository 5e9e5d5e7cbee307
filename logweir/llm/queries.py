"""One query per corpus operator, over the whole of its table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import bags, bitplanes, chunks, importance, licenses, lines, mixing, oracle, quality_rules, secrets, sentencepiece, simhash, tokens, warc
from logweir.llm.common import stored, table


TOKENIZERS = "/opt/tokenizers"
PER_GRAM = 50.0  # the classifier's weights by mean log ratio, so that long documents are not all kept or all dropped


def op1_sentencepiece(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    return sentencepiece.encoded(table(spark, sf_dir, "documents"), f"{tokenizers}/piece_bpe_32k.model")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), per_gram=PER_GRAM)
    return found.select(F.col("key").alias("doc_id"), "log_weight", "sample_key", "kept")


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, audited against a replica in which about one record in 85 is changed, cut or lost."""
    pages = table(spark, sf_dir, "pages")
    body, damage = F.coalesce("html", F.lit("")), F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2)
    broken = F.when(damage == "00", F.concat(F.lit("~"), F.substring(body, 2, (1 << 31) - 1))).when(
        damage == "01", F.left(body, F.floor(F.length(body) / 2).cast("int"))).otherwise(body)
    whole = warc.record(F.col("url"), F.col("page_id"), body)
    copy = F.when(F.coalesce(damage, F.lit("")) != "02", warc.record(F.col("url"), F.col("page_id"), broken))
    records = pages.select("page_id", F.sha2(whole, 256).alias("digest"), F.octet_length(whole).alias("length"), F.sha2(copy, 256).alias("other"))
    laid = stored(warc.laid_out(records, "page_id", "length"), "warc-records")
    second = laid.where("other IS NOT NULL").select("file", "offset", "length", F.col("other").alias("digest"))
    found = warc.audit(laid.select("file", "offset", "length", "digest"), second)
    status = F.when(F.col("second_digest").isNull(), "missing").when(F.col("first_digest").isNull(), "extra").otherwise("changed")
    return found.join(laid.select("file", "offset", "page_id"), ["file", "offset"]).select(
        "page_id", "file", "offset", "length", status.alias("status"), "first_digest", "second_digest")


def op5_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.edited_and_next(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, total, deleted = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", F.col(total).alias("n_lines"), F.col(deleted).alias("n_deleted"), "text")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_section_tokens(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    return tokens.section_tokens(table(spark, sf_dir, "documents"), f"{tokenizers}/byte_bpe_50k.tiktoken")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))

    def count(kind: str):
        number = secrets.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("key").alias("doc_id"), *map(count, ("assign", "access", "hex")),
                        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
                        secrets.listed(F.concat("base", "linked")).alias("spans"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bags.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("own").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.clusters(table(spark, sf_dir, "embeddings"))[0].withColumnRenamed("key", "vec_id")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score is the largest share of a template's words that a span covers; a base phrase is covered whole."""
    found = licenses.licences(table(spark, sf_dir, "documents"))
    base, spans = F.col("base.label"), F.col("spans.label")
    share = F.array_max(F.transform("spans", lambda s: s["covered"] / s["size"]))

    def listed(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        F.col("key").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, spans)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(share, F.lit(0.0))).alias("score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_importance_resampling": op3_importance_resampling,
    "op4_warc_fixity": op4_warc_fixity,
    "op5_chunk_fingerprints": op5_chunk_fingerprints,
    "op6_line_dedup": op6_line_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_section_tokens": op9_section_tokens,
    "op10_secret_scan": op10_secret_scan,
    "op11_ranked_search": op11_ranked_search,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_license_scan": op13_license_scan,
}
ORACLE: dict[str, str] = {
    "op2_quality_rules": oracle.OP2,
    "op4_warc_fixity": oracle.OP4,
    "op6_line_dedup": oracle.OP6,
    "op7_source_mixing": oracle.OP7,
    "op10_secret_scan": oracle.OP10,
    "op11_ranked_search": oracle.OP11,
    "op12_centroid_clusters": oracle.OP12,
}
