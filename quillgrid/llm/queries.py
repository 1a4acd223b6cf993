"""The opN queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.llm import language_id, oracles, packing, quality_rules, secret_scan, sentencepiece_codec, simhash, spotsigs, substring_dedup, suffix_dedup, url_filter

URL_RULES = [url_filter.UrlRule.parse(a, r) for a, r in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))]


#: Folder of the public tokenizers; None: that of the installed package.
TOKENIZERS: str | None = None


def vocabulary(name: str) -> str:
    """Path of a tokenizer file."""
    if TOKENIZERS is not None:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_documents(documents(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest_documents(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def held_out() -> Column:
    """crc32 of the id as text, modulo 4, is 2; a row without an id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs, ~held_out())
    out = language_id.predict(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def _is(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan_secrets(documents(spark, sf_dir))
    kinds = [k for k in secret_scan.KINDS if k != "literal"]
    counts = [F.size(F.filter(F.col("spans")["kind"], _is(k))).cast("long").alias(f"n_{k}") for k in kinds]
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return out.select("doc_id", *counts, F.sha2(written(F.filter("spans", lambda s: s["kind"] != "literal")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_spotsigs": op2_spotsigs,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_language_id": op8_language_id,
    "op9_simhash": op9_simhash,
    "op10_secret_scan": op10_secret_scan,
}

#: The others need BPE, learned weights, XXH64 or a lexer; tests hold them against brute force.
ORACLE_SQL = {
    "op1_url_filter": oracles.url_sql(URL_RULES),
    "op4_substring_dedup": oracles.SUBSTRING_SQL,
    "op5_quality_rules": oracles.quality_sql(),
    "op7_suffix_dedup": oracles.SUFFIX_SQL,
}
