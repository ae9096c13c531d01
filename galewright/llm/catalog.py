"""The registered queries of this subpackage: thin calls of its operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.llm import embedding_dedup, language_id, license_scan, line_rules, ngram_lm, packing, piece_codec, prefix_trie, quality, simhash, spelling, substring_dedup, token_files
from galewright.llm.frames import fresh_path, remainder, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SEQUENCE = 2048

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = remainder(F.col("doc_id"), 3)
    found = language_id.identify(docs, language_id.fit(docs.where(part != 1)))
    return found.select("doc_id", (part == 1).alias("held_out"), "lang_pred", "score", "rejected")


@_query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.save(token_files.token_files(table(spark, sf_dir, "documents"), BYTE_BPE), path)
    return token_files.read_documents(token_files.load(spark, path))


@_query
def op3_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@_query
def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge_lines(table(spark, sf_dir, "documents"))


@_query
def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piece_codec.transcode(table(spark, sf_dir, "documents"), PIECE_BPE)
    n_ids = (F.length("ids") / 4).cast("long").alias("n_ids")
    return found.select("doc_id", n_ids, F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"))


@_query
def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


_SQL["op7_license_scan"] = license_scan.scan_sql()


@_query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, SEQUENCE)


@_query
def op9_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 7) == 2
    tuned = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(8)) == 0
    role = F.when(held_out, ngram_lm.SCORE).when(tuned, ngram_lm.TUNE).otherwise(ngram_lm.FIT)
    found = ngram_lm.score(docs, role, ngram_lm.ModelSettings(order=3))
    kept = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return found.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), *kept)


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    part = remainder(F.col("doc_id"), 3)
    found = quality.rate(docs, quality.fit(docs, labels.where(part != 1)))
    return found.select("doc_id", (part == 1).alias("held_out"), "score", "predicted")


@_query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations take their first 0 to 5 turns from the first of their hundred, so that prefixes are shared."""
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    conv_id = F.col("conv_id")
    taken = F.crc32(conv_id.cast("string").cast("binary")) % 6
    return prefix_trie.prefix_trie(prefix_trie.with_borrowed_starts(turns, conv_id - conv_id % 100, taken))


_SQL["op12_prefix_trie"] = prefix_trie.trie_sql()


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.counted_words(table(spark, sf_dir, "documents")))


_SQL["op13_spelling_variants"] = spelling.groups_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
