"""One registered query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.decontaminate import contained_items
from sluice.llm.line_dedup import deduplicated
from sluice.llm.packing import pack
from sluice.llm.phrase_dedup import without_repeats
from sluice.llm.piece_spans import encoded
from sluice.llm.preference import pairs_by_order
from sluice.llm.prefix_forest import nearest
from sluice.llm.prefix_trie import conversation_trie
from sluice.llm.scratch import new_path
from sluice.llm.simhash import simhash_components
from sluice.llm.spelling import spelling_groups
from sluice.llm.token_counts import token_counts
from sluice.llm.toxicity import judged
from sluice.llm.url_filter import judge_urls

#: Host, path and verdict of the url rules.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against one that leaves it at its middle answer; spans as ``start:length``, by spaces."""
    found = pairs_by_order(_table(spark, sf_dir, "conversations"))
    spans = [
        F.array_join(F.transform(name, lambda s: F.concat(s["start"], F.lit(":"), s["length"])), " ").alias(name)
        for name in ("chosen_spans", "rejected_spans")
    ]
    return found.select("pair_id", "prompt_turns", "prompt", "chosen", "rejected", *spans)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of its own for each call, so that every distinct text of the table is encoded."""
    return token_counts(
        _table(spark, sf_dir, "documents"), new_path(spark, "token-cache"),
        public_tokenizers.path("byte_bpe_50k.json"),
    )


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op7_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), short_items=True)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicated(_table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", kept.alias("kept_sha256"))


def op11_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encoded(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_preference": op2_preference,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_prefix_forest": op5_prefix_forest,
    "op6_simhash": op6_simhash,
    "op7_phrase_dedup": op7_phrase_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_piece_spans": op11_piece_spans,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}
