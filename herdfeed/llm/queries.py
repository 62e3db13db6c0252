"""Registered ``opN_<name>`` queries: each applies one operator, with its production
parameters, to its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, oracle, rule_ensemble, toxicity, url_filter
from .align import align_documents
from .bpe import decode_ids, encode_texts
from .chat import format_conversations, read_back
from .common import id_remainder, read_table, shared_path, small_batches
from .decontam import contamination
from .packing import pack_documents
from .ngram_join import ngram_jaccard_join
from .quality_rules import quality_rules
from .turn_repair import repair_report
from .url_filter import Rules, filter_urls
from .tokenbin import read_token_files, write_token_files


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_token_files(spark, path)


#: The query contract's rules.
URL_RULES = Rules((("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return filter_urls(pages, URL_RULES, classifier=url_filter.train(pages, URL_RULES, read_table(spark, sf_dir, "documents")))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.train(docs, ~held_out)
    return langid.predict(docs, model).withColumn("held_out", held_out)


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 5) == 0
    model = rule_ensemble.train(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return rule_ensemble.score(docs, model).withColumn("held_out", held_out)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(read_table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.union(extra)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).withColumn("held_out", held_out)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def damaged(rows: DataFrame) -> DataFrame:
    """The query contract's damage: by a checksum of id and turn, a row is dropped (``live`` is
    false), emptied, robbed of its stops, repeated, or given to the user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"), text.alias("text"),
        (kind != 0).alias("live"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(read_table(spark, sf_dir, "conversations")), live=F.col("live"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return decode_ids(encoded, tokenizer_path()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def _job(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _job(f) for name, f in globals().items() if name.startswith("op") and callable(f)}


ORACLE = {
    "op6_ngram_jaccard_join": oracle.OP6,
    "op7_chat_format": oracle.OP7,
    "op8_quality_rules": oracle.OP8,
    "op10_decontamination": oracle.OP10,
    "op12_turn_repair": oracle.OP12,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
