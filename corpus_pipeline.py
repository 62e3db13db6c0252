"""Corpus pipeline over ``documents``: toxicity, language ID, n-gram Jaccard join, benchmark
decontamination, packing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``. Every stage learns from and works on all its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdfeed.llm import langid, toxicity
from herdfeed.llm.common import free_name, id_remainder, read_table, small_batches, written
from herdfeed.llm.decontam import decontaminate
from herdfeed.llm.ngram_join import ngram_jaccard_join
from herdfeed.llm.packing import pack_documents
from herdfeed.llm.queries import tokenizer_path

#: A text is rejected if its language is undetermined or told with a lower score.
MIN_LANGUAGE_SCORE = 0.3
#: Rows and bytes of an Arrow batch: workers and executors keep what each stage once took, so the
#: stages of one job get by with less than a query alone.
BATCH = (300, 1 << 20)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier calls toxic. NULL and empty texts have the base
    rate and stay unless most labelled texts are toxic; repeated rows are judged alike; other
    columns pass through. Without labels of both classes nothing goes."""
    small_batches(spark, *BATCH)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), id_remainder("doc_id", 3) != 1)
    return toxicity.keep_clean(docs, model)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language can't be told: NULL texts, texts without a letter, and
    those told with a lower score than ``MIN_LANGUAGE_SCORE``. Repeated rows are judged alike; other
    columns pass through. Without any known language every document goes."""
    small_batches(spark, *BATCH)
    return langid.keep_known(docs, langid.train(docs, id_remainder("doc_id", 4) != 2), MIN_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that with the smallest ``doc_id`` (rows without one come last),
    ties by the row's place. Every row is compared, whether its id is missing, repeated or not;
    NULL and empty texts link with nothing and stay."""
    small_batches(spark, *BATCH)
    key = free_name(docs, "row")
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows")
    places = ngram_jaccard_join(keyed, id_col=key).select(F.col("doc_id").alias(key), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", key)).alias("first")
    kept = keyed.select(key, "doc_id").join(places, key).groupBy("component_id").agg(first).select(F.col(f"first.{key}").alias(key))
    return keyed.join(kept, key, "left_semi").select(docs.columns)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages of test items; ``n_chars`` follows the text. A text that is nothing else
    goes; NULL and empty texts stay; repeated rows are cut alike; other columns pass through."""
    small_batches(spark, *BATCH)
    clean = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens. NULL and empty texts are their end id alone; repeated
    rows are packed each; an empty table gives no pieces."""
    small_batches(spark, *BATCH)
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", cut_benchmark),
    ("packing", pack),
]

#: The classifiers and the tokenizer are not expressible in SQL; tests/llm holds the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "pipeline")
    return docs
