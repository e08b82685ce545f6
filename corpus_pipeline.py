"""A corpus made ready for training: toxic documents out, repeated line passages out, one of each near-duplicate group,
sources mixed by temperature, texts encoded."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkveil.llm import bpe, common, line_dedup, mixing, simhash, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; labels come from the labels table, texts from docs."""
    scored = toxicity.score_toxicity(docs, common.table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, texts without repeated passages of lines; n_chars follows the text."""
    out = line_dedup.remove_repeated_chunks(docs)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those whose runs of five words are at least 0.8 similar to those of a kept one with a smaller id, met by
    SimHash balls or bands of least hashes."""
    gone = common.saved(simhash.removed_copies(docs).select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks, once at least."""
    return mixing.realised(mixing.mix(docs)).select(*docs.columns)  # epoch and place are not columns of documents


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, as counts and digests."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_stage), ("simhash", simhash_stage), ("mixing", mixing_stage), ("byte_bpe", encoding_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents, one after another, each written and read again by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
