"""A cleaned, tokenised corpus from `documents`: each stage's rows are written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.cotraining import co_train
from ledgerline.llm.latent import contaminated
from ledgerline.llm.neardup import near_duplicates
from ledgerline.llm.pieces import decode_pieces, encode_sampled
from ledgerline.llm.repeats import passing
from ledgerline.llm.store import stored

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; the labels train it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return co_train(docs, labels).scored(docs).where("kept").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word and repetition rules."""
    return passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, and one row of it if it is repeated. Rows with a null
    doc_id stay."""
    kept = stored(near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    one = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = stored(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled piece ids of each document, with a digest and whether they decode to the text. The ids are stored between the
    two passes: in one pass each task would need two Python workers, which live on with their tables."""
    decoded = decode_pieces(stored(encode_sampled(docs, PIECES), "encoded"), PIECES, original="text")
    return decoded.select("doc_id", "ids", "n_pieces", "ids_crc32", F.length("decoded").alias("n_chars"), "lossless")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]
#: SQL cannot express the trained, sketched and sampled stages; tests hold the pipeline against its parts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
