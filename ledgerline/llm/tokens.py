"""Token counts with a digest cache."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.arrays import mapped
from ledgerline.llm.encoder import ENCODE_BYTES, digest_of, encoder
from ledgerline.llm.store import stored

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


class TokenCache:
    """Counts by content digest and tokenizer digest, in Parquet below `folder`, one partition a tokenizer version.

    Runs append; a digest that two concurrent runs both add is stored twice with the same count, which readers merge.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.append(spark.createDataFrame([], CACHE_SCHEMA))

    def append(self, counts: DataFrame) -> None:
        counts.write.mode("append").partitionBy("tokenizer").parquet(self.folder)

    def counts(self, tokenizer: str) -> DataFrame:
        known = self.spark.read.schema(CACHE_SCHEMA).parquet(self.folder)
        return known.where(F.col("tokenizer") == tokenizer).select("digest", "n_tokens")


def content(text: Column) -> Column:
    """The normal form whose digest is cached: a null is the empty text; any other change could change a count."""
    return F.coalesce(text.cast("string"), F.lit(""))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: TokenCache, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, n_bytes, n_tokens) per input row, in no order.

    Nulls in the text count as empty (0 bytes, 0 tokens); a null or repeated key is a row like any other; equal texts are
    encoded once; whole texts are encoded, of any length. Other columns of any name are ignored. An empty table gives none.
    The text crosses the network once, for the distinct texts that the cache misses.
    """
    version = digest_of(tokenizer_path)
    keyed = docs.select(F.col(key).alias("key"), content(F.col(text)).alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256))
    )
    light = stored(keyed.select("key", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    one = light.groupBy("digest").agg(F.min("key").alias("rep"))
    missing = one.join(cache.counts(version), "digest", "left_anti").withColumnRenamed("digest", "miss")
    texts = keyed.join(missing, F.col("digest").eqNullSafe(F.col("miss")) & F.col("key").eqNullSafe(F.col("rep")), "left_semi")

    def counted(part):
        _, bounds = encoder(tokenizer_path).ids(part.column("text"))
        return {"digest": part.column("digest"), "n_tokens": np.diff(bounds)}

    fresh = mapped(texts, ["digest", "text"], counted, "digest binary, n_tokens long", limit=ENCODE_BYTES)
    fresh = fresh.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # rows that repeat key and text
    cache.append(fresh.withColumn("tokenizer", F.lit(version)))
    known = cache.counts(version).join(one, "digest", "left_semi")
    known = stored(known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return light.join(known, "digest").select(F.col("key").alias(key), "n_bytes", "n_tokens")
