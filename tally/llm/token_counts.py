"""Token counts with a digest cache.

The cache is a Parquet table ``tokenizer_digest / content_digest, n_tokens``.
Documents are joined to it by the digest of their normalised text and of the
tokenizer file; only distinct texts that it lacks are encoded, and their counts
are appended. White space runs count as one blank in the normalised text: the
word-end tokenizers read here drop white space, so counts do not change.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.bpe import share_tokenizer, shared_codec
from tally.llm.exact_dedup import flag_members, flag_repeated
from tally.llm.shared import BLANK, free_name, written

CACHE_SCHEMA = T.StructType([
    T.StructField("content_digest", T.BinaryType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("tokenizer_digest", T.StringType()),
])


def content_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of ASCII white space as one blank, none at the ends."""
    one_blank = F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " ")
    return F.unhex(F.sha2(F.trim(one_blank), 256))


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file: its version."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """``(content_digest, n_tokens)`` stored for the tokenizer; None if nothing was ever stored.

    A digest that two jobs stored at once counts once.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer_digest") == version)
    return stored.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counted(texts: DataFrame, tokenizer: str) -> DataFrame:
    """``(content_digest, n_tokens)`` of ``(content_digest, text)`` rows, by encoding each."""
    shared = share_tokenizer(texts.sparkSession, tokenizer)

    @F.arrow_udf("long")
    def tokens(column: pa.Array) -> pa.Array:
        codec = shared_codec(shared)
        return pa.array([len(codec.encode(x.as_py() or "")) // 4 for x in column], pa.int64())

    return texts.select("content_digest", tokens(F.col("text")).alias("n_tokens"))


def _digests(docs: DataFrame, text: str) -> DataFrame:
    """``content_digest, text`` of each row."""
    return docs.select(content_digest(F.col(text)).alias("content_digest"), F.col(text).alias("text"))


def fill_cache(docs: DataFrame, tokenizer: str, cache: str, text: str = "text", digests: DataFrame | None = None) -> None:
    """Encode the distinct texts of ``docs`` that the cache lacks and append their counts.

    ``digests``: the written ``content_digest`` of every row, if the caller has
    them; what is missing and what may occur twice is found on them alone, so
    the texts are read once more, to be encoded. Bloom filters of them tell
    which texts have to shuffle: those that may be missing where the cache has
    some, and those whose digest may occur twice; all others are encoded where
    they are read.
    """
    version = tokenizer_digest(tokenizer)
    if digests is None:
        digests = written(_digests(docs, text).select("content_digest"), "digests")
    missing, texts = digests, _digests(docs, text)
    stored = read_cache(docs.sparkSession, cache, version)
    if stored is not None:
        missing = written(digests.join(stored.select("content_digest"), "content_digest", "left_anti"), "missing")
        asked = flag_members(texts, "content_digest", missing, "content_digest", "maybe_missing").where("maybe_missing").drop("maybe_missing")
        texts = asked.join(missing.distinct(), "content_digest", "left_semi")
    flagged = flag_repeated(texts, "content_digest", "maybe_repeated", among=missing)
    # One text of each digest: per scan task first, then over the tasks.
    repeated = flagged.where("maybe_repeated").groupBy("content_digest").agg(F.first("text").alias("text"))
    alone = flagged.where("not maybe_repeated").select("content_digest", "text")
    counted = _counted(alone, tokenizer).unionByName(_counted(repeated, tokenizer))
    (counted.withColumn("tokenizer_digest", F.lit(version))
     .write.partitionBy("tokenizer_digest").mode("append").parquet(cache))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` without its text, with ``out``, the number of tokens of the whole text (null: 0), through the cache.

    Repeated rows share one cache entry; all columns but the text pass
    unchanged (its rows would cross the network with every long text), an
    existing ``out`` is replaced.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    digest, own, count = free_name(docs, "content_of"), free_name(docs, "stored_digest"), free_name(docs, "stored_tokens")
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), out.lower())]
    keyed = written(docs.select(*[F.col(f"`{c}`") for c in rest], content_digest(F.col(text)).alias(digest)), "keyed")
    fill_cache(docs, tokenizer, cache, text, keyed.select(F.col(digest).alias("content_digest")))
    # The cache may hold a digest twice if two jobs ran at once: one entry of each. Its bytes are
    # grouped and their text is joined, so that AQE may split the partition of a much repeated text.
    stored = read_cache(spark, cache, version).select(F.hex("content_digest").alias(own), F.col("n_tokens").alias(count))
    joined = keyed.withColumn(digest, F.hex(digest)).join(stored, F.col(digest) == F.col(own))
    return joined.withColumnRenamed(count, out).drop(digest, own)
