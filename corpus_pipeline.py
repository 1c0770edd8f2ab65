"""The training-corpus pipeline: language, exact copies, near copies, source mix, tokens.

Each stage takes ``(spark, docs, sf_dir)``, works on everything that its
predecessor kept, and its result is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.bpe import round_trip
from tally.llm.exact_dedup import exact_dedup, with_digest
from tally.llm.language_id import accepted, fit_language_filters, identify_language
from tally.llm.mixing import emit_copies, mix_sources, n_words
from tally.llm.setsketch import near_duplicates
from tally.llm.shared import fold, written

SHINGLE, PERCENT = 5, 80
TOKENIZER = "word_bpe_49k.json"


def packed(docs: DataFrame) -> DataFrame:
    """``row`` (every column of ``docs`` as it is), and ``doc_id, text, lang, source``: extra columns clash with nothing."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, "doc_id", "text", "lang", "source")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without an identifiable language (null texts, no letters, no known n-grams)."""
    filters = fit_language_filters(docs, train=fold(F.col("doc_id"), 3) != 1)
    named = identify_language(packed(docs).select("row", "text"), filters, out="language")
    return named.where(accepted(F.col("language"))).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space, keep the longest, then the one with the least id."""
    digested = with_digest(packed(docs)).select("row", "doc_id", "text_sha256", "n_code_points")
    return exact_dedup(digested, digest="text_sha256", length="n_code_points", key="doc_id").where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at similarity 0.8 or more, keep the one with the least id."""
    found = near_duplicates(docs, shingle=SHINGLE, percent=PERCENT)
    dropped = found.where("id <> component_id").select("id").distinct()
    kept = packed(docs).select("row", "doc_id").join(dropped, F.col("doc_id") == F.col("id"), "left_anti")
    return kept.select("row.*")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that the sources come near their target shares of words."""
    sized = packed(docs).select("row", "doc_id", "source", n_words(F.col("text")).alias("size"))
    return emit_copies(mix_sources(sized, size="size")).select("row.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids`` (little-endian 32-bit) of each text, and the digest of what they decode to."""
    coded = round_trip(docs, public_tokenizers.path(TOKENIZER), out="coded")
    return coded.select(
        "doc_id", "source", (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.col("coded.ids").alias("ids"), F.sha2(F.col("coded.decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", keep_known_language),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_to_targets),
    ("BPE encoding", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each over the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{i}")
    return docs


#: Language ID, near-dedup and BPE are beyond SQL: tests/llm holds the pipeline against brute force.
ORACLE_SQL = None
