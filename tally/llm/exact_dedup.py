"""Exact duplicates: two Bloom-filter passes, so that only possibly repeated rows shuffle.

Pass 1 counts how many rows hit each slot of a hash table of bits and keeps
the slots hit twice or more as a Bloom filter of bitmaps. Pass 2 looks each
row up: a row with a slot that was hit once is certainly unique and passes
straight through; the others are grouped by SHA-256. Everything is DataFrame
functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.shared import BLANK, free_name, written

BITS_PER_ROW = 16
HASHES = 2
#: Bound of the broadcast filter (2**30 bits are 128 MB). A table with more than
#: MAX_BITS / BITS_PER_ROW rows gets more false positives, never another result.
MAX_BITS = 1 << 30


def normalised(text: Column) -> Column:
    """The text without ``[\\x20\\x09-\\x0D]``; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def _slot(digest: Column, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(k), digest), F.lit(bits)) + 1


def _bitmaps(values: DataFrame, value: str, bits: int, least: int) -> DataFrame:
    """``(bucket, bitmap)`` of the slots that at least ``least`` rows hit."""
    slots = values.select(F.explode(F.array(*[_slot(F.col(value), k, bits) for k in range(HASHES)])).alias("slot"))
    hit = slots.groupBy("slot").agg(F.count("*").alias("rows")).where(F.col("rows") >= least)
    return hit.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))


def filter_bits(rows: int) -> int:
    """Size of the filter for so many rows: a power of two of at most ``MAX_BITS``."""
    return min(MAX_BITS, 1 << max(15, (rows * BITS_PER_ROW - 1).bit_length()))


def _look_up(df: DataFrame, value: str, bitmaps: DataFrame, bits: int, out: str) -> DataFrame:
    """``df`` with boolean ``out``: all slots of ``value`` are set. The bitmaps, of at most ``MAX_BITS`` bits, are broadcast."""
    tests = []
    for k in range(HASHES):
        bucket, bitmap = free_name(df, f"bucket_{k}"), free_name(df, f"bitmap_{k}")
        slot = _slot(F.col(value), k, bits)
        own = bitmaps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap))
        df = df.withColumn(f"{bucket}_of", F.bitmap_bucket_number(slot))
        df = df.join(F.broadcast(own), F.col(f"{bucket}_of") == F.col(bucket), "left")
        place = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        bit = F.coalesce(byte.cast("int"), F.lit(0)).bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0
        tests.append((bucket, bitmap, bit))
    flagged = df.withColumn(out, reduce(Column.__and__, [bit for *_, bit in tests]))
    return flagged.drop(*[c for bucket, bitmap, _ in tests for c in (bucket, bitmap, f"{bucket}_of")])


def flag_repeated(df: DataFrame, digest: str, out: str, bits: int | None = None, among: DataFrame | None = None) -> DataFrame:
    """``df`` with boolean ``out``: false only if no other row (of ``among``, if that holds them written) has the same ``digest``."""
    among = df if among is None else among
    bits = bits or filter_bits(among.select(digest).count())
    return _look_up(df, digest, _bitmaps(among, digest, bits, least=2), bits, out)


def flag_members(df: DataFrame, value: str, members: DataFrame, member: str, out: str) -> DataFrame:
    """``df`` with boolean ``out``: false only if ``value`` isn't among ``members``.

    Lets an exact join after it shuffle little more than the rows that match.
    """
    bits = filter_bits(members.count())
    return _look_up(df, value, _bitmaps(members, member, bits, least=1), bits, out)


def exact_dedup(df: DataFrame, digest: str, length: str, key: str, bits: int | None = None) -> DataFrame:
    """Group rows by ``digest`` and choose the longest row, then the smallest ``key``, of each.

    Adds ``keep_id`` (key of the row that stays), ``group_size`` and ``kept``.
    A null key sorts last. Rows that repeat one key within a group are one
    document: exactly one of them is kept. All other columns pass unchanged;
    existing ones of these three names are replaced.

    ``df`` is written first, so that its digests are computed once: both passes
    then read the digests, and only the last reads all columns.
    """
    df = written(df.drop("keep_id", "group_size", "kept"), "digested")
    flag = free_name(df, "maybe_repeated")
    flagged = flag_repeated(df, digest, flag, bits)
    alone = flagged.where(~F.col(flag)).drop(flag).withColumns(
        {"keep_id": F.col(key), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})

    several = flagged.where(F.col(flag)).drop(flag)
    order = F.struct((-F.col(length)).alias("shorter"), F.col(key).isNull().alias("no_key"), F.col(key).alias("key"))
    group = free_name(df, "group_digest")
    # Grouped by the bytes of the digest, joined by its text: so the join deals
    # both sides anew and AQE may split the partition of a hot digest.
    groups = (several.groupBy(F.unhex(F.col(digest)).alias("digest_bytes"))
              .agg(F.count("*").alias("group_size"), F.min(order).alias("first"))
              .select(F.lower(F.hex("digest_bytes")).alias(group), F.col("first.key").alias("keep_id"), "group_size"))
    copy = free_name(df, "copy_no")
    # By the digest reversed: dealt by digest alone, the join's partitions would do for this
    # window, and a hot digest would stay in one task.
    same_key = Window.partitionBy(F.reverse(F.col(digest)), key).orderBy(F.col(length).desc())
    chosen = (several.join(groups, F.col(digest) == F.col(group)).drop(group)
              .withColumn(copy, F.row_number().over(same_key))
              .withColumn("kept", F.col(key).eqNullSafe(F.col("keep_id")) & (F.col(copy) == 1)).drop(copy))
    return alone.unionByName(chosen.select(alone.columns))


def with_digest(df: DataFrame, text: str = "text", digest: str = "text_sha256", length: str = "n_code_points") -> DataFrame:
    """``df`` with the SHA-256 of the normalised text and the code points of the original one."""
    return df.withColumns({digest: F.sha2(normalised(F.col(text)), 256),
                           length: F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long")})
