"""Mixing sources to target weights: tokens per source, repetition rates, hash-seeded copies.

Everything is DataFrame functions. A target is its source's share of all
words by weight, but at most ``MAX_REPEAT`` times the source's own words; what
is over is shared out by weight among the rest until nobody is above. That is
``min(cap, weight * level)`` for one ``level``, found with running sums over
the sources in the order of cap / weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.shared import WORD, free_name
from tally.operators.sequence import ordinal

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: A plan of at most so many bytes is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 16 << 20


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_plan(sized: DataFrame, source: str, size: str, weights: tuple[int, ...] = WEIGHTS,
                max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(source, source_size, target)``, one row a source; a null source is one, the last.

    Sources may be as many as hosts: places and running sums come from range
    cuts of the per-source totals, and only three numbers reach the driver.
    Runs its jobs when called. Sources of equal cap / weight go by name, null last.
    """
    totals = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size"))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    named = ordinal(totals, [], F.col("source").asc_nulls_last(), out="place").withColumns({
        "weight": F.element_at(cycle, (F.pmod("place", F.lit(len(weights))) + 1).cast("int")),
        "cap": F.col("source_size") * max_repeat})
    ratio = (F.col("cap").cast("double") / F.col("weight")).asc()
    plan = ordinal(named, [], [ratio, F.col("source").asc_nulls_last()], out="by_ratio", running=("cap", "weight"))
    every = plan.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    # The level if all sources below are at their caps and none from here on is.
    level = (F.lit(every["size"]) - F.col("before_cap")).cast("double") / (F.lit(every["weight"]) - F.col("before_weight"))
    fits = F.col("cap").cast("double") >= F.col("weight") * level
    final = plan.agg(F.max(F.when(fits, level)).alias("level")).first()["level"]
    share = F.col("weight") * F.lit(final).cast("double")
    cap = F.col("cap").cast("double")
    target = F.when(share.isNull() | (cap < share), cap).otherwise(share)
    return plan.select("source", "source_size", target.alias("target"))


def hash_unit(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the MD5 of seed and key; a null key counts as empty text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix_sources(df: DataFrame, size: str, source: str = "source", key: str = "doc_id", seed: str = "mix",
                weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``df`` with ``source_size``, ``target`` and ``copies`` (0 to ``max_repeat``) of each row.

    A row gets floor(rate) copies, rate = target / source_size, and one more if
    the hash of its key falls below the fraction. Sources without words get no
    copies. Equal keys get equal draws, so reruns agree. Existing columns of
    these names are replaced.
    """
    df = df.drop("source_size", "target", "copies")
    of = free_name(df, "plan_source")
    plan = source_plan(df, source, size, weights, max_repeat).withColumnRenamed("source", of)
    # A row is its source's bytes and some 60 for the numbers and the hash table.
    n_bytes = plan.agg(F.sum(F.coalesce(F.octet_length(of), F.lit(0)).cast("long") + 60)).first()[0]
    if (n_bytes or 0) <= BROADCAST_BYTES:
        plan = F.broadcast(plan)
    joined = df.join(plan, F.col(source).eqNullSafe(F.col(of))).drop(of)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (hash_unit(F.col(key), seed) < rate - F.floor(rate)).cast("int")
    return joined.withColumn("copies", (F.floor(rate) + extra).cast("int"))


def emit_copies(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as ``copies`` says; the column itself goes."""
    return mixed.where(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(copies)
