"""Order-dependent primitives that stay parallel inside a hot group.

A plain ``Window.partitionBy(workflow)`` sends every row of a workflow to
one task. Here rows are range-partitioned by ``(group, order, ties)``, so a
group is cut by the data wherever its rows are many - whatever the unit or
the spread of the order key - and numbered inside its partition; only one
summary row per (group, partition) is windowed.

* ``ordinal`` - dense 0-based position in the group (replaces ``row_number``).
* ``ordinal(..., previous=, following=)`` - also the values of the row
  before / after (replaces ``lag`` / ``lead``): from the same partition, or,
  for the rows at its edges, from the neighbouring partition's summary.
* ``ordinal(..., running=)`` - also the sums of columns over the rows before.
* ``dense_index`` - dense rank of the distinct values of a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.session import land


def ordinal(
    df: DataFrame,
    group_cols: list[str],
    order_cols,
    out: str = "pos",
    tie_cols: tuple = (),
    previous: tuple = (),
    following: tuple = (),
    running: tuple = (),
    prev_prefix: str = "prev_",
    next_prefix: str = "next_",
    before_prefix: str = "before_",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out``: 0-based dense position of each row in its group by ``(order_cols, *tie_cols)``.

    ``order_cols`` is one column (name or expression) or several; ties must
    be broken by ``tie_cols`` for a deterministic result. ``previous`` /
    ``following`` name columns whose values from the row before / after are
    added as ``prev_prefix + c`` / ``next_prefix + c`` (NULL at the group's ends).
    ``running`` names columns whose sums over all rows before are added as
    ``before_prefix + c`` (0 for the first row; NULL counts as 0).

    Runs one job when called: the range-partitioned rows are landed with a
    reliable checkpoint, so that numbering and counts see the same cuts and
    the input is evaluated for them once. ``num_partitions`` defaults to the
    session's shuffle partitions, coalesced by AQE.
    """
    order = [order_cols] if isinstance(order_cols, (str, F.Column)) else list(order_cols)
    previous, following, running = tuple(previous), tuple(following), tuple(running)
    keys = [F.col(c) if isinstance(c, str) else c for c in (*group_cols, *order, *tie_cols)]
    dealt = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    cut = land(dealt.sortWithinPartitions(*keys).withColumns({
        "_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))

    run = [*group_cols, "_part"]
    summary = cut.groupBy(*run).agg(
        F.min("_row").alias("_first_row"), F.count(F.lit(1)).alias("_n"),
        *([F.max_by(F.struct(*previous), "_row").alias("_last")] if previous else []),
        *([F.min_by(F.struct(*following), "_row").alias("_first")] if following else []),
        *[F.sum(c).alias(f"_sum_{c}") for c in running])
    # One row per partition that a group touches (per partition, without groups).
    by_part = Window.partitionBy(*group_cols).orderBy("_part") if group_cols else Window.orderBy("_part")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        *run, "_first_row", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
        *([F.lag("_last").over(by_part).alias("_prev_part")] if previous else []),
        *([F.lead("_first").over(by_part).alias("_next_part")] if following else []),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_off_{c}") for c in running])

    inside = Window.partitionBy(*run).orderBy("_row")
    rows = cut.withColumns({**{f"_lag_{c}": F.lag(c).over(inside) for c in previous},
                            **{f"_lead_{c}": F.lead(c).over(inside) for c in following},
                            **{f"_until_{c}": F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, -1)) for c in running}})
    at = F.col("_row") - F.col("_first_row")
    first, last = at == 0, at == F.col("_n") - 1
    added = {
        out: (F.col("_off") + at).cast("long"),
        **{prev_prefix + c: F.when(first, F.col("_prev_part")[c]).otherwise(F.col(f"_lag_{c}")) for c in previous},
        **{next_prefix + c: F.when(last, F.col("_next_part")[c]).otherwise(F.col(f"_lead_{c}")) for c in following},
        **{before_prefix + c: F.col(f"_off_{c}") + F.coalesce(F.col(f"_until_{c}"), F.lit(0)) for c in running},
    }
    return rows.join(offsets, run).withColumns(added).drop(
        "_part", "_row", "_first_row", "_n", "_off", *(["_prev_part"] if previous else []),
        *(["_next_part"] if following else []), *[f"_lag_{c}" for c in previous], *[f"_lead_{c}" for c in following],
        *[f"_{kind}_{c}" for kind in ("off", "until") for c in running])


def dense_index(
    df: DataFrame,
    group_cols: list[str],
    value_col: str,
    order_exprs: list,
    out: str = "worker_index",
) -> DataFrame:
    """0-based dense rank of ``value_col`` within the group; NULL value -> -1.

    The distinct ``(group, value)`` pairs are numbered by ``ordinal`` - a hot
    group may have as many values as rows - and joined back; AQE broadcasts
    that table when its measured size allows and otherwise splits skewed keys.
    ``order_exprs`` must tell any two values of a group apart.
    """
    distinct = df.select(*group_cols, value_col).where(F.col(value_col).isNotNull()).distinct()
    ranks = ordinal(distinct, group_cols, order_exprs, out=out).withColumn(out, F.col(out).cast("int"))
    return df.join(ranks, [*group_cols, value_col], "left").withColumn(out, F.coalesce(F.col(out), F.lit(-1)))
