"""Clustered storage of orders and lineitem (K1, S3): bucketed by order key, in folders by month.

``orders`` and ``lineitem`` are bucketed by the order key into the same number
of buckets, so joining them, or grouping lineitem by order, needs no exchange.
Both lie in one folder a month of their date; a date range written with
``dated`` names the months too, so the scan opens only their folders.

A bucket is read by one task. The order key is the primary key of orders and
lineitem has at most seven rows of an order, so no bucket holds a hot key; a
table whose key may be hot should be left to AQE's skew join instead.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import input_bytes
from tally.sources.tables import table_path

# table: (bucket key, date column, month column)
LAYOUT = {
    "orders": ("o_orderkey", "o_orderdate", "o_ordermonth"),
    "lineitem": ("l_orderkey", "l_shipdate", "l_shipmonth"),
}
MONTH_OF = {day: month for _, day, month in LAYOUT.values()}
BUCKET_BYTES = 1 << 30   # stored bytes of lineitem in a bucket, all months together
MOST_BUCKETS = 1 << 16   # below Spark's own limit of 100,000; beyond 64 TB buckets grow


def bucket_count(data_bytes: int, cores: int) -> int:
    """Buckets for a table of ``data_bytes``: about ``BUCKET_BYTES`` each, at least one a core, a power of two.

    Powers of two divide each other, so Spark can also join tables of different counts without an exchange.
    """
    wanted = max(cores, -(-data_bytes // BUCKET_BYTES), 1)
    return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())


def buckets_under(spark: SparkSession, root: str) -> int:
    """``bucket_count`` for the lineitem table below ``root``, from file sizes."""
    return bucket_count(input_bytes(spark, table_path(root, "lineitem")), spark.sparkContext.defaultParallelism)


def write_clustered(df: DataFrame, table: str, name: str, root: str, buckets: int) -> DataFrame:
    """Store ``df`` as the catalog table ``name``, laid out as ``LAYOUT[table]`` in a new folder below ``root``.

    The catalog gets the table when all files are there, so a crash leaves an
    unused folder and no half a table; a name that exists is refused. Rows meet
    by (bucket, month): one file each, and no task writes a bucket of all
    months. Rows without a date lie in a folder of their own, which no range
    reads. Rows without a key share a bucket and join nothing.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        raise ValueError(f"table {name} exists")
    key, day, month = LAYOUT[table]
    rows = df.withColumn(month, F.trunc(F.col(day), "month"))
    rows = rows.repartition(F.pmod(F.hash(key), F.lit(buckets)), F.col(month))
    (rows.write.format("parquet").option("path", f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
     .partitionBy(month).bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


def clustered_frames(frames: dict[str, DataFrame], prefix: str, root: str, buckets: int) -> dict[str, DataFrame]:
    """``frames`` with orders and lineitem, where they are among them, stored clustered as ``<prefix>_<table>``."""
    return {name: write_clustered(df, name, f"{prefix}_{name}", root, buckets) if name in LAYOUT else df
            for name, df in frames.items()}


def dated(df: DataFrame, column: str, start: date | Column | None = None, end: date | Column | None = None) -> DataFrame:
    """Rows of ``df`` with ``start <= column < end``; an open side is None.

    On a table with the month column of ``column`` the months that can hold
    such rows are named as well, as constants that prune folders.
    """
    month = MONTH_OF.get(column)
    months = month in df.columns
    if start is not None:
        first = start if isinstance(start, Column) else F.lit(start)
        df = df.where(F.col(column) >= first)
        if months:
            df = df.where(F.col(month) >= F.trunc(first, "month"))
    if end is not None:
        last = end if isinstance(end, Column) else F.lit(end)
        df = df.where(F.col(column) < last)
        if months:
            df = df.where(F.col(month) < last)
    return df
