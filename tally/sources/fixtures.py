"""TPC-H tables as frames, and adapters for the test tables.

``tpch_frames`` opens a real data set: every declared column must be there.
The test tables lack ``partsupp`` and several columns the queries read
(commit/receipt dates, ship mode, supplier comments, ship priority, customer
address/phone/comment); ``fixture_frames``, which only the registry and the
tests call, adds *deterministic synthetic* columns where they are missing.
Money columns are cast to DECIMAL(15,2) as the DDL declares, so sums are exact.

The same rules are written as SQL in ``tally.plans.oracle`` for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.sources.tables import MONEY, TPCH_TABLES, read_table, schema

# Ship mode by l_linenumber 1..7.
SHIPMODES = ["REG AIR", "AIR", "RAIL", "SHIP", "TRUCK", "MAIL", "FOB"]

# Synthetic supplier comments by s_suppkey % 10.
SUPPLIER_COMMENTS = {
    3: "sly Customer even Complaints sleep",
    5: "Complaints of Customer",
    7: "Customer Recommends",
    9: "no Complaints",
}
SUPPLIER_COMMENT_DEFAULT = "regular accounts"

_MONEY_COLUMNS = {
    "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    "orders": ["o_totalprice"],
    "customer": ["c_acctbal"],
    "supplier": ["s_acctbal"],
    "part": ["p_retailprice"],
    "partsupp": ["ps_supplycost"],
}


def _money(df: DataFrame, table: str) -> DataFrame:
    casts = {c: F.col(c).cast(MONEY) for c in _MONEY_COLUMNS.get(table, []) if c in df.columns}
    return df.withColumns(casts) if casts else df


def _days(n):
    return F.make_dt_interval(days=n)


def adapt_lineitem(df: DataFrame) -> DataFrame:
    add = {}
    if "l_commitdate" not in df.columns:
        add["l_commitdate"] = F.col("l_shipdate") + _days((F.col("l_partkey") % 61 - 30).cast("int"))
    if "l_receiptdate" not in df.columns:
        add["l_receiptdate"] = F.col("l_shipdate") + _days((F.col("l_suppkey") % 30 + 1).cast("int"))
    if "l_shipmode" not in df.columns:
        add["l_shipmode"] = F.element_at(F.array(*[F.lit(m) for m in SHIPMODES]), F.col("l_linenumber"))
    df = df.withColumns(add) if add else df
    return _money(df, "lineitem")


def adapt_orders(df: DataFrame) -> DataFrame:
    if "o_shippriority" not in df.columns:
        df = df.withColumn("o_shippriority", F.lit(0))
    return _money(df, "orders")


def adapt_customer(df: DataFrame) -> DataFrame:
    add = {}
    key = F.col("c_custkey").cast("string")
    for column, prefix in (("c_address", "addr "), ("c_phone", "phone "), ("c_comment", "note ")):
        if column not in df.columns:
            add[column] = F.concat(F.lit(prefix), key)
    df = df.withColumns(add) if add else df
    return _money(df, "customer")


def adapt_supplier(df: DataFrame) -> DataFrame:
    if "s_comment" not in df.columns:
        bucket = F.col("s_suppkey") % 10
        comment = F.lit(SUPPLIER_COMMENT_DEFAULT)
        for rem, text in sorted(SUPPLIER_COMMENTS.items(), reverse=True):
            comment = F.when(bucket == rem, F.lit(text)).otherwise(comment)
        df = df.withColumn("s_comment", comment)
    return _money(df, "supplier")


def derive_partsupp(lineitem: DataFrame) -> DataFrame:
    """Synthetic partsupp: every (part, supplier) pair that appears in lineitem."""
    return lineitem.select(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")).distinct()


_ADAPTERS = {
    "region": lambda df: df,
    "nation": lambda df: df,
    "customer": adapt_customer,
    "supplier": adapt_supplier,
    "part": lambda df: _money(df, "part"),
    "orders": adapt_orders,
    "lineitem": adapt_lineitem,
}


def _partsupp(spark: SparkSession, root: str) -> DataFrame:
    try:
        return _money(read_table(spark, root, "partsupp"), "partsupp")
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        return derive_partsupp(read_table(spark, root, "lineitem"))


def tpch_frames(spark: SparkSession, root: str, tables=TPCH_TABLES) -> dict[str, DataFrame]:
    """TPC-H tables under ``root`` (lazy); a missing table or declared column raises.

    Each open costs a file listing and a footer read on the driver, so callers
    name only the tables their query scans.
    """
    frames = {}
    for name in tables:
        df = read_table(spark, root, name)
        missing = [c for c in schema(name).fieldNames() if c not in df.columns]
        if missing:
            raise ValueError(f"table {name} under {root} lacks {', '.join(missing)}")
        frames[name] = _money(df, name)
    return frames


def fixture_frames(spark: SparkSession, root: str, tables=None) -> dict[str, DataFrame]:
    """The test tables under ``root`` with synthetic columns where they lack declared ones (lazy)."""
    names = tuple(tables) if tables is not None else (*_ADAPTERS, "partsupp")
    return {name: _partsupp(spark, root) if name == "partsupp" else _ADAPTERS[name](read_table(spark, root, name))
            for name in names}
