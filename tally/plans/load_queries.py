"""Registered load queries (S3-S5) and queries over clustered storage (K1), and the load queries' DuckDB SQL."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.plans import tpch
from tally.session import ensure_checkpoint_dir
from tally.sources import clustered, tables
from tally.sources.fixtures import fixture_frames


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_frames(spark, sf_dir, ("customer",))["customer"].select(tables.schema("customer").fieldNames())


def s3_tbl_rejects(spark, sf_dir):
    """All customers as ``|`` text, some lines spoiled in three ways, ingested: what was loaded and what was put aside."""
    folder = _folder(spark, "tbl")
    customers = _customers(spark, sf_dir)
    left = F.col("c_custkey") % 97
    spoiled = {"c_acctbal": F.when(left == 5, "n/a"), "c_name": F.when(left == 7, "")}
    fields = [F.coalesce(spoiled.get(c, F.lit(None).cast("string")), F.col(c).cast("string")) for c in customers.columns]
    line = F.concat(F.concat_ws("|", *fields), F.lit("|"))
    customers.select(F.when(left == 6, F.regexp_replace(line, r"\|[^|]*\|$", "")).otherwise(line).alias("value")).write.text(f"{folder}/customer.tbl")
    tables.ingest_tbl(spark, f"{folder}/customer.tbl", folder, "customer", max_rejects=customers.count())
    loaded = spark.read.parquet(tables.table_path(folder, "customer")).select(
        F.col("c_custkey").cast("long").alias("key"), F.lit("loaded").alias("outcome"), F.col("c_acctbal").cast("double").alias("balance"))
    aside = spark.read.parquet(tables.table_path(folder, "customer-rejects")).select(
        F.split_part("line", F.lit("|"), F.lit(1)).cast("long").alias("key"), F.col("reason").alias("outcome"), F.lit(None).cast("double").alias("balance"))
    return loaded.unionByName(aside)


def s5_repeated_load(spark, sf_dir):
    """All customers in two loads, the first done twice: each row once, with the load that brought it."""
    folder, customers = _folder(spark, "loads"), _customers(spark, sf_dir)
    first = F.col("c_nationkey") < 13
    for load_id, rows in (("first", customers.where(first)), ("second", customers.where(~first)), ("first", customers.where(first))):
        tables.checked_load(rows, folder, "customer", load_id, key=["c_custkey"])
    return spark.read.parquet(tables.table_path(folder, "customer")).select(
        F.col("c_custkey").cast("long").alias("key"), F.col("load_id").cast("string").alias("load_id"))


def k1_clustered(key, spark, sf_dir):
    """A TPC-H query over orders and lineitem as a clustered load leaves them."""
    frames = fixture_frames(spark, sf_dir, tpch.QUERIES[key].tables)
    stored = clustered.clustered_frames(frames, f"load_{uuid.uuid4().hex}", _folder(spark, "clustered"), clustered.buckets_under(spark, sf_dir))
    return tpch.run_query(key, stored, fixture=True)


CLUSTERED_KEYS = {"k1_clustered_shipmode": "q6_shipmode_priority", "k1_clustered_promo": "q7_promo_effect",
                  "k1_clustered_large_orders": "q9_large_orders"}

LOAD_BUILDERS = {"s3_tbl_rejects": s3_tbl_rejects, "s5_repeated_load": s5_repeated_load,
                 **{name: partial(k1_clustered, key) for name, key in CLUSTERED_KEYS.items()}}

LOAD_SQL = {
    "s3_tbl_rejects": """
select cast(c_custkey as bigint) as key,
       case when c_custkey % 97 in (5, 6) then 'line doesn''t fit the schema' when c_custkey % 97 = 7 then 'null in c_name' else 'loaded' end as outcome,
       case when c_custkey % 97 not in (5, 6, 7) then cast(cast(c_acctbal as decimal(15, 2)) as double) end as balance
from customer
""",
    "s5_repeated_load": """
select cast(c_custkey as bigint) as key, case when c_nationkey < 13 then 'first' else 'second' end as load_id from customer
""",
}
