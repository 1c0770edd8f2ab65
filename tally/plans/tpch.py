"""Nine parameterised TPC-H queries as DataFrame plans.

Semantics follow the SQL text of the standard queries (not the drifted
DataFrame variants): real interval arithmetic, decimal bounds, the cyclic
nation predicate, ``< commitdate`` guards, null-safe conditional sums.

Plan shape, chosen for large inputs:

* Filters and projections are written first so Catalyst pushes them into
  the Parquet scan (``PushedFilters`` / pruned ``ReadSchema``).
* ``lineitem`` is pre-aggregated on the join key before joining when the
  grouping columns are functionally dependent on a primary key
  (``o_orderkey``, ``c_custkey``, ``p_partkey``): the partial aggregate runs
  map-side, the exchange it needs is the one the join needs anyway, and the
  join input shrinks. Results are identical because sums are exact decimals.
* Only ``region`` and ``nation`` carry a broadcast hint: TPC-H fixes them at
  5 and 25 rows at every scale. Every other join is left to AQE, which
  broadcasts a side only after measuring it at runtime
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``) and otherwise keeps a
  shuffle join with skew splitting.
* Money is DECIMAL(15,2) (see ``tally.sources.fixtures``); results are cast
  to DOUBLE at the end, averages are ``sum / count``.
* Top-k queries order by a unique tie-break key so LIMIT is deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.sources.clustered import dated


def _one():
    return F.lit(Decimal("1"))


def _disc_price():
    return F.col("l_extendedprice") * (_one() - F.col("l_discount"))


def _plus_months(d: date, months: int):
    # Folded to a literal by Catalyst, so the comparison still pushes down.
    return F.add_months(F.lit(d), months)


def _top(df: DataFrame, limit: int | None) -> DataFrame:
    """Keep the first ``limit`` rows of an ordered frame; ``None`` or negative (``-1``) = no limit."""
    return df if limit is None or limit < 0 else df.limit(limit)


def _as_date(column: str):
    return F.col(column).cast("date").alias(column)


# --- parameters (defaults are the reference literals) ----------------------


@dataclass(frozen=True)
class PricingSummaryParams:
    ship_cutoff: date = date(1998, 12, 1)
    delta_days: int = 90


@dataclass(frozen=True)
class ShippingPriorityParams:
    segment: str = "BUILDING"
    as_of: date = date(1995, 3, 15)
    limit: int = 10


@dataclass(frozen=True)
class LocalSupplierVolumeParams:
    region: str = "ASIA"
    start: date = date(1994, 1, 1)
    months: int = 12


@dataclass(frozen=True)
class RevenueForecastParams:
    start: date = date(1994, 1, 1)
    months: int = 12
    discount: Decimal = Decimal("0.06")
    discount_delta: Decimal = Decimal("0.01")
    max_quantity: Decimal = Decimal("24")


@dataclass(frozen=True)
class ReturnedItemsParams:
    start: date = date(1993, 10, 1)
    months: int = 3
    return_flag: str = "R"
    limit: int = 20


@dataclass(frozen=True)
class ShipmodePriorityParams:
    shipmodes: tuple = ("MAIL", "SHIP")
    start: date = date(1994, 1, 1)
    months: int = 12
    high_priorities: tuple = ("1-URGENT", "2-HIGH")


@dataclass(frozen=True)
class PromoEffectParams:
    start: date = date(1995, 9, 1)
    months: int = 1
    type_prefix: str = "PROMO"


@dataclass(frozen=True)
class SupplierCountParams:
    brand: str = "Brand#45"
    type_prefix: str = "MEDIUM POLISHED"
    sizes: tuple = (49, 14, 23, 45, 19, 3, 36, 9)
    comment_pattern: str = "%Customer%Complaints%"


@dataclass(frozen=True)
class LargeOrdersParams:
    min_quantity: Decimal = Decimal("300")
    limit: int = 100


# --- queries ----------------------------------------------------------------


def pricing_summary(lineitem: DataFrame, p: PricingSummaryParams = PricingSummaryParams()) -> DataFrame:
    """TPC-H Q1: per (returnflag, linestatus) sums, averages and counts."""
    cutoff = F.date_sub(F.lit(p.ship_cutoff), p.delta_days)
    disc_price = _disc_price()
    charge = disc_price * (_one() + F.col("l_tax"))
    agg = (
        lineitem.where(F.col("l_shipdate") <= cutoff)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("s_qty"),
            F.sum("l_extendedprice").alias("s_price"),
            F.sum(disc_price).alias("s_disc_price"),
            F.sum(charge).alias("s_charge"),
            F.sum("l_discount").alias("s_disc"),
            F.count("l_quantity").alias("n_qty"),
            F.count("l_extendedprice").alias("n_price"),
            F.count("l_discount").alias("n_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
    )
    dbl = lambda c: F.col(c).cast("double")
    return agg.select(
        "l_returnflag",
        "l_linestatus",
        dbl("s_qty").alias("sum_qty"),
        dbl("s_price").alias("sum_base_price"),
        dbl("s_disc_price").alias("sum_disc_price"),
        dbl("s_charge").alias("sum_charge"),
        F.try_divide(dbl("s_qty"), F.col("n_qty")).alias("avg_qty"),
        F.try_divide(dbl("s_price"), F.col("n_price")).alias("avg_price"),
        F.try_divide(dbl("s_disc"), F.col("n_disc")).alias("avg_disc"),
        F.col("count_order").cast("long").alias("count_order"),
    ).orderBy("l_returnflag", "l_linestatus")


def shipping_priority(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
    p: ShippingPriorityParams = ShippingPriorityParams(),
) -> DataFrame:
    """TPC-H Q3: top unshipped orders by revenue for one market segment."""
    as_of = F.lit(p.as_of)
    segment = customer.where(F.col("c_mktsegment") == p.segment).select("c_custkey")
    open_orders = (
        dated(orders, "o_orderdate", end=p.as_of)
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_shippriority")
        .join(segment, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    )
    revenue = (
        dated(lineitem, "l_shipdate", start=p.as_of).where(F.col("l_shipdate") > as_of)
        .groupBy("l_orderkey")
        .agg(F.sum(_disc_price()).alias("revenue_dec"))
    )
    return (
        revenue.join(open_orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey",
            F.col("revenue_dec").cast("double").alias("revenue"),
            _as_date("o_orderdate"),
            "o_shippriority",
        )
        .orderBy(F.desc("revenue"), "o_orderdate", "l_orderkey")
    ).transform(_top, p.limit)


def local_supplier_volume(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, supplier: DataFrame,
    nation: DataFrame, region: DataFrame,
    p: LocalSupplierVolumeParams = LocalSupplierVolumeParams(),
) -> DataFrame:
    """TPC-H Q5: revenue per nation where customer and supplier share the nation."""
    regions = region.where(F.col("r_name") == p.region).select("r_regionkey")
    nations = (
        nation.join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
        .select("n_nationkey", "n_name")
    )
    customers = (
        customer.select("c_custkey", "c_nationkey")
        .join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    )
    order_nation = (
        dated(orders, "o_orderdate", p.start, _plus_months(p.start, p.months))
        .select("o_orderkey", "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    # One row per (supplier, customer nation) before the supplier join.
    by_supplier = (
        lineitem.select("l_orderkey", "l_suppkey", _disc_price().alias("rev"))
        .join(order_nation, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "c_nationkey")
        .agg(F.sum("rev").alias("rev"))
    )
    suppliers = supplier.select("s_suppkey", "s_nationkey")
    return (
        by_supplier.join(
            suppliers,
            (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")),
        )
        .join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.sum("rev").cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), "n_name")
    )


def revenue_forecast(lineitem: DataFrame, p: RevenueForecastParams = RevenueForecastParams()) -> DataFrame:
    """TPC-H Q6: revenue from removing a discount band; one row."""
    lo = p.discount - p.discount_delta  # Decimal arithmetic: exactly 0.05
    hi = p.discount + p.discount_delta  # exactly 0.07
    return (
        dated(lineitem, "l_shipdate", p.start, _plus_months(p.start, p.months))
        .where(
            F.col("l_discount").between(F.lit(lo), F.lit(hi))
            & (F.col("l_quantity") < F.lit(p.max_quantity))
        )
        .agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).cast("double").alias("revenue"))
    )


def returned_items(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, nation: DataFrame,
    p: ReturnedItemsParams = ReturnedItemsParams(),
) -> DataFrame:
    """TPC-H Q10: top customers by revenue lost to returns in a quarter."""
    quarter = (
        dated(orders, "o_orderdate", p.start, _plus_months(p.start, p.months))
        .select("o_orderkey", "o_custkey")
    )
    per_order = (
        lineitem.where(F.col("l_returnflag") == p.return_flag)
        .groupBy("l_orderkey")
        .agg(F.sum(_disc_price()).alias("rev"))
    )
    per_customer = (
        per_order.join(quarter, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("rev").alias("rev"))
    )
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nation.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            "c_name",
            F.col("rev").cast("double").alias("revenue"),
            F.col("c_acctbal").cast("double").alias("c_acctbal"),
            "n_name",
            "c_address",
            "c_phone",
            "c_comment",
        )
        .orderBy(F.desc("revenue"), "c_custkey")
    ).transform(_top, p.limit)


def shipmode_priority(
    orders: DataFrame, lineitem: DataFrame, p: ShipmodePriorityParams = ShipmodePriorityParams(),
) -> DataFrame:
    """TPC-H Q12: late-received lines per ship mode, split by order priority."""
    start = F.lit(p.start)
    lines = (
        lineitem.where(
            F.col("l_shipmode").isin(*p.shipmodes)
            & (F.col("l_commitdate") < F.col("l_receiptdate"))
            & (F.col("l_shipdate") < F.col("l_commitdate"))
            & (F.col("l_receiptdate") >= start)
            & (F.col("l_receiptdate") < _plus_months(p.start, p.months))
        )
        .groupBy("l_orderkey", "l_shipmode")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    priority = F.col("o_orderpriority")
    high = priority.isin(*p.high_priorities)
    low = F.lit(True)
    for value in p.high_priorities:
        low = low & (priority != value)
    return (
        lines.join(orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_shipmode")
        .agg(
            F.sum(F.when(high, F.col("n")).otherwise(0)).cast("long").alias("high_line_count"),
            F.sum(F.when(low, F.col("n")).otherwise(0)).cast("long").alias("low_line_count"),
        )
        .orderBy("l_shipmode")
    )


def promo_effect(lineitem: DataFrame, part: DataFrame, p: PromoEffectParams = PromoEffectParams()) -> DataFrame:
    """TPC-H Q14: percentage of one month's revenue from promotional parts."""
    per_part = (
        dated(lineitem, "l_shipdate", p.start, _plus_months(p.start, p.months))
        .groupBy("l_partkey")
        .agg(F.sum(_disc_price()).alias("rev"))
    )
    joined = per_part.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    promo = F.sum(F.when(F.col("p_type").like(p.type_prefix + "%"), F.col("rev")).otherwise(F.lit(Decimal("0"))))
    total = F.sum("rev")
    return joined.agg(
        F.try_divide(F.lit(100.0) * promo.cast("double"), total.cast("double")).alias("promo_revenue")
    )


def supplier_count(
    partsupp: DataFrame, part: DataFrame, supplier: DataFrame, p: SupplierCountParams = SupplierCountParams(),
) -> DataFrame:
    """TPC-H Q16: suppliers per (brand, type, size) excluding complained-about ones.

    ``NOT IN (subquery)`` becomes a left-anti join plus SQL's rule for NULL
    keys, as scalar subqueries over the excluded suppliers: one NULL among
    them leaves no row, and a NULL offer key passes only if nothing is
    excluded. So no null-aware nested loop is needed at any size.
    """
    parts = part.where(
        (F.col("p_brand") != p.brand)
        & ~F.col("p_type").like(p.type_prefix + "%")
        & F.col("p_size").isin(*p.sizes)
    ).select("p_partkey", "p_brand", "p_type", "p_size")
    excluded = supplier.where(F.col("s_comment").like(p.comment_pattern)).select("s_suppkey")
    null_keys = excluded.where(F.col("s_suppkey").isNull()).agg(F.count(F.lit(1))).scalar()
    all_keys = excluded.agg(F.count(F.lit(1))).scalar()
    offers = (
        partsupp.select("ps_partkey", "ps_suppkey")
        .join(excluded, F.col("ps_suppkey") == F.col("s_suppkey"), "left_anti")
        .where((null_keys == 0) & (F.col("ps_suppkey").isNotNull() | (all_keys == 0)))
    )
    return (
        offers.join(parts, F.col("ps_partkey") == F.col("p_partkey"))
        .groupBy("p_brand", "p_type", "p_size")
        .agg(F.count_distinct("ps_suppkey").cast("long").alias("supplier_cnt"))
        .orderBy(F.desc("supplier_cnt"), "p_brand", "p_type", "p_size")
    )


def large_orders(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, p: LargeOrdersParams = LargeOrdersParams(),
) -> DataFrame:
    """TPC-H Q18: orders whose total quantity exceeds a threshold.

    The ``IN (group by ... having)`` subquery and the outer ``sum(l_quantity)``
    group on the same order key, so one aggregate of lineitem serves both.
    """
    per_order = (
        lineitem.groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("qty"))
        .where(F.col("qty") > F.lit(p.min_quantity))
    )
    # Large orders are few; AQE broadcasts them if their measured size allows.
    with_orders = per_order.join(
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    return (
        with_orders.join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "c_name",
            "c_custkey",
            "o_orderkey",
            _as_date("o_orderdate"),
            F.col("o_totalprice").cast("double").alias("o_totalprice"),
            F.col("qty").cast("double").alias("sum_qty"),
        )
        .orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey")
    ).transform(_top, p.limit)


# --- registry ----------------------------------------------------------------


@dataclass(frozen=True)
class QuerySpec:
    key: str
    tpch_number: int
    build: callable
    tables: tuple
    defaults: object
    fixture: object = field(default=None)


QUERIES = {
    "q1_pricing_summary": QuerySpec("q1_pricing_summary", 1, pricing_summary, ("lineitem",),
                                    PricingSummaryParams()),
    "q2_shipping_priority": QuerySpec("q2_shipping_priority", 3, shipping_priority,
                                      ("customer", "orders", "lineitem"), ShippingPriorityParams(),
                                      ShippingPriorityParams(as_of=date(1998, 3, 15))),
    "q3_local_supplier_volume": QuerySpec("q3_local_supplier_volume", 5, local_supplier_volume,
                                          ("customer", "orders", "lineitem", "supplier", "nation", "region"),
                                          LocalSupplierVolumeParams(),
                                          LocalSupplierVolumeParams(start=date(1997, 1, 1))),
    "q4_revenue_forecast": QuerySpec("q4_revenue_forecast", 6, revenue_forecast, ("lineitem",),
                                     RevenueForecastParams(), RevenueForecastParams(start=date(1997, 1, 1))),
    "q5_returned_items": QuerySpec("q5_returned_items", 10, returned_items,
                                   ("customer", "orders", "lineitem", "nation"), ReturnedItemsParams(),
                                   ReturnedItemsParams(start=date(1996, 10, 1))),
    "q6_shipmode_priority": QuerySpec("q6_shipmode_priority", 12, shipmode_priority, ("orders", "lineitem"),
                                      ShipmodePriorityParams(), ShipmodePriorityParams(start=date(1997, 1, 1))),
    "q7_promo_effect": QuerySpec("q7_promo_effect", 14, promo_effect, ("lineitem", "part"),
                                 PromoEffectParams()),
    "q8_supplier_count": QuerySpec("q8_supplier_count", 16, supplier_count, ("partsupp", "part", "supplier"),
                                   SupplierCountParams(),
                                   SupplierCountParams(brand="Brand#12", type_prefix="MEDIUM")),
    "q9_large_orders": QuerySpec("q9_large_orders", 18, large_orders, ("customer", "orders", "lineitem"),
                                 LargeOrdersParams()),
}


def run_query(key: str, frames: dict[str, DataFrame], params=None, fixture: bool = False) -> DataFrame:
    """Build query ``key`` over ``frames``; ``fixture=True`` uses the shifted test parameters."""
    spec = QUERIES[key]
    if params is None:
        params = spec.fixture if (fixture and spec.fixture is not None) else spec.defaults
    return spec.build(*[frames[t] for t in spec.tables], params)
