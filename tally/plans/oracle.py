"""DuckDB oracle SQL for every registered query.

Written from the query SQL text and the reference loop semantics, not from
the Spark plans. The adapter CTEs repeat the rules of
``tally.sources.fixtures`` in SQL (money as DECIMAL(15,2), synthetic commit /
receipt dates, ship modes, supplier comments, ship priority, customer text,
partsupp) so both sides read identical inputs. Decimal sums are cast to
DOUBLE at the end and averages are ``sum / count``, as on the Spark side.
"""

from __future__ import annotations

from tally.plans.load_queries import CLUSTERED_KEYS, LOAD_SQL
from tally.plans.timing_oracle import TIMING_SQL

LINEITEM_V = """
lineitem_v as (
    select l_orderkey, l_partkey, l_suppkey, l_linenumber,
           cast(l_quantity as decimal(15,2)) as l_quantity,
           cast(l_extendedprice as decimal(15,2)) as l_extendedprice,
           cast(l_discount as decimal(15,2)) as l_discount,
           cast(l_tax as decimal(15,2)) as l_tax,
           l_returnflag, l_linestatus, l_shipdate,
           l_shipdate + to_days(cast(l_partkey % 61 - 30 as integer)) as l_commitdate,
           l_shipdate + to_days(cast(l_suppkey % 30 + 1 as integer)) as l_receiptdate,
           case l_linenumber when 1 then 'REG AIR' when 2 then 'AIR' when 3 then 'RAIL'
                when 4 then 'SHIP' when 5 then 'TRUCK' when 6 then 'MAIL' when 7 then 'FOB' end as l_shipmode
    from lineitem
)"""

ORDERS_V = """
orders_v as (
    select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(15,2)) as o_totalprice,
           o_orderdate, o_orderpriority, 0 as o_shippriority
    from orders
)"""

CUSTOMER_V = """
customer_v as (
    select c_custkey, c_name, c_nationkey, cast(c_acctbal as decimal(15,2)) as c_acctbal, c_mktsegment,
           'addr ' || cast(c_custkey as varchar) as c_address,
           'phone ' || cast(c_custkey as varchar) as c_phone,
           'note ' || cast(c_custkey as varchar) as c_comment
    from customer
)"""

SUPPLIER_V = """
supplier_v as (
    select s_suppkey, s_name, s_nationkey, cast(s_acctbal as decimal(15,2)) as s_acctbal,
           case s_suppkey % 10 when 3 then 'sly Customer even Complaints sleep'
                               when 5 then 'Complaints of Customer'
                               when 7 then 'Customer Recommends'
                               when 9 then 'no Complaints'
                               else 'regular accounts' end as s_comment
    from supplier
)"""

PARTSUPP_V = """
partsupp_v as (
    select distinct l_partkey as ps_partkey, l_suppkey as ps_suppkey from lineitem
)"""

PART_V = """
part_v as (
    select p_partkey, p_name, p_brand, p_type, p_size, cast(p_retailprice as decimal(15,2)) as p_retailprice
    from part
)"""


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


# The standard's published query text, over the adapter views above.
TPCH_SQL = {
    "q1_pricing_summary": _with(LINEITEM_V) + """
select l_returnflag, l_linestatus,
       cast(sum(l_quantity) as double) as sum_qty,
       cast(sum(l_extendedprice) as double) as sum_base_price,
       cast(sum(l_extendedprice * (1 - l_discount)) as double) as sum_disc_price,
       cast(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) as double) as sum_charge,
       cast(sum(l_quantity) as double) / count(l_quantity) as avg_qty,
       cast(sum(l_extendedprice) as double) / count(l_extendedprice) as avg_price,
       cast(sum(l_discount) as double) / count(l_discount) as avg_disc,
       cast(count(*) as bigint) as count_order
from lineitem_v
where l_shipdate <= (date '1998-12-01' - interval 90 day)
group by l_returnflag, l_linestatus
order by l_returnflag, l_linestatus
""",
    "q2_shipping_priority": _with(LINEITEM_V, ORDERS_V, CUSTOMER_V) + """
select l_orderkey,
       cast(sum(l_extendedprice * (1 - l_discount)) as double) as revenue,
       cast(o_orderdate as date) as o_orderdate,
       o_shippriority
from customer_v, orders_v, lineitem_v
where c_mktsegment = 'BUILDING'
  and c_custkey = o_custkey
  and l_orderkey = o_orderkey
  and o_orderdate < date '1998-03-15'
  and l_shipdate > date '1998-03-15'
group by l_orderkey, o_orderdate, o_shippriority
order by revenue desc, o_orderdate, l_orderkey
limit 10
""",
    "q3_local_supplier_volume": _with(LINEITEM_V, ORDERS_V, CUSTOMER_V, SUPPLIER_V) + """
select n_name, cast(sum(l_extendedprice * (1 - l_discount)) as double) as revenue
from customer_v, orders_v, lineitem_v, supplier_v, nation, region
where c_custkey = o_custkey
  and l_orderkey = o_orderkey
  and l_suppkey = s_suppkey
  and c_nationkey = s_nationkey
  and s_nationkey = n_nationkey
  and n_regionkey = r_regionkey
  and r_name = 'ASIA'
  and o_orderdate >= date '1997-01-01'
  and o_orderdate < date '1997-01-01' + interval '1' year
group by n_name
order by revenue desc
""",
    "q4_revenue_forecast": _with(LINEITEM_V) + """
select cast(sum(l_extendedprice * l_discount) as double) as revenue
from lineitem_v
where l_shipdate >= date '1997-01-01'
  and l_shipdate < date '1997-01-01' + interval '1' year
  and l_discount between 0.06 - 0.01 and 0.06 + 0.01
  and l_quantity < 24
""",
    "q5_returned_items": _with(LINEITEM_V, ORDERS_V, CUSTOMER_V) + """
select c_custkey, c_name,
       cast(sum(l_extendedprice * (1 - l_discount)) as double) as revenue,
       cast(c_acctbal as double) as c_acctbal,
       n_name, c_address, c_phone, c_comment
from customer_v, orders_v, lineitem_v, nation
where c_custkey = o_custkey
  and l_orderkey = o_orderkey
  and o_orderdate >= date '1996-10-01'
  and o_orderdate < date '1996-10-01' + interval '3' month
  and l_returnflag = 'R'
  and c_nationkey = n_nationkey
group by c_custkey, c_name, c_acctbal, c_phone, n_name, c_address, c_comment
order by revenue desc, c_custkey
limit 20
""",
    "q6_shipmode_priority": _with(LINEITEM_V, ORDERS_V) + """
select l_shipmode,
       cast(sum(case when o_orderpriority = '1-URGENT' or o_orderpriority = '2-HIGH' then 1 else 0 end) as bigint)
           as high_line_count,
       cast(sum(case when o_orderpriority <> '1-URGENT' and o_orderpriority <> '2-HIGH' then 1 else 0 end) as bigint)
           as low_line_count
from orders_v, lineitem_v
where o_orderkey = l_orderkey
  and l_shipmode in ('MAIL', 'SHIP')
  and l_commitdate < l_receiptdate
  and l_shipdate < l_commitdate
  and l_receiptdate >= date '1997-01-01'
  and l_receiptdate < date '1997-01-01' + interval '1' year
group by l_shipmode
order by l_shipmode
""",
    "q7_promo_effect": _with(LINEITEM_V, PART_V) + """
select 100.0 * cast(sum(case when p_type like 'PROMO%' then l_extendedprice * (1 - l_discount) else 0 end) as double)
       / nullif(cast(sum(l_extendedprice * (1 - l_discount)) as double), 0) as promo_revenue
from lineitem_v, part_v
where l_partkey = p_partkey
  and l_shipdate >= date '1995-09-01'
  and l_shipdate < date '1995-09-01' + interval '1' month
""",
    "q8_supplier_count": _with(PARTSUPP_V, SUPPLIER_V) + """
select p_brand, p_type, p_size, cast(count(distinct ps_suppkey) as bigint) as supplier_cnt
from partsupp_v, part
where p_partkey = ps_partkey
  and p_brand <> 'Brand#12'
  and p_type not like 'MEDIUM%'
  and p_size in (49, 14, 23, 45, 19, 3, 36, 9)
  and ps_suppkey not in (select s_suppkey from supplier_v where s_comment like '%Customer%Complaints%')
group by p_brand, p_type, p_size
order by supplier_cnt desc, p_brand, p_type, p_size
""",
    "q9_large_orders": _with(LINEITEM_V, ORDERS_V) + """
select c_name, c_custkey, o_orderkey, cast(o_orderdate as date) as o_orderdate,
       cast(o_totalprice as double) as o_totalprice,
       cast(sum(l_quantity) as double) as sum_qty
from customer, orders_v, lineitem_v
where o_orderkey in (select l_orderkey from lineitem_v group by l_orderkey having sum(l_quantity) > 300)
  and c_custkey = o_custkey
  and o_orderkey = l_orderkey
group by c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice
order by o_totalprice desc, o_orderdate, o_orderkey
limit 100
""",
}


def oracle_sql() -> dict[str, str]:
    return {**TPCH_SQL, **TIMING_SQL, **LOAD_SQL, **{name: TPCH_SQL[key] for name, key in CLUSTERED_KEYS.items()}}
