"""Clustered storage: no exchange between orders and lineitem, folders pruned by date, same rows as unclustered."""

import uuid
from datetime import date, datetime

import pytest

from tally.plans import tpch
from tally.sources import clustered
from tally.sources.fixtures import fixture_frames
from tests.conftest import SF_SMALL
from tests.test_plans import plan

KEYS = ("q1_pricing_summary", "q2_shipping_priority", "q3_local_supplier_volume", "q4_revenue_forecast", "q5_returned_items",
        "q6_shipmode_priority", "q7_promo_effect", "q9_large_orders")


@pytest.fixture(scope="module")
def frames(spark):
    return fixture_frames(spark, SF_SMALL)


@pytest.fixture(scope="module")
def stored(spark, frames, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clustered"))
    return clustered.clustered_frames(frames, f"t_{uuid.uuid4().hex}", root, 4)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_as_unclustered(frames, stored, key):
    want = tpch.run_query(key, frames, fixture=True).collect()
    assert tpch.run_query(key, stored, fixture=True).collect() == want


@pytest.mark.parametrize("key", ["q2_shipping_priority", "q6_shipmode_priority", "q9_large_orders"])
def test_lineitem_meets_orders_without_an_exchange(stored, no_broadcast, key):
    p = plan(tpch.run_query(key, stored, fixture=True))
    tree = p.split("\n\n")[0]
    exchanged = [part.split("Arguments: ")[1].split("\n")[0] for part in p.split("\n\n") if ") Exchange" in part]
    assert "SortMergeJoin" in tree
    assert not [e for e in exchanged if "l_orderkey" in e], exchanged
    if key != "q2_shipping_priority":  # there the orders come from a join with customers, by another key
        assert not [e for e in exchanged if "o_orderkey" in e], exchanged


@pytest.mark.parametrize("key, months", [("q4_revenue_forecast", 12), ("q7_promo_effect", 1)])
def test_date_ranges_open_only_their_months(spark, stored, key, months):
    df = tpch.run_query(key, stored, fixture=True)
    filters = [line for line in plan(df).splitlines() if "PartitionFilters" in line and "l_shipmonth" in line]
    assert filters and "l_shipmonth#" in filters[0] and ">=" in filters[0]
    params = tpch.QUERIES[key].fixture or tpch.QUERIES[key].defaults
    part = clustered.dated(stored["lineitem"], "l_shipdate", params.start, tpch._plus_months(params.start, params.months))
    whole = stored["lineitem"].inputFiles()
    wanted = {r.file.split("/l_shipmonth=")[1][:10] for r in part.selectExpr("_metadata.file_path as file").distinct().collect()}
    assert len(wanted) == months < len({f.split("/l_shipmonth=")[1][:10] for f in whole})


def test_one_file_for_each_bucket_and_month(stored):
    files = [f.rsplit("/", 1) for f in stored["lineitem"].inputFiles()]
    places = [(folder, name.split("_")[-1].split(".")[0]) for folder, name in files]
    assert len(places) == len(set(places))


def test_edges_of_ranges_missing_dates_and_keys(spark, tmp_path):
    days = [datetime(1996, 2, 29, 23, 59), datetime(1996, 3, 1), datetime(1996, 3, 31), None, datetime(1996, 4, 1)]
    df = spark.createDataFrame([(i if i != 2 else None, d) for i, d in enumerate(days)], "l_orderkey long, l_shipdate timestamp")
    name = f"t_{uuid.uuid4().hex}"
    got = clustered.write_clustered(df, "lineitem", name, str(tmp_path), 2)
    assert got.count() == 5
    for start, end in ((date(1996, 3, 1), date(1996, 4, 1)), (date(1996, 3, 31), None), (None, date(1996, 3, 1)), (None, None)):
        plain, pruned = clustered.dated(df, "l_shipdate", start, end), clustered.dated(got, "l_shipdate", start, end)
        assert sorted(map(str, pruned.select(df.columns).collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError):
        clustered.write_clustered(df, "lineitem", name, str(tmp_path), 2)
    empty = clustered.write_clustered(df.limit(0), "lineitem", f"{name}_empty", str(tmp_path), 2)
    assert empty.count() == 0 and clustered.dated(empty, "l_shipdate", date(1996, 1, 1)).count() == 0


def test_bucket_count_is_a_power_of_two_that_follows_the_bytes():
    gb = 1 << 30
    assert [clustered.bucket_count(b, 8) for b in (0, 8 * gb, 9 * gb, 1000 * gb)] == [8, 8, 16, 1024]
    assert clustered.bucket_count(0, 6) == 8 and clustered.bucket_count(1 << 60, 8) == clustered.MOST_BUCKETS
