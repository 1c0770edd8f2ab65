"""Source mixing and exact search against SQL and brute force."""

import duckdb
import numpy as np
import pytest

from tally.llm import queries
from tally.llm.mixing import emit_copies, mix_sources, source_plan
from tally.llm.vafile import exact_top_k
from tests.llm.brute import duck_rows, plain, rows_of
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
DUCK_ONLY_NATIVE = ("op9_exact_dedup", "op10_mix_sources")


def test_mixing_matches_sql(spark):
    assert rows_of(queries.op10_mix_sources(spark, SF)) == duck_rows(SF, queries.ORACLE_SQL["op10_mix_sources"])


def targets(sizes, weights=(5, 2, 1), cap=3):
    """The contract's own words: share by weight, cut at the cap, share the excess again."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **share}
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, "d": 10}, {"a": 7, "b": 0, None: 5},
    {"s": 12}, {"a": 5, "b": 400, "c": 3, "d": 2, "e": 90, "f": 1, "g": 1, None: 1000}, {"a": 0, "b": 0}])
def test_targets_by_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in source_plan(df, "source", "size").collect()}
    want = targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_targets_of_many_sources_over_several_cuts(spark, monkeypatch):
    """700 sources, ties of cap / weight among them; joined by shuffle once the plan is over its bytes."""
    rng = np.random.default_rng(3)
    sizes = {f"host-{i:04d}": int(n) for i, n in enumerate(rng.choice([0, 1, 7, 50, 900, 40_000], 700))} | {None: 300}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["source"]: (r["source_size"], r["target"]) for r in source_plan(df, "source", "size").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = targets(sizes)
    assert {s: n for s, (n, _) in got.items()} == sizes
    assert all(got[s][1] == pytest.approx(want[s]) for s in want)
    docs = df.withColumn("doc_id", F.xxhash64("source"))
    small = rows_of(mix_sources(docs, "size"))
    monkeypatch.setattr("tally.llm.mixing.BROADCAST_BYTES", 1000)
    assert rows_of(mix_sources(docs, "size")) == small


def test_mixing_comes_near_and_agrees(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("source"),
                                    (F.pmod(F.hash("id"), F.lit(50)) + 1).cast("long").alias("size"))
    mixed = mix_sources(df, "size")
    taken = mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    for r in taken.collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.05)
    assert mixed.agg(F.max("copies")).first()[0] <= 3
    assert rows_of(mixed) == rows_of(mix_sources(df.repartition(7), "size"))
    assert emit_copies(mixed).count() == mixed.agg(F.sum("copies")).first()[0]


def test_mixing_edges(spark, edge_docs, no_docs, tables):
    got = queries.op10_mix_sources(spark, tables(documents=edge_docs)).collect()
    assert len(got) == 13 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (3, 4, 5)} == {0}
    assert queries.op10_mix_sources(spark, tables(documents=no_docs)).count() == 0
    clash = mix_sources(edge_docs.selectExpr("doc_id", "source", "n_chars as size", "'x' as target", "'y' as copies"), "size")
    assert clash.count() == 13


@pytest.mark.parametrize("name", ["op9_exact_dedup", "op10_mix_sources"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_search_matches_sql(spark):
    assert rows_of(queries.op4_va_file_top_k(spark, SF)) == duck_rows(SF, queries.ORACLE_SQL["op4_va_file_top_k"])


def brute_search(rows, k):
    ints = {i: np.floor(256 * np.array(v, dtype=float)).astype(int) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in ints:
        if q % 50 == 0:
            scored = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_search_edges(spark):
    """Ties, equal vectors beyond k, nulls, other lengths, fewer candidates than k, empty tables."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8).round(1)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)] + [(1000, None), (1050, [None] * 8), (1100, [float("nan")] * 8),
             (1150, [float("inf")] + [0.0] * 7), (1200, [1.0, 2.0]), (1201, [1.0, 3.0]), (1250, []), (None, [0.1] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = exact_top_k(df, F.col("vec_id") % 50 == 0, 5)
    assert sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got.collect()) == brute_search(rows32, 5)
    assert exact_top_k(df.where("false"), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_search_counts_repeated_rows_once(spark, tables):
    """Repeated queries and candidates, and ids with several vectors, against the SQL over the distinct rows."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8).round(1)]) for i in range(1, 200)]
    rows += [(i, [0.5] * 8) for i in (3, 5, 7, 11, 50, 60, 70, 80, 90)] + [(100, [0.5, 1.0]), (101, [0.5, 2.0])]
    once = spark.createDataFrame(rows, "vec_id long, embedding array<float>").dropDuplicates()
    repeated = once.union(once.where("vec_id in (3, 50, 100)")).union(once.where("vec_id in (3, 50)")).union(spark.createDataFrame([(3, [0.5] * 8)] * 9, once.schema))
    got = rows_of(queries.op4_va_file_top_k(spark, tables(embeddings=repeated)))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{tables(embeddings=once)}/embeddings.parquet/*.parquet')")
    want = con.execute(f"select query_id, rank, score, vec_id from ({queries.ORACLE_SQL['op4_va_file_top_k']})").fetchall()
    assert got == sorted((tuple(map(plain, r)) for r in want), key=repr)
