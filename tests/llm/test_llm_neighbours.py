"""Cross-polytope search: recall against brute force, exact with all probes, and edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm import crosspolytope, queries
from tally.llm.crosspolytope import buckets_of, hadamard, nearest_neighbours, probe_order, rotated

SF = "/root/testdata/sf0.01"

def twentieth():
    return F.col("vec_id") % 20 == 0


def brute(rows, k, every=20):
    """(query, rank, id, score) over the distinct usable (id, vector) rows."""
    rows = sorted({(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows
                   if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = set()
    for q, qv in rows:
        if q % every == 0:
            for i, v in rows:
                if i != q and len(v) == len(qv):
                    out.add((q, i, float((np.array(qv) * np.array(v)).sum())))
    by = {}
    for q, i, s in out:
        by.setdefault(q, []).append((-s, i))
    return {q: [(i, -s) for s, i in sorted(found)[:k]] for q, found in by.items()}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_recall_of_the_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, 20)
    got = found(queries.op11_cross_polytope(spark, SF).withColumnRenamed("vec_id", "id"))
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in got)
    scores = {(q, i): s for q in want for i, s in brute([r for r in rows], len(rows))[q]}
    assert all(s == scores[q, i] for q in got for i, s in got[q])
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def edge_rows():
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8).round(1)]) for i in range(260)]
    rows += [(i, [0.5] * 8) for i in range(300, 400)] + [(i, [float(x) for x in 30 * rng.normal(0, 1, 8)]) for i in range(400, 420)]
    rows += [(1000, None), (1020, [None] * 8), (1040, [float("nan")] * 8), (1060, [float("inf")] + [0.0] * 7), (1080, [0.0] * 8), (1100, [-0.0] * 8),
             (1120, [1.0, 2.0, 3.0]), (1121, [1.0, 3.0, 0.0]), (1140, []), (None, [0.1] * 8), (1160, [7.0])]
    return rows + rows[:40] + [(300, [0.5] * 8)] * 30 + [(320, [1.0] * 8), (321, [-0.0, 1.0, 0.0] + [0.0] * 5)]


@pytest.mark.parametrize("hashes", [1, 2])
def test_all_probes_are_exact(spark, monkeypatch, hashes):
    """Nulls, zeros, other lengths, ties, equal vectors beyond k, repeated rows, small blocks, one and two hashes a table."""
    monkeypatch.setattr(crosspolytope, "BLOCK", 7)
    monkeypatch.setattr(crosspolytope, "FULL_BUCKET", 1 << 20 if hashes == 1 else 0)
    rows = edge_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("x"), "dim": F.lit(2), "bucket": F.lit(3)})
    got = found(nearest_neighbours(df, twentieth(), 5, probes=16 ** hashes))
    assert got == brute(rows, 5)


def test_fitted_probes_reach_the_recall(spark):
    rows = edge_rows()
    got = found(nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), twentieth(), 5))
    want = brute(rows, 5)
    assert sum(len(set(got.get(q, ())) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_empty_and_lonely(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest_neighbours(spark.createDataFrame([], schema), twentieth(), 5).count() == 0
    assert nearest_neighbours(spark.createDataFrame([(20, [1.0, 0.0])], schema), twentieth(), 5).count() == 0
    assert nearest_neighbours(spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], schema), twentieth(), 5).count() == 0
    assert found(nearest_neighbours(spark.createDataFrame([(20, [2.0, 0.0]), (3, [1.0, 1.0])], schema), twentieth(), 5)) == {20: [(3, 2.0)]}


def test_rotation_and_probes():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (50, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rotated(x, 5)
    assert y.shape == (50, 16) and np.allclose(y @ y.T, x @ x.T)
    h = hadamard(np.eye(8))
    assert np.allclose(h @ h.T, np.eye(8)) and np.allclose(np.abs(h), 8 ** -0.5)
    for hashes in (1, 2):
        order = probe_order(x, 2, hashes)
        assert (order[:, 0] == buckets_of(x, 2, hashes)).all() and (np.sort(order, axis=1) == np.arange(32 ** hashes)).all()
