"""Exact and near duplicates and components against brute force."""

import random

import numpy as np
import pytest

from tally.llm import queries
from tally.llm.components import connected_components
from tally.llm.exact_dedup import exact_dedup, flag_repeated, with_digest
from tally.llm.setsketch import _shingle_set, estimate_similarity, near_duplicates, sketch_column
from tests.llm.brute import duck_rows, near_components, rows_of

SF = "/root/testdata/sf0.01"


def test_exact_dedup_matches_sql(spark):
    assert rows_of(queries.op9_exact_dedup(spark, SF)) == duck_rows(SF, queries.ORACLE_SQL["op9_exact_dedup"])


def test_exact_dedup_edges(spark, edge_docs, no_docs):
    got = exact_dedup(with_digest(edge_docs), "text_sha256", "n_code_points", "doc_id").collect()
    assert len(got) == 13
    by = {(r["doc_id"], r["kept"]) for r in got}
    # 1, 2, 2 and the null id are equal: the least id stays, once; a null id sorts last.
    assert (1, True) in by and (None, False) in by and (2, True) not in by
    cats = [r for r in got if r["keep_id"] == 1]
    assert len(cats) == 4 and {r["group_size"] for r in cats} == {4} and sum(r["kept"] for r in cats) == 1
    # null, empty and blank texts are equal; the longest (the blanks) stays.
    assert {r["keep_id"] for r in got if r["doc_id"] in (3, 4, 5)} == {5}
    assert {(r["doc_id"], r["keep_id"]) for r in got if r["doc_id"] in (9, 10)} == {(9, 10), (10, 10)}
    assert exact_dedup(with_digest(no_docs), "text_sha256", "n_code_points", "doc_id").count() == 0


def test_rows_that_repeat_the_kept_id_are_kept_once(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab")], "doc_id long, text string")
    got = exact_dedup(with_digest(df), "text_sha256", "n_code_points", "doc_id").collect()
    assert sum(r["kept"] for r in got) == 1 and {r["keep_id"] for r in got} == {1}


@pytest.mark.parametrize("bits", [None, 1 << 15])
def test_filter_never_misses_a_repeat(spark, bits):
    df = spark.range(40_000).selectExpr("id", "sha2(cast(id % 35000 as string), 256) as d")
    got = flag_repeated(df, "d", "flag", bits).where("not flag").selectExpr("id % 35000 as k").groupBy("k").count()
    assert got.where("count > 1 or k < 5000").isEmpty()


def test_near_dedup_matches_brute_force(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in queries.op3_setsketch_near_dedup(spark, SF).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = near_components(docs, 4, 80)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_near_dedup_chains_and_stars(spark):
    """A star whose copies aren't linked with each other, and a chain, stay whole."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(400)]
    docs, n = {100: " ".join(base)}, 101
    for _ in range(60):
        own = list(base)
        for at in rng.sample(range(400), 9):
            own[at] = word()
        docs[n] = " ".join(own)
        n += 1
    chain = [word() for _ in range(300)]
    for i in range(12):
        docs[n] = " ".join(chain)
        n += 1
        chain = chain[25:] + [word() for _ in range(25)]
    for i in range(40):
        docs[n] = " ".join(word() for _ in range(50))
        n += 1
    got = {r["id"]: (r["n_shingles"], r["component_id"])
           for r in near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), shingle=4).collect()}
    assert got == near_components(docs, 4, 80)


def test_loose_group_of_copies(spark):
    """900 copies whose edits recur, a part of them linked with no hub: links as by brute force, no row for each pair."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    pool = [(at, f"e{at}") for at in rng.sample(range(150), 40)]
    docs = {}
    for n in range(900):
        own = list(base)
        for at, word in rng.sample(pool, rng.randint(1, 9)):
            own[at] = word
        docs[n] = " ".join(own)
    got = {r["id"]: (r["n_shingles"], r["component_id"])
           for r in near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(8), shingle=4).collect()}
    want = near_components(docs, 4, 80)
    assert got == want and len({c for _, c in want.values()}) > 20


def test_clashing_columns_and_repeated_ids(spark):
    text, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, text), (2, text + " x"), (2, other), (3, other + " y"), (3, other + " y"), (4, "z " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as id", "'k' as bucket", "'c' as component", "1 as shingles")
    got = sorted((r["id"], r["component_id"]) for r in near_duplicates(df, shingle=4).collect())
    assert got == [(1, 1), (2, 1), (2, 1), (3, 1), (3, 1), (4, 4)]


def test_near_dedup_edges(spark, edge_docs, no_docs):
    got = near_duplicates(edge_docs, shingle=4).collect()
    assert len(got) == 13
    by = {r["id"]: (r["n_shingles"], r["component_id"]) for r in got if r["id"] is not None}
    assert by[1] == (8, 1) and by[2] == (8, 1)
    assert by[3] == (0, 3) and by[4] == (0, 4) and by[5] == (0, 5) and by[7] == (1, 7)
    assert [r["component_id"] for r in got if r["id"] is None] == [None]
    assert near_duplicates(no_docs, shingle=4).count() == 0


def test_registers_merge_and_estimate():
    import pyarrow as pa

    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    a, b = " ".join(words[:2000]), " ".join(words[400:2400])
    out = sketch_column(pa.array([a, b, " ".join(words[:2400]), None, "x y", ""]), 4).to_pylist()
    r = [np.frombuffer(x["registers"], dtype="<u2") if x["registers"] else None for x in out]
    assert (np.maximum(r[0], r[1]) <= r[2]).all() and (np.maximum(r[0], r[1]) == r[2]).mean() > 0.99
    assert [x["n_shingles"] for x in out] == [1997, 1997, 2397, 0, 1, 0] and r[3] is None and r[5] is None
    true = len(_shingle_set(a.encode(), 4) & _shingle_set(b.encode(), 4)) / len(_shingle_set(a.encode(), 4) | _shingle_set(b.encode(), 4))
    got = estimate_similarity(r[0][None], r[1][None], np.array([1997]), np.array([1997]))[0]
    assert abs(got - true) < 0.15
    assert rng is not None


def test_components_match_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(500, 500)]
    parent = {i: i for e in edges for i in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in parent if any(i in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
