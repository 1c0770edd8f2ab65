"""Collocations against SQL, a plain-Python version, and the index against counting."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tally.llm import queries
from tally.llm.collocations import SHARD_BYTES, Bwt, Shard, _frequent_phrases, _key_counts, collocations
from tally.llm.textvec import texts_of
from tests.llm.brute import duck_rows, rows_of

SF = "/root/testdata/sf0.01"


def brute(docs, least=10, keep_below=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows, by counting dictionaries."""
    counts, totals = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in (1, 2, 3):
                own.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        rows = []
        for p, a in own.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and f >= least and p in (q[:2], q[1:]) and 100 * f >= keep_below * a for q, f in own.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((-a, left, lang, totals[lang], p.decode(), right, rank, -s))
    return sorted(out, key=repr)


def test_matches_sql(spark):
    assert rows_of(queries.op13_collocations(spark, SF)) == duck_rows(SF, queries.ORACLE_SQL["op13_collocations"])


def test_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(11)
    words = ["the", "The", "a", "été", "x", "ß", "of", "\x00"]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\r", " \t ", "; ", "\x85"]
    rows = [("".join(str(rng.choice(words)) + str(rng.choice(marks, p=[.5, .1, .1, .05, .05, .05, .05, .04, .03, .03])) for _ in range(int(rng.integers(0, 60)))),
             [None, "en", "und", "fr", ""][int(rng.integers(0, 5))]) for _ in range(400)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    want = brute(rows, least=4)
    assert len(want) > 100
    assert rows_of(collocations(df, least=4)) == want
    assert rows_of(collocations(df, least=4, top=3)) == brute(rows, least=4, top=3)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r["text"], r["lang"]) for r in edge_docs.collect()]
    want = brute(rows, least=2)
    assert rows_of(collocations(edge_docs, least=2)) == want and want
    assert collocations(no_docs, least=2).count() == 0
    blank = spark.createDataFrame([(None, "en"), ("", None), (" .,\n ", "en")], "text string, lang string")
    assert collocations(blank, least=1).count() == 0


def test_one_language_and_shard_edges(spark):
    """A phrase that each of many partitions holds once, copies of one document, and one very long text."""
    copies = [("alpha beta gamma delta", "en")] * 300
    long = [(" ".join(["left right"] * 60_000), "en")]
    got = {r["phrase"]: r for r in collocations(spark.createDataFrame(copies + long, "text string, lang string").repartition(50)).collect()}
    assert got["alpha beta gamma"]["a"] == 300 and "alpha beta" not in got and got["left right left"]["a"] == 59_999
    assert got["alpha beta gamma"]["n"] == 300 * 4 + 120_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60))
def test_index_counts_every_ngram(values):
    """Extensions to the left, then to the right, give all n-grams between zeros with their counts and places."""
    s = np.array([0, *values, 0], dtype=np.int32)
    forward, backward = Bwt(s, 3), Bwt(s[::-1], 2)
    zeros, size = int((s == 0).sum()), np.bincount(s, minlength=5)[1:]
    low = zeros + np.cumsum(size) - size
    have = size > 0
    parent, left, pair_low, pair_size, pair_other = forward.extend(low[have], size[have], low[have])
    right = np.flatnonzero(have)[parent] + 1
    grams = list(zip(s, s[1:], s[2:]))
    want2 = Counter(p for p in zip(s.tolist(), s[1:].tolist()) if 0 not in p)
    assert dict(zip(zip(left.tolist(), right.tolist()), pair_size.tolist())) == want2
    up, third, _, n, at = backward.extend(pair_other, pair_size, pair_low)
    got = {(int(left[i]), int(right[i]), int(c)): int(k) for i, c, k in zip(up, third, n)}
    assert got == Counter(tuple(map(int, g)) for g in grams if 0 not in g)
    for g, lo, k in zip(got, at, n):  # the interval in the forward transform holds its places
        places = forward.order[lo:lo + k]
        assert all(tuple(s[p:p + 3]) == g for p in places)


def test_memory_of_a_full_shard():
    """Both passes over a full shard of mostly different pairs stay below 200 MB, in batches of a few MB, with no word lost."""
    rng = np.random.default_rng(3)
    lines = [" ".join(f"w{w}" for w in rng.zipf(1.3, 400) % 1_000_000) for _ in range(1000)]
    size = sum(map(len, lines)) + len(lines)
    every = np.full(1 << 12, 255, dtype=np.uint8)
    for rows_of in (_key_counts, lambda index: _frequent_phrases(index, every)):
        tracemalloc.start()
        try:
            shard = Shard()
            for i in range(-(-SHARD_BYTES // size)):
                column = pa.array([" ".join(line.split(" ")[i:]) for line in lines])
                for x in texts_of(column):
                    shard.add(x, ["en"] * len(lines))
            n_words = sum(len(part[0]) for part in shard.parts)
            totals = most_rows = most_bytes = 0
            for batch in rows_of(shard.index()):
                most_rows, most_bytes = max(most_rows, batch.num_rows), max(most_bytes, batch.nbytes)
                if "phrase" in batch.schema.names:
                    one_word = [n for phrase, n in zip(batch["phrase"].to_pylist(), batch["n"].to_pylist()) if phrase and " " not in phrase]
                    totals += sum(one_word)
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert peak < 200 << 20
        assert most_rows <= 100_000 and most_bytes < 8 << 20
    assert totals == n_words


@pytest.mark.parametrize("counts", [(10**9, 10**9, 10**9), (999_999_999_999, 10**12, 10**12)])
def test_scores_pass_64_bits(spark, counts):
    a, left, right = counts
    got = spark.createDataFrame([counts], "a long, l long, r long").selectExpr(
        "cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as s").first()["s"]
    assert got == 10**6 * a * a // (left * right)
