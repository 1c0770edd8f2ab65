"""Language, toxicity and quality: held-out accuracy on the test tables, and edge cases."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tally.llm import queries
from tally.llm.language_id import LanguageFilters, fit_language_filters, identify_language
from tally.llm.quality import (DIM, NONZERO, WINDOW, WORDS, _log_loss, _tokens, fit_word_vectors, index_vectors, pooled,
                               train_network)
from tally.llm.textvec import texts_of
from tally.llm.toxicity import BUCKETS, FEATURES, RIDGE, _buckets, _most_typical, _texts_with, calibrate, train_nnpu

SF = "/root/testdata/sf0.01"
SF_MORE = "/root/testdata/sf0.1"


def auc(score, label):
    place = np.empty(len(score))
    place[np.argsort(score, kind="stable")] = np.arange(len(score))
    one = np.asarray(label) == 1
    return (place[one].sum() - one.sum() * (one.sum() - 1) / 2) / (one.sum() * (~one).sum())


def held_out(ids, folds, part):
    return np.array([zlib.crc32(str(i).encode()) % folds == part for i in ids])


def test_language_held_out_accuracy(spark):
    got = queries.op1_language_id(spark, SF).toPandas()
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth)
    assert (both.held_out == held_out(both.doc_id, 3, 1)).all()
    known = both[both.held_out & both.lang.notna()]
    assert (known.lang_pred == known.lang).mean() > 0.98
    assert both.score.between(0, 1).all()


def test_language_filters_hold_all_their_grams():
    grams = {"x": np.arange(5000, dtype=np.uint32), "y": np.arange(4000, 9000, dtype=np.uint32)}
    filters = LanguageFilters.build(grams, {"x": 3, "y": 5})
    counts = filters.counts(np.arange(9000, dtype=np.uint32), np.zeros(9000, dtype=np.int64), 1)[0]
    assert abs(counts[0] - 5000) < 60 and abs(counts[1] - 5000) < 60  # false positives are taken off
    assert filters.default == 1


def test_language_edges(spark, edge_docs, no_docs):
    filters = fit_language_filters(edge_docs, train=F.lit(True))
    got = {(r["doc_id"], r["n_chars"]): r for r in identify_language(edge_docs, filters).collect()}
    assert got[3, None]["language"]["lang_pred"] == "und"
    assert got[4, 0]["language"]["lang_pred"] == "und" and got[5, 4]["language"]["score"] == 0
    assert got[8, 1]["language"]["lang_pred"] == "und"
    assert got[7, 1]["language"]["lang_pred"] in {"en", "fr", "de"}
    assert got[1, 5]["language"]["lang_pred"] == "en"
    nothing = fit_language_filters(no_docs, train=F.lit(True))
    assert identify_language(no_docs, nothing).count() == 0
    assert {r["language"]["lang_pred"] for r in identify_language(edge_docs, nothing).collect()} == {"und"}


def test_a_rare_language_is_learned_at_every_size(spark):
    """30 rows among 4,000 of another language, sampled to 50 a language: still predicted, and kept by the pipeline's rule."""
    from tally.llm.language_id import accepted

    common = [(i, f"the quick brown fox number {i} jumps over lazy dogs again", "en") for i in range(4000)]
    rare = [(10_000 + i, f"zkrz przyjdzie wczoraj szczegolnie trzydziesci {i} dzwiek", "xx") for i in range(30)]
    df = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    filters = fit_language_filters(df, train=F.lit(True), sample_docs=50)
    got = identify_language(df, filters).withColumn("kept", accepted(F.col("language"))).groupBy("lang", "language.lang_pred", "kept").count().collect()
    assert {(r["lang"], r["lang_pred"], r["kept"]) for r in got} == {("en", "en", True), ("xx", "xx", True)}


def test_language_by_sets(spark):
    """Predictions against plain sets of n-grams in place of the filters."""
    rows = [(r["doc_id"], r["text"] or "", r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]

    def grams(text):
        data = bytes(b | 32 if 65 <= b <= 90 else b for b in text.encode())
        words = "".join(chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in data).split()
        return [w[i:i + 4] for word in words for w in [f" {word} "] for i in range(len(w) - 3)]

    train, count = {}, {}
    for i, text, lang in rows:
        if lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            count[lang] = count.get(lang, 0) + 1
            for g in set(grams(text)):
                train.setdefault(lang, {}).setdefault(g, []).append(i)
    kept = {lang: {g for g, own in found.items() if len(own) >= max(1, -(-count[lang] // 100))} for lang, found in train.items()}
    got = {r["doc_id"]: r for r in queries.op1_language_id(spark, "/root/testdata/sf0.001").collect()}
    agree = 0
    for i, text, _ in rows:
        own = grams(text)
        if not own:
            assert got[i]["lang_pred"] == "und"
            agree += 1
            continue
        hits = {lang: sum(g in k for g in own) for lang, k in kept.items()}
        best = max(hits.values())
        agree += hits[got[i]["lang_pred"]] >= 0.98 * best
        assert got[i]["n_grams"] == len(own), (i, len(own), got[i])
    assert agree >= 0.99 * len(rows)


def test_nnpu_finds_the_marker():
    """Positives carry bucket 7; a tenth of the unlabelled do."""
    rng = np.random.default_rng(0)
    n_p, n_u = 200, 2000
    marked = np.r_[np.ones(n_p, bool), rng.random(n_u) < 0.1]
    rows, buckets = [], []
    for i, m in enumerate(marked):
        own = set(rng.integers(100, 2000, 20)) | ({7} if m else set())
        rows += [i] * len(own)
        buckets += sorted(own)
    rows, buckets = np.array(rows), np.array(buckets)
    model = train_nnpu(rows, buckets, np.arange(n_p), np.arange(n_p, n_p + n_u), 0.1)
    margin = model.margins(rows, buckets, n_p + n_u)
    assert auc(margin[n_p:], marked[n_p:]) > 0.99
    slope, shift = calibrate(margin[n_p:], marked[n_p:])
    p = 1 / (1 + np.exp(-(slope * margin[n_p:] + shift)))
    assert ((p >= 0.7) == marked[n_p:]).mean() > 0.98
    # Rows that are in neither sample (kept for calibration only) don't count.
    fewer = train_nnpu(rows, buckets, np.arange(n_p - 50), np.arange(n_p, n_p + n_u - 50), 0.1)
    assert auc(fewer.margins(rows, buckets, n_p + n_u)[-50:], marked[-50:]) > 0.99
    assert (train_nnpu(rows, buckets, np.arange(0), np.arange(5), 0.1).weights == 0).all()
    assert model.weights.shape == (BUCKETS,)


@pytest.mark.parametrize("name, label, folds, part, threshold, least", [
    ("op2_toxicity", "toxic", 3, 1, 0.7, 0.93), ("op8_quality", "quality", 5, 0, 0.3, 0.98)])
def test_held_out_ranking(spark, name, label, folds, part, threshold, least):
    got = queries.QUERIES[name](spark, SF_MORE).toPandas()
    truth = spark.read.parquet(f"{SF_MORE}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{SF_MORE}/documents.parquet").count()
    assert (got.held_out == held_out(got.doc_id, folds, part)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= threshold)).all()
    known = got.merge(truth.dropna(subset=[label]), on="doc_id").query("held_out")
    assert auc(known.score, known[label]) > least
    assert (known.predicted == known[label]).mean() > 0.95


@pytest.mark.parametrize("name", ["op1_language_id", "op2_toxicity", "op8_quality"])
def test_models_on_edges_and_empty_tables(spark, edge_docs, no_docs, tables, name):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 1), (7, 0, None), (None, 1, 1), (9, None, 1), (9, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = queries.QUERIES[name](spark, tables(documents=edge_docs, labels=labels)).toPandas()
    assert len(got) == 13 and got.score.between(0, 1).all()
    twice = got[got.doc_id == 2]
    assert twice.score.nunique() == 1
    empty = queries.QUERIES[name](spark, tables(documents=no_docs, labels=labels.where("false")))
    assert empty.count() == 0
    unlabelled = queries.QUERIES[name](spark, tables(documents=edge_docs, labels=labels.where("false")))
    assert unlabelled.count() == 13


def test_toxicity_counts_and_choice_of_buckets_are_plain_ones(spark):
    """What tasks count equals a loop over the texts; long texts send no more than their chosen buckets."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(i)}" for i in rng.integers(0, 4000, int(n))) for n in rng.integers(0, 3000, 60)] + [None, "", "w1 " * 50000]
    rows = []
    for i, text in enumerate(texts):
        own = [b for _, _, _, bs in _buckets(pa.array([text], pa.string())) for b in bs]
        rows.append((np.array(own, dtype="<i4").tobytes(), i % 3 == 0, i % 2 == 0))
    sample = spark.createDataFrame(rows, "buckets binary, positive boolean, unlabelled boolean").repartition(3)
    want = np.zeros((2, BUCKETS), dtype=np.int64)
    for raw, *roles in rows:
        for i, has in enumerate(roles):
            if has:
                for b in np.frombuffer(raw, dtype="<i4"):
                    want[i, b] += 1
    got = _texts_with(sample)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    tied = np.zeros(BUCKETS)
    tied[10:10 + 3 * FEATURES] = 5.0
    tied[9] = 6.0
    assert list(_most_typical(tied, 4.0)) == [9, *range(10, 9 + FEATURES)]
    assert len(_most_typical(tied, 5.5)) == 1 and not len(_most_typical(tied, 7.0))


def test_toxicity_risk_gradient_matches_a_loop():
    """One feature that marks all positives: the fitted scores agree with a plain loop over the same risk."""
    rng = np.random.default_rng(11)
    n_p, n_u, prior = 80, 240, 0.2
    has = np.concatenate([np.ones(n_p, bool), rng.random(n_u) < 0.25])
    rows, buckets = np.flatnonzero(has), np.zeros(has.sum(), dtype=np.int64)
    model = train_nnpu(rows, buckets, np.arange(n_p), np.arange(n_p, n_p + n_u), prior)

    def risk(w, b):
        loss = lambda z: np.log1p(np.exp(-z))
        f = [w * h + b for h in has]
        pos = sum(loss(z) for z in f[:n_p]) / n_p
        neg = sum(loss(-z) for z in f[n_p:]) / n_u - prior * sum(loss(-z) for z in f[:n_p]) / n_p
        return prior * pos + max(0.0, neg) + RIDGE / 2 * w * w

    best = min((risk(w, b), w, b) for w in np.linspace(0, 14, 57) for b in np.linspace(-14, 0, 57))
    assert risk(model.weights[0], model.bias) <= best[0] + 0.01


def test_acceptance_is_one_rule_for_every_length(spark):
    """Unknown n-grams count against a text bit by bit: no length switches the rule on."""
    from tally.llm.language_id import BENEFIT_GRAMS, REJECT_COVERAGE, accepted

    rows = [("en", known / n if n else 0.0, n) for n in (0, 1, 5, 16, 17, 19, 20, 21, 100, 5000) for known in range(0, n + 1, max(1, n // 20))]
    rows += [("und", 0.0, 0), ("und", 0.0, 50)]
    df = spark.createDataFrame(rows, "lang_pred string, coverage double, n_grams long")
    got = {(r["lang_pred"], r["coverage"], r["n_grams"]): r["kept"] for r in df.withColumn("kept", accepted(F.struct(*df.columns))).collect()}
    for (lang, coverage, n), kept in got.items():
        know = round(coverage * n)
        margin = know + BENEFIT_GRAMS - REJECT_COVERAGE * (n + BENEFIT_GRAMS)
        if abs(margin) > 1e-9:
            assert kept == (lang == "en" and margin > 0), (lang, coverage, n)
    assert got["en", 0.0, 0] and got["en", 0.0, 5] and not got["en", 0.0, 17] and not got["en", 0.0, 5000]


def test_word_vectors_and_pooling_by_dictionary(spark):
    """Vectors of all words and means of all texts against dictionaries filled word by word."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = [t for t in texts if t is None or len(t) < 6000] + ["", None, "one", "a-b été!!  x"]
    place, sign = index_vectors()
    numbers: dict[bytes, int] = {}

    def words(text):
        found = re.findall(rb"[A-Za-z\x80-\xff]+|[^A-Za-z\x80-\xff\x20\x09-\x0d]+", (text or "").encode())
        for w in found:
            if w not in numbers:
                (run,) = texts_of(pa.array([w.decode()]))
                numbers[w] = int(_tokens(run)[1][0])
        return [numbers[w] for w in found]

    sums: dict[int, list[int]] = {}
    for text in texts:
        own = words(text)
        for i, w in enumerate(own):
            total = sums.setdefault(w, [0] * DIM)
            for near in own[max(0, i - WINDOW):i] + own[i + 1:i + 1 + WINDOW]:
                for j in range(NONZERO):
                    total[place[near][j]] += int(sign[near][j])
    unit = {w: np.array(v) / max(1e-9, float(np.linalg.norm(v))) for w, v in sums.items()}
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    vectors = fit_word_vectors(df)
    assert vectors.shape == (WORDS, DIM)
    for w, v in unit.items():
        assert np.allclose(vectors[w], v, atol=1e-6)
    assert not vectors[[i for i in range(WORDS) if i not in unit]].any()
    means = np.concatenate([x[:, :DIM] for x in pooled(pa.array(texts, pa.string()), vectors)])
    for text, mean in zip(texts, means, strict=True):
        own = words(text)
        want = sum((unit[w] for w in own), np.zeros(DIM)) / max(1, len(own))
        assert np.allclose(mean, want, atol=1e-5)


def test_temperature_is_fitted_from_few_rows_on():
    """Labels that the inputs say nothing about: an overfitted network is cooled, with 45 rows as with 450."""
    for n in (45, 450):
        rng = np.random.default_rng(n)
        x, y = rng.normal(size=(n, 20)), (rng.random(n) < 0.5).astype(float)
        model = train_network(np.zeros((1, 1)), x, y)
        held = np.arange(n) % 5 == 4
        z = model.logits(x[held])
        assert model.temperature > 1 and _log_loss(z / model.temperature, y[held]) < _log_loss(z, y[held])
    few = train_network(np.zeros((1, 1)), x[:4], np.array([0.0, 1, 0, 1]))
    assert few.temperature == 1.0
