"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is trained from
confirmed toxic texts and unlabelled ones. The unlabelled texts' risk is
corrected by the class prior, and where the corrected negative part falls
below zero the step goes the other way, as the non-negative estimator asks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.shared import hash_share, ship_package, written
from tally.llm.textvec import mix, texts_of

BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6, 7)     # bytes of the word beginnings that count besides the whole word
FEATURES = 2000               # buckets that the classifier uses: those most typical of toxic texts
POSITIVES = 4000              # bounds of the samples that reach the driver
UNLABELLED = 8000
CALIBRATION = 4000
LEAST_TYPICAL = 4.0           # standard errors by which a bucket must be more frequent in toxic texts
FOLDS = 4
STEPS, RATE, RIDGE = 400, 0.05, 3e-5


def _buckets(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row, bucket): the distinct buckets of each text, of those ``wanted`` marks."""
    for x in texts_of(pc.utf8_lower(column)):
        letter = ((x.data >= 97) & (x.data <= 122)) | (x.data >= 128)
        start, end = x.words(~letter)
        prefix, row = x.prefix_hash(lower=False), x.row_of(start)
        hashes, rows = [x.span_hash(prefix, start, end)], [row]
        for k in BEGINNINGS:
            longer = end - start > k
            hashes.append(x.span_hash(prefix, start[longer], start[longer] + k) + np.uint64(k))
            rows.append(row[longer])
        bucket = (mix(np.concatenate(hashes)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        rows = np.concatenate(rows)
        if wanted is not None:
            own = wanted[bucket]
            bucket, rows = bucket[own], rows[own]
        pairs = np.unique(rows * BUCKETS + bucket)
        yield x.first, x.n, pairs // BUCKETS, pairs % BUCKETS


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class ToxicityModel:
    """``weights`` by bucket and ``bias`` of the classifier; ``slope`` and ``shift`` of its calibration."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        return self.bias + np.bincount(rows, weights=self.weights[buckets], minlength=n)

    def score(self, column: pa.Array) -> pa.Array:
        out = np.full(len(column), self.bias)
        wanted = self.weights != 0
        for first, n, rows, buckets in _buckets(column, wanted):
            out[first:first + n] = self.margins(rows, buckets, n)
        return pa.array(_sigmoid(self.slope * out + self.shift))


def _typical(in_p: np.ndarray, n_p: int, in_u: np.ndarray, n_u: int) -> np.ndarray:
    """By how many standard errors each bucket is more frequent in toxic texts; 0 where it is rare or isn't."""
    share_p, share_u = in_p / max(1, n_p), in_u / max(1, n_u)
    out = (share_p - share_u) / np.sqrt(share_u * (1 - share_u) / max(1, n_p) + 1e-6)
    out[(in_p < max(2, 0.002 * n_p)) | (share_p <= share_u)] = 0
    return out


def _texts_with(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many positive and unlabelled texts of ``sample`` have each bucket: tasks add up their own, Spark adds the tasks'."""
    def partial(batches):
        sums = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for part, *roles in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = np.frombuffer(part.as_buffer(), dtype="<i4")
                for i in np.flatnonzero(roles):
                    sums[i, own] += 1
        seen = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[0, seen]), pa.array(sums[1, seen])], names=["bucket", "p", "u"])

    found = (sample.select("buckets", "positive", "unlabelled").mapInArrow(partial, "bucket long, p long, u long")
             .groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).toArrow())
    out = np.zeros((2, BUCKETS), dtype=np.int64)
    for i, name in enumerate(("p", "u")):
        out[i, found["bucket"].to_numpy()] = found[name].to_numpy()
    return out[0], out[1]


def _most_typical(typical: np.ndarray, least: float) -> np.ndarray:
    """The ``FEATURES`` buckets with the highest values of at least ``least``; ties to the smaller bucket."""
    chosen = np.argsort(-typical, kind="stable")[:FEATURES]
    return chosen[typical[chosen] >= least]


def train_nnpu(rows: np.ndarray, buckets: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray,
               prior: float) -> ToxicityModel:
    """Fit from the (row, bucket) pairs of texts; ``positive`` and ``unlabelled`` are row numbers.

    Risk: prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]) with the
    logistic loss, minimised by Adam over all rows from a fixed start.
    """
    n = int(max(rows.max(initial=-1), positive.max(initial=-1), unlabelled.max(initial=-1))) + 1
    n_p, n_u = len(positive), len(unlabelled)
    model = ToxicityModel(np.zeros(BUCKETS), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    if not n_p or not n_u:
        return model
    is_p, is_u = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    is_p[positive], is_u[unlabelled] = True, True
    typical = _typical(np.bincount(buckets[is_p[rows]], minlength=BUCKETS), n_p,
                       np.bincount(buckets[is_u[rows]], minlength=BUCKETS), n_u)
    chosen = _most_typical(typical, LEAST_TYPICAL)
    number = np.full(BUCKETS, -1)
    number[chosen] = np.arange(len(chosen))
    own = number[buckets] >= 0
    r, f = rows[own], number[buckets[own]]

    size = len(chosen) + 1
    theta, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    theta[-1] = model.bias
    for step in range(1, STEPS + 1):
        margin = theta[-1] + np.bincount(r, weights=theta[f], minlength=n)
        p, negative = _sigmoid(margin), np.logaddexp(0, margin)
        grad = np.zeros(n)
        if negative[unlabelled].mean() >= prior * negative[positive].mean():
            grad[positive] += prior * (p[positive] - 1) / n_p - prior * p[positive] / n_p
            grad[unlabelled] += p[unlabelled] / n_u
        else:
            grad[positive] += prior * p[positive] / n_p
            grad[unlabelled] -= p[unlabelled] / n_u
        g = np.append(np.bincount(f, weights=grad[r], minlength=size - 1) + RIDGE * theta[:-1], grad.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    model.weights[chosen], model.bias = theta[:-1], float(theta[-1])
    return model


def calibrate(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of labels on margins (Platt's smoothed targets, Newton steps)."""
    n_1, n_0 = int(toxic.sum()), int((~toxic).sum())
    if not n_1 or not n_0:
        return 1.0, 0.0
    target = np.where(toxic, (n_1 + 1) / (n_1 + 2), 1 / (n_0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    pull = np.array([1.0, 1e-3])  # towards slope 1 and shift 0
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ theta)
        g = x.T @ (p - target) + pull * (theta - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull) + 1e-9 * np.eye(2)
        step = np.linalg.solve(h, g)
        theta = theta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 0.05)), float(theta[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", key: str = "doc_id",
                 toxic: str = "toxic") -> ToxicityModel:
    """Learn from rows of ``docs`` where ``train`` holds; ``labels`` has ``key`` and 0/1 ``toxic``.

    Samples by a hash of the key, in rows: ``POSITIVES`` confirmed toxic texts,
    ``UNLABELLED`` texts of any label, ``CALIBRATION`` labelled ones. Their
    distinct buckets are written and counted by the tasks; the driver gets the
    counts and, of each sampled text, those of the ``FEATURES`` most typical
    buckets, so texts of any length add at most 4 bytes x ``FEATURES`` each.
    Buckets that tie at the edge go in by number. The class prior is the toxic
    share of all labelled training rows.
    """
    ship_package(docs.sparkSession)
    base = docs.where(train).select(F.col(key).alias("key"), F.col(text).alias("text"))
    marks = (labels.select(F.col(key).alias("marked"), F.col(toxic).alias("toxic"))
             .where("marked is not null and toxic in (0, 1)").groupBy("marked").agg(F.max("toxic").alias("toxic")))
    keys = base.select("key").join(marks, F.col("key") == F.col("marked"), "left").select("key", "toxic")
    n_all, n_marked, n_toxic = keys.agg(F.count("*"), F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    roles = keys.select("key", "toxic", *[
        (of & hash_share(F.concat(F.lit(role), F.col("key").cast("string")), bound, total)).alias(role)
        for role, of, bound, total in (
            ("positive", F.col("toxic") == 1, POSITIVES, n_toxic),
            ("unlabelled", F.lit(True), UNLABELLED, n_all),
            ("calibration", F.col("toxic").isNotNull(), CALIBRATION, n_marked))])
    flags = [F.coalesce(role, F.lit(False)).alias(role) for role in ("positive", "unlabelled", "calibration")]
    roles = roles.select("key", "toxic", *flags).where("positive or unlabelled or calibration").dropDuplicates(["key"])

    @F.arrow_udf("binary")
    def buckets_of(column: pa.Array) -> pa.Array:
        out = []
        for _, n, rows, buckets in _buckets(column):
            edges = np.searchsorted(rows, np.arange(n + 1))
            out += [buckets[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:])]
        return pa.array(out, pa.binary())

    # At most some POSITIVES + UNLABELLED + CALIBRATION keys: the texts don't shuffle to be sampled.
    names = ["positive", "unlabelled", "calibration"]
    sample = written(base.dropna(subset=["key"]).join(F.broadcast(roles), "key")
                     .select("toxic", *names, buckets_of("text").alias("buckets")), "toxicity-sample")
    in_p, in_u = _texts_with(sample)
    n_p, n_u = sample.agg(*[F.count(F.when(F.col(name), 1)) for name in names[:2]]).first()
    # Half the bound that training sets, as a fold's own counts differ from the sample's.
    near = np.zeros(BUCKETS, dtype=bool)
    near[_most_typical(_typical(in_p, n_p, in_u, n_u), LEAST_TYPICAL / 2)] = True

    @F.arrow_udf("binary")
    def near_of(column: pa.Array) -> pa.Array:
        own = (np.frombuffer(b.as_buffer(), dtype="<i4") for b in column)
        return pa.array([part[near[part]].tobytes() for part in own], pa.binary())

    found = sample.select("toxic", *names, near_of("buckets").alias("buckets")).toArrow()
    if not found.num_rows:
        return ToxicityModel(np.zeros(BUCKETS), 0.0)
    found = found.sort_by([(name, "ascending") for name in ("buckets", "toxic", *names)])  # the same start for any order of arrival
    parts = [np.frombuffer(b, dtype="<i4") for b in found["buckets"].to_pylist()]
    role = {name: np.flatnonzero(found[name].to_numpy()) for name in names}
    marked = found["toxic"].to_numpy()[role["calibration"]] == 1
    del found
    rows, buckets = np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate(parts).astype(np.int64)
    prior = n_toxic / max(1, n_marked)
    # Calibrated on margins of texts that the classifier hasn't seen: one of FOLDS parts is left out at a time.
    part = np.random.default_rng(3).permutation(len(parts)) % FOLDS
    margins = np.zeros(len(parts))
    for k in range(FOLDS):
        seen = {name: own[part[own] != k] for name, own in role.items()}
        left_out = part[rows] == k
        without = train_nnpu(rows[~left_out], buckets[~left_out], seen["positive"], seen["unlabelled"], prior)
        margins += without.margins(rows[left_out], buckets[left_out], len(parts)) * (part == k)
    model = train_nnpu(rows, buckets, role["positive"], role["unlabelled"], prior)
    model.slope, model.shift = calibrate(margins[role["calibration"]], marked)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: probability 0 to 1 that the whole text is toxic.

    Null and empty texts get the score of a text without typical words. With
    nothing to learn from every score is 0.5 (no rows) or the class prior. An
    existing column ``out`` is replaced.
    """
    ship_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return shipped.value.score(column)

    return docs.withColumn(out, scored(F.col(text)))
