"""Quality: random-indexing word vectors pooled per document, then a two-layer network.

Each word has a fixed sparse random index vector; its word vector is the sum
of the index vectors of its neighbours over all documents, added up by Spark.
A document is the mean of its word vectors and a few shares of odd words. The
network's probabilities are calibrated by a temperature on rows held back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.shared import hash_share, ship_package
from tally.llm.textvec import Texts, mix, texts_of

WORDS = 1 << 15       # hashed vocabulary
DIM = 32              # length of the vectors
NONZERO = 4           # entries of +1 or -1 in an index vector
WINDOW = 2            # neighbours on each side
SHARES = 6            # of a document, besides its mean vector
SAMPLE = 12_000       # bound of the labelled sample that reaches the driver
HIDDEN, EPOCHS, RATE, RIDGE = 24, 400, 0.02, 1e-3
_TRIPLE = np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(place, sign) of the non-zero entries of each word's index vector, from the word's number."""
    h = mix(np.arange(WORDS * NONZERO, dtype=np.uint64) + np.uint64(12345)).reshape(WORDS, NONZERO)
    return (h % np.uint64(DIM)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int64)


def _tokens(x: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, word number, is a letter run, hash) of the runs of letters and of other signs, in order."""
    d = x.data
    letter = ((d >= 97) & (d <= 122)) | ((d >= 65) & (d <= 90)) | (d >= 128)
    kind = np.where((d == 32) | ((d >= 9) & (d <= 13)), 0, np.where(letter, 1, 2))
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    start = edge[kind[edge] > 0]
    end = np.append(edge, len(d))[np.searchsorted(edge, start) + 1]
    h = x.span_hash(x.prefix_hash(), start, end)
    return x.row_of(start), (h & np.uint64(WORDS - 1)).astype(np.int64), kind[start] == 1, h


def _shares(x: Texts, row: np.ndarray, is_word: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Per text: shares of signs, of capitals, of words that repeat the one before, of word triples seen before; lengths."""
    n_tokens = np.bincount(row, minlength=x.n)
    d = x.data
    upper, lower = ((d >= 65) & (d <= 90)), ((d >= 97) & (d <= 122))
    total = lambda mask: np.add.reduceat(np.append(mask, False).astype(np.int64), np.stack([x.start, x.end], 1).ravel())[::2] * (x.end > x.start)
    capitals = total(upper) / np.maximum(1, total(upper | lower))
    w_row, w = row[is_word], h[is_word]
    n_words = np.bincount(w_row, minlength=x.n)
    same = np.flatnonzero((w_row[1:] == w_row[:-1]) & (w[1:] == w[:-1]))
    doubled = np.bincount(w_row[same], minlength=x.n) / np.maximum(1, n_words)
    again = np.zeros(x.n)
    if len(w) > 2:
        whole = w_row[2:] == w_row[:-2]
        t_row, t = w_row[2:][whole], mix((w[:-2] * _TRIPLE + w[1:-1]) * _TRIPLE + w[2:])[whole]
        order = np.lexsort((t, t_row))
        t_row, t = t_row[order], t[order]
        repeat = np.flatnonzero((t_row[1:] == t_row[:-1]) & (t[1:] == t[:-1]))
        again = np.bincount(t_row[repeat], minlength=x.n) / np.maximum(1, n_words)
    signs = (n_tokens - n_words) / np.maximum(1, n_tokens)
    return np.stack([signs, capitals, doubled, again, np.log1p(n_words) / 10, (n_words == 0).astype(float)], axis=1)


def neighbour_sums(column: pa.Array, sums: np.ndarray) -> None:
    """Add to ``sums`` (word, dimension) the index vectors of each word's neighbours."""
    place, sign = index_vectors()
    for x in texts_of(column):
        row, word, *_ = _tokens(x)
        for gap in range(1, WINDOW + 1):
            near = row[gap:] == row[:-gap]
            left, right = word[:-gap][near], word[gap:][near]
            for a, b in ((left, right), (right, left)):
                at = (a[:, None] * DIM + place[b]).ravel()
                sums += np.bincount(at, weights=sign[b].ravel(), minlength=WORDS * DIM).astype(np.int64).reshape(WORDS, DIM)


def fit_word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit word vectors from all ``docs``: each task adds up its own texts, Spark adds the tasks' sums.

    The result has ``WORDS`` rows of ``DIM`` numbers (4 MB) for any input.
    """
    ship_package(docs.sparkSession)

    def partial(batches):
        sums = np.zeros((WORDS, DIM), dtype=np.int64)
        for batch in batches:
            neighbour_sums(batch.column(0), sums)
        own = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), *(pa.array(sums[own, i]) for i in range(DIM))], names=["word", *(f"d{i}" for i in range(DIM))])

    schema = "word long, " + ", ".join(f"d{i} long" for i in range(DIM))
    added = docs.select(text).mapInArrow(partial, schema).groupBy("word").agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(DIM)])
    found = added.toArrow()
    vectors = np.zeros((WORDS, DIM), dtype=np.float32)
    if found.num_rows:
        values = np.stack([found[f"d{i}"].to_numpy() for i in range(DIM)], axis=1).astype(float)
        vectors[found["word"].to_numpy()] = values / np.maximum(1e-9, np.linalg.norm(values, axis=1, keepdims=True))
    return vectors


def pooled(column: pa.Array, vectors: np.ndarray) -> Iterator[np.ndarray]:
    """Mean word vector and shares, one row for each text, run by run."""
    for x in texts_of(column):
        row, word, is_word, h = _tokens(x)
        mean = np.zeros((x.n, DIM))
        # Equal words of a text are looked up once.
        pairs, count = np.unique(row * WORDS + word, return_counts=True)
        p_row, p_word = pairs // WORDS, pairs % WORDS
        for at in range(0, len(pairs), 1 << 17):
            own = slice(at, at + (1 << 17))
            values = vectors[p_word[own]] * count[own, None]
            begin = np.flatnonzero(np.diff(p_row[own], prepend=-1))
            mean[p_row[own][begin]] += np.add.reduceat(values, begin, axis=0)
        mean /= np.maximum(1, np.bincount(row, minlength=x.n))[:, None]
        yield np.concatenate([mean, _shares(x, row, is_word, h)], axis=1)


@dataclass
class QualityModel:
    """Word vectors, input scaling, two layers and a temperature."""

    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        return np.tanh((inputs - self.centre) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, column: pa.Array) -> pa.Array:
        z = [self.logits(x) for x in pooled(column, self.vectors)]
        z = np.concatenate([*z, np.zeros(0)]) / self.temperature
        return pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def _log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train_network(vectors: np.ndarray, x: np.ndarray, y: np.ndarray) -> QualityModel:
    """Two layers by Adam from a fixed start; every fifth row is held back for the temperature.

    The temperature is the one of least log loss on those rows, plus the square of
    its logarithm for all of them together, which holds it near 1 while rows are
    few and weighs nothing when they are many. Fewer than five rows hold none back.
    """
    rng = np.random.default_rng(17)
    held = np.arange(len(y)) % 5 == 4
    a, t = x[~held], y[~held]
    centre, spread = a.mean(axis=0), a.std(axis=0) + 1e-3
    n_in = x.shape[1]
    prior = np.clip(t.mean(), 0.01, 0.99)
    theta = [rng.normal(0, 1 / np.sqrt(n_in), (n_in, HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array(np.log(prior / (1 - prior)))]
    first, second = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    s = (a - centre) / spread
    for step in range(1, EPOCHS + 1):
        hidden = np.tanh(s @ theta[0] + theta[1])
        z = hidden @ theta[2] + theta[3]
        e = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - t) / len(t)
        back = e[:, None] * theta[2] * (1 - hidden ** 2)
        grads = [s.T @ back + RIDGE * theta[0], back.sum(axis=0), hidden.T @ e + RIDGE * theta[2], np.array(e.sum())]
        for i, g in enumerate(grads):
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
            theta[i] = theta[i] - RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    model = QualityModel(vectors, centre, spread, theta[0], theta[1], theta[2], float(theta[3]))
    if held.any():
        z = model.logits(x[held])
        model.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda c: _log_loss(z / c, y[held]) + np.log(c) ** 2 / held.sum()))
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", key: str = "doc_id",
                quality: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Word vectors from all ``docs``; the network from at most about ``sample`` labelled rows where ``train`` holds.

    Only ``key`` and ``quality`` of ``labels`` are read, under names of their own: other columns clash
    with nothing. A key labelled twice counts as good if one of its labels is.
    """
    vectors = fit_word_vectors(docs, text)
    shipped = docs.sparkSession.sparkContext.broadcast(vectors)
    base = docs.where(train).select(F.col(key).alias("key"), F.col(text).alias("text"))
    marks = (labels.select(F.col(key).alias("marked"), F.col(quality).alias("quality"))
             .where("marked is not null and quality in (0, 1)").groupBy("marked").agg(F.max("quality").alias("quality")))
    total = marks.count()
    marks = marks.where(hash_share(F.col("marked"), sample, total))

    @F.arrow_udf("binary")
    def inputs(column: pa.Array) -> pa.Array:
        rows = np.concatenate([*pooled(column, shipped.value), np.zeros((0, DIM + SHARES))])
        return pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary())

    # About ``sample`` keys at most are broadcast: the texts don't shuffle to be sampled.
    found = (base.join(F.broadcast(marks), F.col("key") == F.col("marked"))
             .select("key", "quality", inputs("text").alias("inputs")).toArrow().sort_by([("key", "ascending"), ("inputs", "ascending")]))
    n_in = DIM + SHARES
    if not found.num_rows:
        return QualityModel(vectors, np.zeros(n_in), np.ones(n_in), np.zeros((n_in, 1)), np.zeros(1), np.zeros(1), 0.0)
    x = np.stack([np.frombuffer(b, dtype="<f4") for b in found["inputs"].to_pylist()]).astype(float)
    return train_network(vectors, x, found["quality"].to_numpy().astype(float))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: probability 0 to 1 that the whole text is of good quality.

    Null and empty texts are scored as texts without words; without labelled
    rows every score is 0.5. An existing column ``out`` is replaced.
    """
    ship_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return shipped.value.score(column)

    return docs.withColumn(out, scored(F.col(text)))
