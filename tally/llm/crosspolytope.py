"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform)
turns each unit vector; the nearest signed axis is its bucket in a table. A
query probes, in every table, the buckets of its best axes; what it meets there
is ranked by the exact inner product. Buckets are dealt in blocks of
vectors and blocks of queries, so neither a crowded bucket nor one that
all queries probe is one task's work.

The hash needs no fitting; the number of probes is: a bounded sample of queries
is compared with every vector, and each of their true neighbours tells the
probe that would have met it. The least number of probes that reaches the
wanted recall on the sample is taken, at every size of the table alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.shared import hash_share, ship_package, written
from tally.llm.textvec import random_words

TABLES = 8
ROUNDS = 3
SAMPLE = 256          # queries that the probes are fitted on
WANTED_RECALL = 0.96  # on the sample
BLOCK = 1024          # vectors, and queries, of one bucket that meet in one task
FULL_BUCKET = 4096    # vectors of a bucket on average beyond which a table joins two hashes
PAIRS = 1 << 20       # products in memory at once


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis, its length a power of two; keeps lengths of vectors."""
    n = x.shape[-1]
    h = 1
    while h < n:
        pairs = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(x.shape)
        h *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, seed: int) -> np.ndarray:
    """The vectors padded to a power of two and turned by pseudo-rotation number ``seed``."""
    n, dim = unit.shape
    width = 1 << max(0, (dim - 1).bit_length())
    out = np.zeros((n, width))
    out[:, :dim] = unit
    signs = np.where(random_words(1 + seed, ROUNDS * width) >> np.uint64(63), 1.0, -1.0).reshape(ROUNDS, width)
    for s in signs:
        out = hadamard(out * s)
    return out


def axis_scores(vectors: np.ndarray, table: int, hashes: int) -> list[np.ndarray]:
    """Of each hash of a table, each vector's product with every signed axis: first the positive axes, then the negative ones."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = (rotated(unit, table * 1000 + h) for h in range(hashes))
    return [np.concatenate([y, -y], axis=1) for y in turned]


def buckets_of(vectors: np.ndarray, table: int, hashes: int) -> np.ndarray:
    """The bucket of each vector: its nearest signed axis, for two hashes both."""
    code = np.zeros(len(vectors), dtype=np.int64)
    for scores in axis_scores(vectors, table, hashes):
        code = code * scores.shape[1] + scores.argmax(axis=1)
    return code


def probe_order(queries: np.ndarray, table: int, hashes: int, probes: int | None = None) -> np.ndarray:
    """Buckets of each query, most promising first: by the sum of the products with their axes, ties by number."""
    first, *rest = axis_scores(queries, table, hashes)
    total = first
    for scores in rest:
        total = (total[:, :, None] + scores[:, None, :]).reshape(len(queries), -1)
    return np.argsort(-total, axis=1, kind="stable")[:, :probes]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _by_dim(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, matrix) of the vectors of each length in a batch."""
    dims = batch["dim"].to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield int(dim), rows, _matrix(batch[column].take(pa.array(rows)), int(dim))


def usable_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, dim, v)`` of the vectors without null or non-finite components and not zero; equal rows once."""
    whole = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    # A zero beside a negative zero is one value.
    plain = F.transform(vector, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    return (table.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & whole & F.exists(vector, lambda x: x != 0))
            .select(F.col(key).alias("id"), F.size(vector).alias("dim"), plain.alias("v")).distinct())


def _best(products: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the entries that can be among each row's ``k`` best, rounding allowed for."""
    if products.shape[1] <= k:
        return np.nonzero(np.isfinite(products))
    least = np.partition(products, -k, axis=1)[:, -k]
    slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
    return np.nonzero((products >= (least - slack)[:, None]) & np.isfinite(products))


def _exact(q: np.ndarray, v: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products of pairs, each summed in the same order wherever it is computed."""
    return (q[rows] * v[columns]).sum(axis=1) if len(rows) else np.zeros(0)


def _compared(q: np.ndarray, query_ids: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, vector row, score) of each query's ``k`` best vectors other than those of its own id."""
    out = []
    step = max(1, PAIRS // max(1, len(ids)))
    for at in range(0, len(q), step):
        products = q[at:at + step] @ v.T
        products[query_ids[at:at + step, None] == ids[None, :]] = -np.inf
        r, c = _best(products, ids, k)
        score = _exact(q, v, r + at, c)
        order = np.lexsort((ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        out.append((r[keep] + at, c[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def neighbour_probes(vectors: DataFrame, asked: DataFrame, hashes: int, k: int) -> list[int]:
    """Of the ``k`` true neighbours of at most about ``SAMPLE`` queries, the least probe of any table that meets each.

    Every vector is compared with the sample; each task keeps the ``k`` best of a query.
    """
    spark = vectors.sparkSession
    sample = asked.where(hash_share(F.col("id"), SAMPLE, asked.count())).orderBy(F.xxhash64("id"), "id").limit(2 * SAMPLE).collect()
    of_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in sample}:
        own = [r for r in sample if r["dim"] == dim]
        of_dim[dim] = np.array([r["id"] for r in own], dtype=np.int64), np.array([r["v"] for r in own], dtype=np.float64)
    shared = spark.sparkContext.broadcast(of_dim)

    def nearest(batches):
        places = {d: [np.argsort(probe_order(q, t, hashes), axis=1).astype(np.int32) for t in range(TABLES)] for d, (_, q) in shared.value.items()}
        for batch in batches:
            for dim, rows, v in _by_dim(batch, "v"):
                if dim not in shared.value:
                    continue
                query_ids, q = shared.value[dim]
                ids = batch["id"].to_numpy()[rows]
                r, c, score = _compared(q, query_ids, v, ids, k)
                probe = np.min([places[dim][t][r, buckets_of(v, t, hashes)[c]] for t in range(TABLES)], axis=0)
                yield pa.record_batch([pa.array(query_ids[r]), pa.array(ids[c]), pa.array(score), pa.array(probe.astype(np.int64))],
                                      names=["query_id", "id", "score", "probe"])

    met = vectors.mapInArrow(nearest, "query_id long, id long, score double, probe long")
    met = met.groupBy("query_id", "id", "score").agg(F.min("probe").alias("probe"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return [r["probe"] for r in met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("probe").collect()]


def fitted_probes(neighbours: list[int], wanted: float) -> int:
    """The least number of probes that meets the wanted share of the sampled neighbours; one if there are none."""
    if not neighbours:
        return 1
    return int(np.sort(neighbours)[max(0, int(np.ceil(wanted * len(neighbours))) - 1)]) + 1


def nearest_neighbours(table: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding",
                       wanted: float = WANTED_RECALL, probes: int | None = None) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest other rows found of each query, by largest inner product in doubles.

    ``queries`` says which rows are queries. Ties go to the smaller id; fewer
    than k candidates met give fewer rows. Rows with a null id, a null or zero
    vector, or null or non-finite components take no part; vectors are
    compared with those of their own length. Rows that repeat an id and vector
    count once; an id with several vectors has a row for each, of which equal
    scores count once. Of many equal vectors only the k + 1 smallest ids can be
    results, so the others aren't indexed. ``probes``, the buckets a query
    reads in each table, are fitted to the recall ``wanted`` unless given; a
    table with few vectors needs most buckets, all of them give the exact result.
    """
    spark = table.sparkSession
    ship_package(spark)
    vectors = written(usable_vectors(table, key, vector), "vectors")
    asked = written(usable_vectors(table.where(queries), key, vector), "queries")
    same = Window.partitionBy("dim", "v").orderBy("id")
    indexed = written(vectors.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy"), "indexed")
    n, width = indexed.agg(F.count("*"), F.max("dim")).first()
    axes = 2 << max(0, ((width or 1) - 1).bit_length())
    hashes = 1 if (n or 0) <= FULL_BUCKET * axes else 2
    if probes is None:
        probes = fitted_probes(neighbour_probes(indexed, asked, hashes, k), wanted)

    def in_tables(batches):
        for batch in batches:
            for dim, rows, v in _by_dim(batch, "v"):
                for t in range(TABLES):
                    own = batch.take(pa.array(rows))
                    yield pa.record_batch([*own.columns, pa.array(np.full(len(rows), t)), pa.array(buckets_of(v, t, hashes))],
                                          names=["id", "dim", "v", "table", "bucket"])

    def probing(batches):
        for batch in batches:
            for dim, rows, v in _by_dim(batch, "v"):
                own = batch.take(pa.array(rows))
                for t in range(TABLES):
                    order = probe_order(v, t, hashes, probes)
                    for at in range(order.shape[1]):
                        yield pa.record_batch([*own.columns, pa.array(np.full(len(rows), t)), pa.array(order[:, at])],
                                              names=["id", "dim", "v", "table", "bucket"])

    kind = "id long, dim int, v array<double>, table long, bucket long"
    index = written(indexed.mapInArrow(in_tables, kind), "index")
    probed = written(asked.mapInArrow(probing, kind), "probed")

    # Blocks: a bucket's vectors, and the queries that probe it, are dealt by hash to as many as they fill.
    at = ["dim", "table", "bucket"]
    sized = lambda df, name: df.groupBy(*at).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    plan = written(sized(index, "blocks").join(sized(probed, "query_blocks"), at), "plan")
    one_of = lambda c: F.pmod(F.xxhash64("id", "v"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = index.join(plan, at).select(*at, one_of("blocks").alias("block"), every("query_blocks").alias("query_block"), "id", "v")
    asking = probed.join(plan, at).select(*at, every("blocks").alias("block"), one_of("query_blocks").alias("query_block"), F.col("id").alias("query_id"), "v")

    def compare(block: pa.Table, query_block: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
        if not len(block) or not len(query_block):
            return schema.empty_table()
        dim = block["dim"][0].as_py()
        ids, query_ids = block["id"].to_numpy(), query_block["query_id"].to_numpy()
        r, c, score = _compared(_matrix(query_block["v"], dim), query_ids, _matrix(block["v"], dim), ids, k)
        return pa.table([query_ids[r], ids[c], score], schema=schema)

    keys = [*at, "block", "query_block"]
    met = dealt.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(compare, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    once = met.groupBy("query_id", "id", "score").agg(F.lit(1).alias("met"))  # several tables meet the same pair
    return (once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
