"""Exact inner-product search with a vector-approximation file.

Each component is quantised to one of ``CELLS`` cells of its dimension, one
byte. A scan of the cells gives a lower and an upper bound of every query's
score with every vector; only vectors whose upper bound reaches the query's
kth lower bound stay candidates. Their exact vectors are read in the order of
their upper bounds: a first run of them gives a kth score, then every other
candidate whose upper bound reaches it is read, and the result is certain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.shared import ship_package, written

CELLS = 256
VECTOR_BLOCK = 4096     # vectors and queries that one task of the scan compares
QUERY_BLOCK = 2048
QUERY_SLICE = 64        # queries whose bounds are in memory at once
FIRST_READ = 4          # the first run reads so many times k vectors of a query


def whole_vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``(id, dim, v)``: floor(scale * component) of the vectors without null or non-finite components, equal rows once."""
    finite = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (table.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
            .select(F.col(key).alias("id"), F.size(vector).alias("dim"),
                    F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v")).distinct())


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _cells(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: least value and width of a cell, for each dimension. Two numbers a dimension reach the driver."""
    ranges = (vectors.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at")
              .agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("dim", "at").collect())
    out: dict[int, list] = {}
    for r in ranges:
        out.setdefault(r["dim"], []).append((r["low"], -(-(r["high"] - r["low"] + 1) // CELLS)))
    return {dim: (np.array([x[0] for x in own]), np.array([x[1] for x in own])) for dim, own in out.items()}


def exact_top_k(table: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding",
                scale: int = 256) -> DataFrame:
    """``(query_id, rank, id, score)``: each query's ``k`` best other rows by integer inner product.

    ``queries`` says which rows are queries; every other row is a candidate of
    a query, equal vectors included. Ties go to the smaller id; fewer than k
    candidates give fewer rows. Rows with a null id, a null vector or null or
    non-finite components take no part; vectors are compared with those of
    their own length. Scores must fit 64 bits. Of many equal vectors only the
    k + 1 smallest ids can be results, so the others aren't candidates.
    Rows that repeat an id and its scaled vector count once, as queries and as
    candidates. An id with several vectors has a row for each: as a candidate
    each can be a result, as a query their results are ranked together.
    """
    spark = table.sparkSession
    ship_package(spark)
    vectors = written(whole_vectors(table, key, vector, scale), "vectors")
    asked = written(whole_vectors(table.where(queries), key, vector, scale), "queries")
    same = Window.partitionBy("dim", "v").orderBy("id")
    found = vectors.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")
    cells = _cells(vectors)
    shipped = spark.sparkContext.broadcast(cells)

    @F.arrow_udf("binary")
    def quantised(dim: pa.Array, v: pa.Array) -> pa.Array:
        out = []
        for d, x in zip(dim.to_pylist(), v):
            low, width = shipped.value.get(d, (np.zeros(0, int), np.ones(0, int)))
            out.append(((np.array(x.as_py(), dtype=np.int64) - low) // width).astype(np.uint8).tobytes())
        return pa.array(out, pa.binary())

    approximations = written(found.select("id", "dim", quantised("dim", "v").alias("code")), "approximations")
    n_blocks = max(1, -(-approximations.count() // VECTOR_BLOCK))
    n_query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = lambda of, n: F.pmod(F.xxhash64(of), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    scanned = approximations.select("dim", dealt("id", n_blocks).alias("block"), every(n_query_blocks).alias("query_block"), "id", "code")
    asking = asked.select("dim", every(n_blocks).alias("block"), dealt("id", n_query_blocks).alias("query_block"), F.col("id").alias("query_id"), "v")

    def bounds(block: pa.Table, query_block: pa.Table) -> pa.Table:
        """The block's candidates of each query: upper bound at least the kth lower bound within the block."""
        schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])
        if not len(block) or not len(query_block):
            return schema.empty_table()
        dim = block["dim"][0].as_py()
        ids, query_ids = block["id"].to_numpy(), query_block["query_id"].to_numpy()
        low, width = shipped.value.get(dim, (np.zeros(0, int), np.ones(0, int)))
        code = np.frombuffer(b"".join(block["code"].to_pylist()), dtype=np.uint8).reshape(len(ids), dim)
        floor = (low + code * width).astype(np.float64)
        # Twice the cell's middle and its extent, so that both stay whole numbers.
        middle, extent = 2 * floor + (width - 1), (width - 1).astype(np.float64)
        q_all = _matrix(query_block["v"], dim).astype(np.float64)
        parts = []
        for at in range(0, len(query_ids), QUERY_SLICE):
            q, own = q_all[at:at + QUERY_SLICE], query_ids[at:at + QUERY_SLICE]
            centre, radius = q @ middle.T, (np.abs(q) @ extent)[:, None]
            slack = 1e-12 * (np.abs(q) @ np.abs(middle).T)  # rounding, should sums pass 2**53
            lower, upper = (centre - radius - slack) / 2, (centre + radius + slack) / 2
            itself = own[:, None] == ids[None, :]
            lower[itself], upper[itself] = -np.inf, -np.inf
            kth = np.partition(lower, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(own), -np.inf)
            r, c = np.nonzero((upper >= kth[:, None]) & ~itself)
            parts.append(pa.table([own[r], ids[c], lower[r, c], upper[r, c]], schema=schema))
        return pa.concat_tables(parts)

    keys = ["dim", "block", "query_block"]
    candidates = written(scanned.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(
        bounds, "query_id long, id long, lower double, upper double"), "candidates")
    kth_lower = (candidates.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("lower"), "id")))
                 .where(F.col("place") == k).select("query_id", F.col("lower").alias("least")))
    reached = candidates.join(kth_lower, "query_id", "left").where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    order = Window.partitionBy("query_id").orderBy(F.desc("upper"), "id")
    # A pair of ids once, though either may have several vectors: their exact scores are all read together.
    pairs_reached = reached.groupBy("query_id", "id").agg(F.max("upper").alias("upper"))
    ordered = written(pairs_reached.withColumn("place", F.row_number().over(order)), "ordered")

    @F.arrow_udf("long")
    def product(q: pa.Array, v: pa.Array) -> pa.Array:
        return pa.array([int(np.dot(np.array(a.as_py(), dtype=object), np.array(b.as_py(), dtype=object)) or 0)
                         if _wide(a, b) else int(np.dot(a.values.to_numpy(), b.values.to_numpy())) for a, b in zip(q, v)], pa.int64())

    def exact(pairs: DataFrame) -> DataFrame:
        q = asked.select(F.col("id").alias("query_id"), "dim", F.col("v").alias("q"))
        return pairs.join(q, "query_id").join(vectors, ["id", "dim"]).select("query_id", "id", product("q", "v").alias("score"))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    first = written(exact(ordered.where(F.col("place") <= FIRST_READ * k)), "first-read")
    kth = (first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
           .select("query_id", F.col("score").alias("kth")))
    rest = (ordered.where(F.col("place") > FIRST_READ * k).join(kth, "query_id", "left")
            .where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))).select("query_id", "id"))
    scored = first.unionByName(exact(rest))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _wide(a: pa.Scalar, b: pa.Scalar) -> bool:
    """Whether a product of these vectors might pass 64 bits on the way."""
    x, y = a.values.to_numpy(), b.values.to_numpy()
    return len(x) > 0 and float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * len(x) >= 2.0 ** 62
