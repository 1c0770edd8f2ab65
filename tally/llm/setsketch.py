"""Near-duplicate documents by SetSketch registers.

A register holds the exponentially spaced, truncated minimum of a hash over a
document's word shingles: ``floor(1 - log_b(min h))`` of exponential hashes.
Registers of two documents agree the more often the more their sets overlap,
and the registers of a union are the register-wise maxima.

Documents with equal sets form a class with one representative. Bands of
registers bring representatives together; in each bucket all are compared
with one hub. A pair is first judged by the maximum-likelihood estimate of its
similarity from the registers, then confirmed on the full sets. Only where a
bucket still holds several components, documents of different ones are
compared, by their hashed sets inside a join in blocks; the links found go the same way.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.components import connected_components
from tally.llm.exact_dedup import flag_members
from tally.llm.shared import ship_package, written
from tally.llm.textvec import mix, random_words, texts_of

BANDS, ROWS = 30, 5                      # at similarity 0.8 a pair misses all bands once in 150,000
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1   # 16-bit registers, good for sets of up to 10**18
ESTIMATE_MARGIN = 0.2                    # pairs estimated this far below the threshold are not confirmed (6 sigma)
BITS, BIT_SIGMA = 1024, 5                # registers of which one bit each is kept for pairs across components (misses 3 in 10**7)
BIT_WORDS = [f"bits_{i}" for i in range(BITS // 64)]
BUCKET_BLOCK = 256                       # documents of a bucket that one task compares with as many
_K = np.uint64(0xD6E8FEB86659FD93)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@lru_cache(maxsize=1)
def _seeds() -> tuple[np.ndarray, np.ndarray]:
    return random_words(101, REGISTERS), random_words(202, REGISTERS) | np.uint64(1)


def _shingle_hashes(x, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, in order; a shorter text is one shingle."""
    start, end = x.words()
    word, row = x.span_hash(x.prefix_hash(), start, end), x.row_of(start)
    n = len(word)
    count = np.bincount(row, minlength=x.n)
    rows, hashes = [], []
    if n >= shingle:
        whole = row[:n - shingle + 1] == row[shingle - 1:]
        h = word[:n - shingle + 1].copy()
        for j in range(1, shingle):
            h = h * _K + word[j:n - shingle + 1 + j]
        rows.append(row[:n - shingle + 1][whole])
        hashes.append(mix(h[whole]))
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    for k in range(1, shingle):
        own = np.flatnonzero(count == k)
        h = np.full(len(own), np.uint64(k))
        for j in range(k):
            h = h * _K + word[first[own] + j]
        rows.append(own)
        hashes.append(mix(h))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[fresh], hashes[fresh]


@lru_cache(maxsize=1)
def _bit_seeds() -> tuple[np.ndarray, np.ndarray]:
    return random_words(303, BITS), random_words(404, BITS) | np.uint64(1)


def _registers(hashes: np.ndarray, starts: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One row of registers, one for each seed, for each run of hashes that begins at ``starts``."""
    low = np.empty((len(starts), len(seeds[0])), dtype=np.uint64)
    for i, (flip, factor) in enumerate(zip(*seeds)):
        low[:, i] = np.minimum.reduceat((hashes ^ flip) * factor, starts)
    uniform = (low.astype(np.float64) + 0.5) / 2.0 ** 64
    value = np.floor(1.0 - np.log(-np.log1p(-np.minimum(uniform, 1 - 1e-12)) / RATE) / np.log(BASE))
    return np.clip(value, 0, TOP).astype("<u2")


def sketch_column(column: pa.Array, shingle: int) -> pa.Array:
    sizes, digests, registers = [], [], []
    for x in texts_of(column):
        rows, hashes = _shingle_hashes(x, shingle)
        size = np.bincount(rows, minlength=x.n)
        sizes.append(size)
        edge = np.concatenate([[0], np.cumsum(size)])
        filled = np.flatnonzero(size)
        own = iter(_registers(hashes, edge[filled], _seeds())) if len(filled) else iter(())
        for i in range(x.n):
            if size[i]:
                digests.append(blake2b(hashes[edge[i]:edge[i + 1]].tobytes(), digest_size=16).digest())
                registers.append(next(own).tobytes())
            else:
                digests.append(None)
                registers.append(None)
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate([*sizes, np.zeros(0)]).astype(np.int64)),
         pa.array(digests, pa.binary()), pa.array(registers, pa.binary())],
        names=["n_shingles", "set_digest", "registers"])


def with_sketch(docs: DataFrame, text: str, shingle: int, out: str) -> DataFrame:
    """``docs`` with a struct ``out`` of ``n_shingles, set_digest, registers`` (null for an empty set)."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("n_shingles long, set_digest binary, registers binary")
    def sketched(column: pa.Array) -> pa.Array:
        return sketch_column(column, shingle)

    return docs.withColumn(out, sketched(F.col(text)))


def _p(x: np.ndarray) -> np.ndarray:
    """Chance that a register of one set is above the other's, for its surplus ``x`` of the sizes."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def estimate_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of sets of known sizes from their registers (one row each)."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u

    def likelihood(j):
        up, down = np.maximum(_p(u - v * j), 1e-12), np.maximum(_p(v - u * j), 1e-12)
        return above * np.log(up) + below * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak: ternary search
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(len(column), REGISTERS)


def _shingle_set(text: bytes, shingle: int) -> set:
    words = text.translate(_LOWER).split()
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(shingle))))


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``id`` is in the written table ``ids``; few others shuffle."""
    flagged = flag_members(df, "id", ids, "id", "maybe_needed").where("maybe_needed").drop("maybe_needed")
    return flagged.join(ids, "id", "left_semi")


def _confirm(pairs: DataFrame, sets: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are similar, written: by estimate first, then by their texts' full sets.

    ``pairs``: a written table; ``sets``: id, n_shingles, registers; ``docs``:
    id, text. A hub stands in column a of many pairs; its registers and text
    cross the network once.
    """
    named = lambda df, side, **columns: df.select(F.col("id").alias(side), *[F.col(c).alias(n) for n, c in columns.items()])
    least = percent / 100 - ESTIMATE_MARGIN

    @F.arrow_udf("boolean")
    def likely(r_a: pa.Array, r_b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        if not len(r_a):
            return pa.array([], pa.bool_())
        return pa.array(estimate_similarity(_matrix(r_a), _matrix(r_b), n_a.to_numpy(), n_b.to_numpy()) >= least)

    both_ends = lambda df, n: written(df.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids", 2 * n)
    n_pairs = pairs.count()
    own = _only(sets, both_ends(pairs, n_pairs))
    joined = (pairs.join(named(own, "b", n_b="n_shingles", r_b="registers"), "b")
              .join(named(own, "a", n_a="n_shingles", r_a="registers"), "a"))
    joined = joined.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    candidates = written(joined.where(likely("r_a", "r_b", "n_a", "n_b")).select("a", "b"), "candidates",
                         n_pairs)

    @F.arrow_udf("boolean")
    def similar(a: pa.Array, text_a: pa.Array, text_b: pa.Array) -> pa.Array:
        out, last, mine = [], None, set()
        for one, left, right in zip(a.to_pylist(), text_a, text_b):
            if one != last:
                last, mine = one, _shingle_set((left.as_py() or "").encode(), shingle)
            other = _shingle_set((right.as_py() or "").encode(), shingle)
            both = len(mine & other)
            out.append(both > 0 and 100 * both >= percent * (len(mine) + len(other) - both))
        return pa.array(out, pa.bool_())

    n_candidates = candidates.count()
    texts = written(_only(docs, both_ends(candidates, n_candidates)), "texts")
    confirmed = (candidates.join(named(texts, "b", t_b="text"), "b").join(named(texts, "a", t_a="text"), "a")
                 .where(similar("a", "t_a", "t_b")).select("a", "b"))
    return written(confirmed, "links", n_candidates)


def _hashed_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``id, shingles, bits_0, ..``: 64-bit hashes of a document's distinct shingles, and the lowest bits of ``BITS`` more registers."""
    @F.arrow_udf("shingles array<long>, bits array<long>")
    def hashed(column: pa.Array) -> pa.Array:
        sets, bits = [], []
        for x in texts_of(column):
            rows, values = _shingle_hashes(x, shingle)
            edges = np.searchsorted(rows, np.arange(x.n + 1))
            sets += [values[a:b].view(np.int64) for a, b in zip(edges[:-1], edges[1:])]
            own = np.zeros((x.n, BITS), dtype=np.uint8)
            filled = np.flatnonzero(np.diff(edges))
            if len(filled):
                own[filled] = _registers(values, edges[filled], _bit_seeds()) & 1
            bits += list(np.packbits(own, axis=1).view(np.int64))
        return pa.StructArray.from_arrays([pa.array(sets, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], names=["shingles", "bits"])

    words = [F.coalesce(F.get("h.bits", i), F.lit(0)).alias(c) for i, c in enumerate(BIT_WORDS)]
    return docs.select("id", hashed("text").alias("h")).select("id", "h.shingles", *words)


def _across(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that share a bucket and are similar by their hashed sets.

    ``open_``: a written table ``bucket, id, n_shingles, component``; ``sets``:
    of ``_hashed_sets``. The similarity stands in the join's condition, so a
    loose group of copies gives a row for each link, not for each pair: first
    the registers' lowest bits, which differ in ``(1 - J) / 2`` of the places
    and rule out what differs by ``BIT_SIGMA`` more than a pair at the
    threshold does, then the sets. A crowded bucket is cut into blocks of
    ``BUCKET_BLOCK`` documents, each pair of blocks a key of its own.
    """
    differ = (1 - percent / 100) / 2
    most = int(BITS * differ + BIT_SIGMA * (BITS * differ * (1 - differ)) ** 0.5)
    blocks = open_.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET_BLOCK).cast("int").alias("blocks"))
    blocks = blocks.select(F.bitwise_not("bucket").alias("key"), "blocks")
    rows = (open_.join(blocks, F.bitwise_not("bucket") == F.col("key")).join(sets, "id")
            .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    kept = ("id", "n_shingles", "component", "shingles", *BIT_WORDS)
    side = lambda x, own, other, blocks: rows.select(
        "bucket", F.col("own").alias(own), F.explode(blocks).alias(other), *[F.col(c).alias(f"{c}_{x}") for c in kept])
    left = side("a", "block_a", "block_b", F.sequence(F.col("own"), F.col("blocks") - 1))
    right = side("b", "block_b", "block_a", F.sequence(F.lit(0), F.col("own")))
    least, greatest = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in BIT_WORDS])
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    similar = ((F.col("component_a") != F.col("component_b")) & ((left["block_a"] < left["block_b"]) | (F.col("id_a") < F.col("id_b")))
               & (100 * least >= percent * greatest) & (apart <= most)
               & ((100 + percent) * both >= percent * (F.col("n_shingles_a") + F.col("n_shingles_b"))))
    same = (left["bucket"] == right["bucket"]) & (left["block_a"] == right["block_a"]) & (left["block_b"] == right["block_b"])
    return left.join(right, same & similar).select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(id, n_shingles, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the least id linked through pairs with
    ``100 |A and B| >= percent |A or B|`` of their sets of word shingles. Texts
    without words have an empty set and no links. A row with a null key links
    with nothing (component null); rows that share a key are one node, and
    where their texts differ one of them is compared across components.
    """
    own = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sketches = written(with_sketch(own, "text", shingle, "s").select("id", "s.*"), "sketches")
    n = sketches.count()
    filled = sketches.where("id is not null and n_shingles > 0")
    # Grouped by the digest, joined by its text: AQE may then split a hot class.
    classes = filled.groupBy("set_digest").agg(F.min("id").alias("representative"), F.count("*").alias("members"))
    classes = classes.where("members > 1").select(F.hex("set_digest").alias("digest"), "representative")
    membership = filled.select("id", F.hex("set_digest").alias("digest")).join(classes, "digest").where("id <> representative")
    membership = written(membership.select(F.col("representative").alias("a"), F.col("id").alias("b")).distinct(), "membership", n)

    # One document of each class: those that may be members are looked up, the rest stay where they are.
    members = membership.select(F.col("b").alias("id"))
    asked = flag_members(filled.select("id", "n_shingles", "registers"), "id", members, "id", "maybe_member")
    sets = asked.where("not maybe_member").unionByName(asked.where("maybe_member").join(members, "id", "left_anti"))
    sets = written(sets.drop("maybe_member"), "sets")
    band = [F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)]
    banded = sets.select("id", "n_shingles", F.explode(F.array(*band)).alias("bucket"))
    shared = written(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "shared", BANDS * n // 2, 200_000)
    met = flag_members(banded, "bucket", shared, "bucket", "maybe_shared").where("maybe_shared").drop("maybe_shared")
    n_met = shared.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    collisions = written(met.join(shared, "bucket"), "collisions", n_met)

    # The hub of a bucket meets most others over all buckets: in a star of copies that is the original.
    company = collisions.groupBy("id").agg(F.sum("size").alias("company"))
    first = F.struct((-F.col("company")).alias("less"), F.col("id").alias("id"))
    hubs = collisions.join(company, "id").groupBy("bucket").agg(F.min(first)["id"].alias("hub"))
    hubs = hubs.select(F.bitwise_not("bucket").alias("key"), "hub")
    pairs = collisions.join(hubs, F.bitwise_not("bucket") == F.col("key")).where("id <> hub")
    star_pairs = written(pairs.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "star-pairs", n_met)
    links = _confirm(star_pairs, sets, own, shingle, percent)
    found = connected_components(links)

    # Buckets that still hold several components: links across them that weren't compared yet.
    placed = (collisions.join(found, "id", "left")
              .select("bucket", "id", "n_shingles", F.coalesce("component", "id").alias("component")))
    several = (placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .where("low <> high").select(F.bitwise_not("bucket").alias("key")))
    open_ = written(placed.join(several, F.bitwise_not("bucket") == F.col("key"), "left_semi"), "open", n_met)
    open_ids = written(open_.select("id").distinct(), "ids", open_.count())
    texts = written(_only(own, open_ids).dropDuplicates(["id"]), "texts")
    hashed = written(_hashed_sets(texts, shingle), "hashed-sets")
    new_pairs = written(_across(open_, hashed, percent), "pairs")
    more = _confirm(new_pairs, sets, texts, shingle, percent)

    if not more.isEmpty():  # the components that the new links join are few: only those are run again
        of = open_.select("id", "component").distinct()
        end = lambda side: of.select(F.col("id").alias(side), F.col("component").alias(f"component_{side}"))
        bridges = more.join(end("a"), "a").join(end("b"), "b").select("component_a", "component_b")
        joined = connected_components(written(bridges, "bridges"), "component_a", "component_b")
        joined = joined.select(F.col("id").alias("old"), F.col("component").alias("new"))
        ends = of.join(joined, F.col("component") == F.col("old")).select("id", F.col("new").alias("component"))
        grown = found.join(joined, F.col("component") == F.col("old"), "left").select("id", F.coalesce("new", "component").alias("component"))
        found = written(grown.unionByName(ends).groupBy("id").agg(F.min("component").alias("component")), "components", n)
    component_of = found.select(F.col("id").alias("node"), "component")
    # A member of a class has the component of its representative.
    of_members = membership.join(component_of, membership["a"] == component_of["node"], "left").select(
        F.col("b").alias("node"), F.coalesce("component", "a").alias("component"))
    nodes = written(component_of.unionByName(of_members), "components", n)
    return (sketches.select("id", "n_shingles").join(nodes, F.col("id") == F.col("node"), "left")
            .select("id", "n_shingles", F.coalesce("component", "id").alias("component_id")))
