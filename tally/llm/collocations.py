"""Collocated phrases from FM-indexes over word ids, one index a shard, summed over the shards.

A shard is a run of texts of one task. Its words get ids of the shard's own,
pieces are parted by id 0, and a bidirectional FM-index (one BWT of the
sequence, one of its reverse, both sorted as deep as the longest phrase)
enumerates n-grams with their counts by extending intervals: to the left in
the one, to the right in the other, each keeping its interval in the other.

First pass: 64-bit keys and counts of all words and word pairs, summed over the
shards; keys counted often enough become a Bloom bitmap (equal hashes only add
up, so no frequent phrase is missed). Second pass: each index extends only
intervals that the bitmap lets through, to the right up to three words, and
emits them as texts; their sums are exact. Scores are decimal arithmetic on
those sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.exact_dedup import filter_bits
from tally.llm.shared import ship_package, written
from tally.llm.textvec import Texts, mix, texts_of

SHARD_BYTES = 6 << 20      # text of one index: some 1 million words, up to 160 MB; one longer text is taken whole
SLICE, SLICE_BYTES = 65_536, 2 << 20     # rows written out at once, and the bytes of their phrases
NO_LANG = "und"
BITMAP_BYTES = 4096        # of Spark's bitmap functions: 32,768 slots a bucket
_K = np.uint64(0xD6E8FEB86659FD93)

#: What ends a piece, and what parts words.
_PIECE_END = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_BETWEEN = _PIECE_END | np.isin(np.arange(256), list(b" \t"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _stable_order(values: np.ndarray) -> np.ndarray:
    """``argsort(values, kind="stable")`` of 32-bit values from 0, in 32 bits: value and place sort as one word, in place."""
    packed = np.left_shift(values, 32, dtype=np.int64)
    packed += np.arange(len(values), dtype=np.int32)
    packed.sort()
    return packed.astype(np.int32)  # the places, the lower halves


class Bwt:
    """Burrows-Wheeler transform of a circular sequence of 32-bit symbols, its rows sorted by their first ``depth`` symbols.

    Intervals of patterns of up to ``depth`` symbols are those of the full transform.
    """

    def __init__(self, symbols: np.ndarray, depth: int):
        order = _stable_order(symbols)
        for _ in range(depth - 1):  # one LF step sorts by one more symbol in front
            order -= 1
            order = order[_stable_order(symbols[order])]
        order %= len(symbols)
        self.order = order
        self.bwt = symbols[order - 1]
        self.rows = _stable_order(self.bwt)  # LF maps rows[j] to j: symbols before it plus the symbol's rank

    def extend(self, low: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """Extensions of disjoint intervals by one symbol in front: (parent, symbol, low, size, other).

        ``other`` is where each interval begins in the transform of the
        reversed sequence; the symbol 0 extends nothing.
        """
        inside = np.repeat((low - (np.cumsum(size) - size)).astype(np.int32), size)
        inside += np.arange(len(inside), dtype=np.int32)
        label = np.full(len(self.bwt), -1, dtype=np.int32)
        label[inside] = np.repeat(np.arange(len(low), dtype=np.int32), size)
        del inside
        parent, symbol = label[self.rows], self.bwt[self.rows]
        del label
        at = np.flatnonzero((parent >= 0) & (symbol > 0)).astype(np.int32)
        parent, symbol = parent[at], symbol[at]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(at)), bool), (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])]))
        count = np.diff(np.append(first, len(at))).astype(np.int32)
        parent, symbol, new_low = parent[first], symbol[first], at[first]
        del at, first
        # In the other transform the extensions of an interval follow each other by symbol, those by 0 first.
        inner = np.bincount(parent, weights=count, minlength=len(low)).astype(np.int64)
        by_parent = _stable_order(parent)
        before = np.cumsum(count[by_parent], dtype=np.int32) - count[by_parent]
        before -= (np.cumsum(inner) - inner).astype(np.int32)[parent[by_parent]]
        smaller = np.empty_like(before)
        smaller[by_parent] = before
        del by_parent, before
        smaller += (other + size - inner).astype(np.int32)[parent]
        return parent, symbol, new_low, count, smaller


def _pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _K + right)


class Shard:
    """Texts gathered for one index."""

    def __init__(self):
        self.langs: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, x: Texts, langs: list[str]) -> None:
        """Take the texts of a run, given the language of each of its rows."""
        code = np.array([self.langs.setdefault(lang, len(self.langs)) for lang in langs], dtype=np.int32)
        start, end = x.words(_BETWEEN[x.data])
        if not len(start):
            return
        row = x.row_of(start)
        pieces = np.cumsum(_PIECE_END[x.data])[start]
        cut = np.ones(len(start), dtype=bool)
        cut[1:] = (np.diff(pieces) > 0) | (np.diff(row) > 0)
        keep = ~_BETWEEN[x.data]
        letters = np.where(keep, _LOWER[x.data], np.uint8(32))
        keep[end] = True  # one blank after each word
        self.parts.append((x.span_hash(x.prefix_hash(), start, end), (end - start + 1).astype(np.int32), cut, code[row], letters[keep]))
        self.size += len(x.data)

    def index(self) -> Index:
        """The index; the shard is empty then, so that its parts don't stay beside it."""
        columns, self.parts = list(zip(*self.parts)), []
        return Index(list(self.langs), *[np.concatenate(columns.pop(0)) for _ in range(len(columns))])


class Index:
    """The words of a shard by number, and the FM-index over their ids.

    ``keys``: of each id less one, the 64-bit key of its word in its language.
    """

    def __init__(self, langs: list[str], hashes, lengths, cut, lang, letters):
        salt = pa.array(langs, pa.string())
        lang_hash = np.concatenate([x.span_hash(x.prefix_hash(lower=False), x.start, x.end) for x in texts_of(salt)])
        self.langs, self.lang, self.letters = salt, lang, letters
        self.offset = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths, out=self.offset[1:])
        hashes += (lang_hash * _K)[lang]
        hashes = mix(hashes)
        order = np.argsort(hashes)
        hashes = hashes[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]
        self.keys, self.example = hashes[new], order[new]
        n = len(hashes)
        ids = np.empty(n, dtype=np.int32)
        ids[order] = np.cumsum(new, dtype=np.int32) - 1
        del hashes, order, new
        words = np.arange(n, dtype=np.int32)
        place = np.cumsum(cut, dtype=np.int32)
        self.symbols = np.zeros(n + int(cut.sum()) + 1, dtype=np.int32)
        place += words
        self.symbols[place] = ids + 1
        self.word_at = np.zeros(len(self.symbols), dtype=np.int32)
        self.word_at[place] = words
        self.counts = np.bincount(ids, minlength=len(self.keys))
        self.low = len(self.symbols) - n + np.cumsum(self.counts) - self.counts  # the same in both directions

    def totals(self) -> np.ndarray:
        """Words of each language."""
        return np.bincount(self.lang, minlength=len(self.langs))

    def pairs(self, forward: Bwt) -> tuple[np.ndarray, ...]:
        """(left id, right id, low, size, low in the reverse) of all word pairs, the left word put in front of the right one."""
        right, left, low, size, other = forward.extend(self.low, self.counts, self.low)
        return left, right + 1, low, size, other

    def phrases(self, word: np.ndarray, n_words: int, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``(lang, phrase, n)`` of the phrases of ``n_words`` words that begin at the words numbered ``word``."""
        all_ends = np.cumsum(self.offset[word + n_words] - self.offset[word])
        at = 0
        while at < len(word):
            to = int(np.searchsorted(all_ends, (all_ends[at - 1] if at else 0) + SLICE_BYTES, side="right"))
            to = min(max(to, at + 1), at + SLICE)
            own = word[at:to]
            start, size = self.offset[own], self.offset[own + n_words] - 1 - self.offset[own]
            ends = np.cumsum(size)
            taken = self.letters[np.arange(ends[-1]) + np.repeat(start - (ends - size), size)]
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            texts = pa.Array.from_buffers(pa.string(), len(own), [None, pa.py_buffer(offsets), pa.py_buffer(taken)])
            yield pa.record_batch([self.langs.take(pa.array(self.lang[own])), texts, pa.array(count[at:to], pa.int64())],
                                  names=["lang", "phrase", "n"])
            at = to


def _key_counts(index: Index) -> Iterator[pa.RecordBatch]:
    """``(key, n)`` of all words and word pairs of a shard."""
    left, right, _, size, _ = index.pairs(Bwt(index.symbols, 2))
    for keys, n in ((index.keys, index.counts), (_pair_key(index.keys[left - 1], index.keys[right - 1]), size)):
        for at in range(0, len(keys), SLICE):
            own = slice(at, at + SLICE)
            yield pa.record_batch([pa.array(keys[own].view(np.int64)), pa.array(n[own], pa.int64())], names=["key", "n"])


def _frequent_phrases(index: Index, bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(lang, phrase, n)`` of a shard's words, pairs and triples that may be frequent; ``""`` counts all words."""
    slot_bits = np.uint64(len(bitmap) * 8 - 1)

    def may(keys: np.ndarray) -> np.ndarray:
        slot = keys & slot_bits
        return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    totals = index.totals()
    yield pa.record_batch([index.langs, pa.array([""] * len(totals), pa.string()), pa.array(totals, pa.int64())], names=["lang", "phrase", "n"])
    words = np.flatnonzero(may(index.keys))
    yield from index.phrases(index.example[words], 1, index.counts[words])

    forward = Bwt(index.symbols, 3)
    pairs = index.pairs(forward)
    open_ = may(_pair_key(index.keys[pairs[0] - 1], index.keys[pairs[1] - 1]))
    _, right, low, size, other = (x[open_] for x in pairs)
    yield from index.phrases(index.word_at[forward.order[low]], 2, size)

    # To the right: in front, in the reversed sequence. The pair on the right must be frequent as well.
    parent, third, _, size, low = Bwt(index.symbols[::-1], 2).extend(other, size, low)
    open_ = may(_pair_key(index.keys[right[parent] - 1], index.keys[third - 1]))
    yield from index.phrases(index.word_at[forward.order[low[open_]]], 3, size[open_])


def _over_shards(docs: DataFrame, rows_of, schema: str) -> DataFrame:
    """``rows_of(index)`` of each shard of ``(lang, text)`` rows."""
    def shards(batches):
        shard = Shard()
        for batch in batches:
            langs = batch.column(0).fill_null(NO_LANG).to_pylist()
            for x in texts_of(batch.column(1)):
                shard.add(x, langs[x.first:x.first + x.n])
                if shard.size >= SHARD_BYTES:
                    yield from rows_of(shard.index())
                    shard = Shard()
        if shard.parts:
            yield from rows_of(shard.index())

    ship_package(docs.sparkSession)
    return docs.mapInArrow(shards, schema)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The Bloom bitmap of the column ``key``, at most 128 MB however many keys there are."""
    bits = filter_bits(keys.count())
    slot = F.col("key").bitwiseAND(F.lit(bits - 1)) + 1
    buckets = (keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bitmap")))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in buckets.toLocalIterator():
        at = (row["bucket"] - 1) * BITMAP_BYTES
        out[at:at + BITMAP_BYTES] = np.frombuffer(bytes(row["bitmap"]), dtype=np.uint8)
    return out


def phrase_counts(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, phrase, n)``: exact counts of all phrases of one to three words that occur ``least`` times or more.

    The empty phrase counts all words of its language.
    """
    own = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    keys = (_over_shards(own, _key_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least).select("key"))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(written(keys, "phrase-keys")))
    found = _over_shards(own, lambda index: _frequent_phrases(index, shared.value), "lang string, phrase string, n long")
    summed = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return written(summed.where((F.col("n") >= least) | (F.col("phrase") == "")), "phrases")


def _part(first: int, n: int) -> Column:
    return F.array_join(F.slice("words", first, n), " ")


def collocations(docs: DataFrame, least: int = 10, keep_below: int = 50, top: int = 2000,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of two or three words of each language.

    Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]``
    and those into words at blanks and tabs. ``a`` counts the phrase, ``l`` and
    ``r`` the parts of its lowest-scoring cut, ``n`` all words of the language;
    ``score`` is floor(1000000 a a / (l r)). Phrases with ``a < least`` aren't
    candidates; one that lies in a longer candidate is dropped if that has at
    least ``keep_below`` percent of its count. Ties of cuts go to the first
    cut, of ranks to the larger ``a``, then to the smaller phrase in bytes.

    A null language counts as ``und``, a null or empty text has no words, a
    repeated row counts each time; a language without candidates has no rows,
    nor has an empty table. Counts must stay below 10**15.
    """
    counts = phrase_counts(docs, least, text, lang)
    phrases = counts.where("phrase <> ''")
    candidates = phrases.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1)
    three = F.size("words") == 3
    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
    cuts = F.when(three, F.array(cut(1, _part(1, 1), _part(2, 2)), cut(2, _part(1, 2), _part(3, 1)))).otherwise(
        F.array(cut(1, _part(1, 1), _part(2, 1))))
    side = lambda part, n: phrases.select("lang", F.col("phrase").alias(part), F.col("n").alias(n))
    scored = (candidates.select("lang", "phrase", F.col("n").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
              .join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
              .withColumn("score", F.expr("cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))"
                                          " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c")).select("lang", "phrase", "c.*")
    within = (candidates.where(three).select("lang", F.explode(F.array(_part(1, 2), _part(2, 2))).alias("phrase"), F.col("n").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = lowest.join(within, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < keep_below * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("phrase = ''").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
