"""Language identification with bit-sliced Bloom filters over byte n-grams.

One Bloom filter per language, stored side by side: the table holds, for each
position, a bit mask of the languages whose filter has that position set, so
the AND of an n-gram's positions gives at once all languages that contain it.
A document's language is the one with the most of its n-grams, after the
expected number of false positives of that language's filter is taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.shared import ship_package
from tally.llm.textvec import mix, texts_of

GRAM = 4                    # bytes of an n-gram; a word counts with one blank on each side
HASHES = 2                  # positions of an n-gram in the filters
BITS_PER_GRAM = 16          # filter positions per n-gram kept (all languages together)
SAMPLE_DOCS = 5_000         # bound of the labelled training sample of each language
MIN_SHARE = 0.01            # an n-gram enters a filter if this share of the language's documents has it
UNKNOWN = "und"
REJECT_COVERAGE = 0.2       # least share of a text's n-grams that its language must contain
BENEFIT_GRAMS = 4           # known n-grams that `accepted` lends each text, so that a few odd words don't condemn it

RESULT = "lang_pred string, score double, coverage double, n_grams long"


def _grams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, n-grams as 32-bit words, row of each) for runs of texts.

    Letters are a-z and every byte of a non-ASCII character; all else is one
    blank, which an n-gram may have at its ends only.
    """
    for x in texts_of(pc.utf8_lower(column)):
        letter = ((x.data >= 97) & (x.data <= 122)) | (x.data >= 128)
        data = np.where(letter, x.data, 32).astype(np.uint32)
        n = len(data) - GRAM + 1
        if n <= 0:
            yield x.first, x.n, np.zeros(0, np.uint32), np.zeros(0, np.int64)
            continue
        gram, inner = data[:n].copy(), np.ones(n, dtype=bool)
        for j in range(1, GRAM):
            gram |= data[j:j + n] << np.uint32(8 * j)
            if j < GRAM - 1:
                inner &= letter[j:j + n]
        at = np.flatnonzero(inner)
        yield x.first, x.n, gram[at], x.row_of(at + 1)


def _positions(gram: np.ndarray, size: int) -> list[np.ndarray]:
    h = mix(gram.astype(np.uint64) + np.uint64(1))
    shift = np.uint64(32 // HASHES * 2)
    return [((h >> (shift * np.uint64(k))) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class LanguageFilters:
    """``tables[s][p]``: mask of the languages 8 s .. 8 s + 7 whose filter has position p."""

    languages: list[str]
    tables: np.ndarray
    false_positive: np.ndarray
    default: int

    @staticmethod
    def build(grams: dict[str, np.ndarray], counts: dict[str, int]) -> "LanguageFilters":
        languages = sorted(grams)
        total = sum(map(len, grams.values()))
        size = 1 << max(10, int(np.ceil(np.log2(max(1, total) * BITS_PER_GRAM))))
        tables = np.zeros((max(1, -(-len(languages) // 8)), size), dtype=np.uint8)
        fill = np.zeros(len(languages))
        for i, name in enumerate(languages):
            for places in _positions(grams[name], size):
                tables[i // 8, places] |= np.uint8(1 << i % 8)
            fill[i] = np.count_nonzero(tables[i // 8] & np.uint8(1 << i % 8)) / size
        default = max(range(len(languages)), key=lambda i: (counts[languages[i]], -i), default=0)
        return LanguageFilters(languages, tables, fill ** HASHES, default)

    def counts(self, gram: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Corrected number of each row's n-grams per language."""
        places = _positions(gram, self.tables.shape[1])
        total = np.bincount(rows, minlength=n).astype(float)
        out = np.zeros((n, len(self.languages)))
        for s, table in enumerate(self.tables):
            mask = table[places[0]]
            for p in places[1:]:
                mask = mask & table[p]
            by_mask = np.bincount(rows * 256 + mask, minlength=n * 256).reshape(n, 256)
            for i in range(8 * s, min(8 * s + 8, len(self.languages))):
                have = by_mask[:, (np.arange(256) >> (i % 8)) & 1 == 1].sum(axis=1)
                f = self.false_positive[i]
                out[:, i] = np.clip((have - total * f) / max(1e-9, 1 - f), 0, None)
        return out

    def predict(self, column: pa.Array) -> pa.Array:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        has_letter = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        rows = len(column)
        best, score = np.full(rows, self.default), np.zeros(rows)
        coverage, n_grams = np.zeros(rows), np.zeros(rows, dtype=np.int64)
        if self.languages:
            for first, n, gram, row in _grams(column):
                own = slice(first, first + n)
                counts, total = self.counts(gram, row, n), np.bincount(row, minlength=n)
                most, all_ = counts.max(axis=1), counts.sum(axis=1)
                best[own] = np.where(all_ > 0, counts.argmax(axis=1), self.default)
                score[own] = np.where(all_ > 0, most / np.maximum(all_, 1e-9), 1 / len(self.languages))
                coverage[own] = most / np.maximum(total, 1)
                n_grams[own] = total
        known = has_letter & bool(self.languages)
        names = np.array([*self.languages, UNKNOWN], dtype=object)[np.where(known, best, len(self.languages))]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.where(known, np.clip(score, 0, 1), 0.0)),
             pa.array(np.where(known, np.clip(coverage, 0, 1), 0.0)), pa.array(n_grams)],
            names=["lang_pred", "score", "coverage", "n_grams"])


def fit_language_filters(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang",
                         key: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> LanguageFilters:
    """Learn the filters from rows of ``docs`` where ``train`` holds and text and lang are not null.

    Of each language at most about ``sample_docs`` rows (by a hash of ``key``)
    are read in full, so a rare one is learned from as many rows as a common one.
    Spark counts each n-gram's documents per language; those in at least
    ``MIN_SHARE`` of a language's documents come to the driver: at most
    n-grams-per-document / ``MIN_SHARE`` for a language. Languages are a closed
    set of labels, some hundreds at most: their counts and filters are held for each.
    """
    ship_package(docs.sparkSession)
    usable = docs.where(train & F.col(text).isNotNull() & F.col(lang).isNotNull())
    usable = usable.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    totals = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return LanguageFilters.build({}, {})
    share = F.create_map(*[F.lit(x) for name, n in totals.items() for x in (name, int((1 << 30) * min(1.0, sample_docs / n)))])
    chosen = F.pmod(F.xxhash64(F.lit("sample"), F.col("key")), F.lit(1 << 30)) < share[F.col("lang")]
    sample = usable.where(chosen).select("text", "lang")

    def document_counts(batches):
        schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("docs", pa.int64())])
        for batch in batches:
            names, lang_no = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            for first, n, gram, row in _grams(batch.column("text")):
                pairs = np.unique((row.astype(np.uint64) << np.uint64(32)) | gram)
                own = lang_no[first + (pairs >> np.uint64(32)).astype(np.int64)].astype(np.uint64)
                keys, docs_ = np.unique((own << np.uint64(32)) | (pairs & np.uint64(0xFFFFFFFF)), return_counts=True)
                own_lang = names[(keys >> np.uint64(32)).astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own_lang, pa.string()), pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                     pa.array(docs_.astype(np.int64))], schema=schema)

    counts = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return LanguageFilters.build({}, {})
    least = F.create_map(*[F.lit(x) for name, n in counts.items()
                           for x in (name, max(1, int(np.ceil(MIN_SHARE * n))))])
    kept = (sample.mapInArrow(document_counts, "lang string, gram long, docs long")
            .groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least[F.col("lang")])
            .groupBy("lang").agg(F.collect_list("gram").alias("grams")))
    grams = {name: np.zeros(0, np.uint32) for name in counts}
    grams |= {r["lang"]: np.array(r["grams"], dtype=np.uint32) for r in kept.collect()}
    return LanguageFilters.build(grams, counts)


def identify_language(docs: DataFrame, filters: LanguageFilters, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out`` of ``lang_pred, score, coverage, n_grams``.

    ``lang_pred`` is ``und`` (score 0) when the text is null or has no letter,
    or nothing was learned. A text whose n-grams are in no filter gets the
    commonest training language at score 1 / languages. Ties go to the language
    first by name. Repeated rows get equal results; an existing column ``out``
    is replaced.
    """
    ship_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf(RESULT)
    def predicted(column: pa.Array) -> pa.Array:
        return shipped.value.predict(column)

    return docs.withColumn(out, predicted(F.col(text)))


def accepted(language: Column) -> Column:
    """False for ``und`` and for texts too few of whose n-grams their language contains.

    One rule for every length: the text's coverage, after ``BENEFIT_GRAMS`` known
    n-grams are added to its own, is at least ``REJECT_COVERAGE``. A text without
    n-grams (a single letter, say) stays.
    """
    known = language["coverage"] * language["n_grams"] + BENEFIT_GRAMS
    return (language["lang_pred"] != UNKNOWN) & (known >= REJECT_COVERAGE * (language["n_grams"] + BENEFIT_GRAMS))
