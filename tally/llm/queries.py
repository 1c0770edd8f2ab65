"""Registered queries of this subpackage: ``key -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.bpe import round_trip
from tally.llm.collocations import collocations
from tally.llm.crosspolytope import nearest_neighbours
from tally.llm.dialogue import damaged, repair_conversations
from tally.llm.exact_dedup import exact_dedup, with_digest
from tally.llm.html_consensus import extract_main_text
from tally.llm.language_id import fit_language_filters, identify_language
from tally.llm.mixing import mix_sources, n_words
from tally.llm.quality import fit_quality, score_quality
from tally.llm.setsketch import near_duplicates
from tally.llm.shared import fold, shared_path, written
from tally.llm.token_counts import count_tokens
from tally.llm.toxicity import fit_toxicity, score_toxicity
from tally.llm.vafile import exact_top_k

#: The vocabulary that the token queries use, and the length above which a document is over the limit.
TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
TOXIC_FROM = 0.7
GOOD_FROM = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 3) == 1
    filters = fit_language_filters(docs, train=~held_out)
    return identify_language(docs.select("doc_id", "text"), filters, out="language").select(
        "doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score",
        "language.coverage", "language.n_grams")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = fit_quality(docs, table(spark, sf_dir, "labels"), train=~held_out)
    return score_quality(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_digest(table(spark, sf_dir, "documents")).select("doc_id", "n_code_points", "text_sha256")
    return exact_dedup(docs, digest="text_sha256", length="n_code_points", key="doc_id").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written, so that the words are counted once, for the totals and for the rows.
    docs = written(table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size")), "sized")
    return mix_sources(docs, size="size").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), train=~held_out)
    return score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op3_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, shingle=4, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = exact_top_k(vectors, queries=F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = round_trip(docs, public_tokenizers.path(TOKENIZER), out="coded")
    return coded.select(
        "doc_id", (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("coded.ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("coded.decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_consensus_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that every distinct text is encoded in the run."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(text).cast("long").alias("n_bytes"))
    counted = count_tokens(docs, public_tokenizers.path(TOKENIZER), cache=shared_path(spark, "token-counts"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = nearest_neighbours(vectors, queries=F.col("vec_id") % 20 == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(table(spark, sf_dir, "conversations")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_setsketch_near_dedup": op3_setsketch_near_dedup,
    "op4_va_file_top_k": op4_va_file_top_k,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_consensus_html": op6_consensus_html,
    "op7_token_counts": op7_token_counts,
    "op8_quality": op8_quality,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mix_sources": op10_mix_sources,
    "op11_cross_polytope": op11_cross_polytope,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_collocations": op13_collocations,
}

#: DuckDB twins, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {
    "op4_va_file_top_k": r"""
        WITH v AS (
            SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0),
        r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
                   vec_id, score
            FROM s)
        SELECT * FROM r WHERE rank <= 5
    """,
    "op9_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents),
        r AS (
            SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
    """,
    "op10_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source,
                   CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents),
        t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (
            SELECT *, 3 * source_size AS cap,
                   [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
            FROM t),
        l AS (
            SELECT *, CAST(sum(source_size) OVER ()
                           - coalesce(sum(cap) OVER below, 0) AS DOUBLE)
                      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS DOUBLE) AS level
            FROM w WINDOW below AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (
            SELECT *, max(CASE WHEN cap >= weight * level THEN level END) OVER () AS final_level FROM l),
        p AS (
            SELECT source, source_size,
                   CASE WHEN final_level IS NULL OR cap < weight * final_level THEN CAST(cap AS DOUBLE)
                        ELSE weight * final_level END AS target,
                   CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate
            FROM f)
        SELECT doc_id, size, source_size, target,
               CAST(size * (floor(rate) + CASE
                    WHEN CAST('0x' || md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT)
                         / 4294967296.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
    """,
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (
            SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
            UNION ALL
            SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, CAST(len(w) AS BIGINT))]) FROM w
            UNION ALL
            SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, CAST(len(w) AS BIGINT) - 1)])
            FROM w),
        f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
        c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10),
        cuts AS (
            SELECT lang, phrase, words, a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM c
            UNION ALL
            SELECT lang, phrase, words, a, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE words = 3),
        s AS (
            SELECT cuts.lang, cuts.phrase, cuts.words, a, k, x.f AS l, y.f AS r,
                   CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.x
                      JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.y),
        low AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM s)
            WHERE place = 1),
        inner_ AS (
            SELECT lang, part, max(a) AS longer
            FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM c WHERE words = 3)
            GROUP BY lang, part),
        kept AS (
            SELECT low.* FROM low LEFT JOIN inner_ ON inner_.lang = low.lang AND inner_.part = low.phrase
            WHERE longer IS NULL OR 100 * longer < 50 * a),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT ranked.lang, rank, phrase, a, l, r, n, score
        FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
    """,
}
