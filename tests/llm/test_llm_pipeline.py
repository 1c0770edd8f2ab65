"""The pipeline against a brute-force version of each stage."""

import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tally.llm.language_id import accepted, fit_language_filters, identify_language
from tally.llm.shared import fold
from tests.llm.brute import near_components
from tests.llm.test_llm_mixing_search import targets

SF = "/root/testdata/sf0.01"


def brute(spark, docs):
    filters = fit_language_filters(docs, fold(F.col("doc_id"), 3) != 1)
    known = identify_language(docs, filters).where(accepted(F.col("language"))).collect()
    groups = {}
    for r in known:
        key = r["text"].translate({c: None for c in (32, *range(9, 14))})
        groups.setdefault(key, []).append(r)
    rows = {r["doc_id"]: r for own in groups.values() for r in [min(own, key=lambda r: (-len(r["text"]), r["doc_id"]))]}
    near = near_components({i: r["text"] for i, r in rows.items()}, 5, 80)
    rows = {i: r for i, r in rows.items() if near[i][1] == i}
    size = {i: len(r["text"].encode().split()) for i, r in rows.items()}
    per = {}
    for i, r in rows.items():
        per[r["source"]] = per.get(r["source"], 0) + size[i]
    want = targets(per)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, r in rows.items():
        rate = want[r["source"]] / per[r["source"]]
        draw = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:8], 16) / 2 ** 32
        copies = int(rate) + (draw < rate - int(rate))
        out += [(i, library.encode(r["text"], add_special_tokens=False).ids)] * copies
    return out


def test_pipeline_matches_brute_force(spark):
    want = brute(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        assert "n_tokens" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns


def test_stages_on_edges(spark, edge_docs, no_docs):
    docs = edge_docs
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        kept.append(docs.count())
    # Null, empty, blank and letterless texts go; the four equal texts and the two without blanks leave one each.
    assert kept[0] == 9 and kept[1] == 5 and kept[2] == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0


def test_queries_and_sql_are_registered():
    import __spark_entry__ as entry

    numbers = {int(name[2:].split("_")[0]) for name in entry.queries() if name.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
    assert {"op4_va_file_top_k", "op9_exact_dedup", "op10_mix_sources"} <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "MinHash near-dedup", "mixing sources", "BPE encoding"]
