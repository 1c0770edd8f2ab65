"""Training-data operators: language, toxicity, duplicates, search, tokens, pages, quality, mixing.

Each operator takes and returns DataFrames. Nothing outside this subpackage
(and ``corpus_pipeline.py``) imports it.
"""
