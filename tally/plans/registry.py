"""Registered queries: ``key -> (spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or data Spark derives from them), so its
work grows with the input. TPC-H keys run with the fixture parameters of
FIXTURES.md §4 because the test tables start in 1995.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tally.plans import tpch
from tally.plans.load_queries import LOAD_BUILDERS
from tally.plans.timing_queries import TIMING_BUILDERS
from tally.sources.fixtures import fixture_frames


def _tpch(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return tpch.run_query(key, fixture_frames(spark, sf_dir, tpch.QUERIES[key].tables), fixture=True)


QUERY_BUILDERS = {**{key: partial(_tpch, key) for key in tpch.QUERIES}, **TIMING_BUILDERS, **LOAD_BUILDERS}
