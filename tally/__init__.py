"""tally: TPC-H pipelines and run-log timing analytics on Spark DataFrames.

Two halves:

* ``tally.plans.tpch`` - nine parameterised TPC-H queries (pricing summary,
  shipping priority, local supplier volume, revenue forecast, returned
  items, shipmode priority, promotion effect, supplier count, large orders).
* ``tally.operators.timing`` - run-log timing operators that turn workflow
  event histories, run documents and job tables into one ``task_timing``
  table and derive relative timings, waits, transitions, worker indices,
  phase breakdowns and reports for every workflow at once.

Everything is DataFrame / Spark SQL; no Python UDF sits in a hot path.
"""

__version__ = "0.1.0"
