"""Run-log sources: schemas and readers for landed workflow logs.

Orchestrator APIs return one JSON document per run (or per page of a run's
history). These are landed as JSON/Parquet files and read with explicit
schemas; every operator accepts any number of document rows ("pages") per
workflow, so a long history never has to fit in one row. The HTTP fetching
itself is not part of this library.

Every document row carries ``workflow_id`` (the id the run was fetched by)
and ``page`` (its position among that run's pages; 0 when unpaged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()

# Event-history page (one page of history.events of one workflow run).
EVENT_HISTORY = T.StructType([
    T.StructField("workflow_id", S),
    T.StructField("run_id", S),
    T.StructField("page", T.IntegerType()),
    T.StructField("history", T.StructType([
        T.StructField("events", T.ArrayType(T.StructType([
            T.StructField("eventId", S),
            T.StructField("eventTime", S),
            T.StructField("eventType", S),
            T.StructField("activityTaskScheduledEventAttributes", T.StructType([
                T.StructField("activityId", S),
            ])),
            T.StructField("activityTaskStartedEventAttributes", T.StructType([
                T.StructField("scheduledEventId", S),
                T.StructField("identity", S),
            ])),
            T.StructField("activityTaskCompletedEventAttributes", T.StructType([
                T.StructField("scheduledEventId", S),
                T.StructField("startedEventId", S),
            ])),
        ]))),
    ])),
    T.StructField("pageToken", S),      # the token that the page was fetched with; null for the first page
    T.StructField("nextPageToken", S),
])

# Run document with run, shape, taskEvents and tasks.
RUN_DOCUMENT = T.StructType([
    T.StructField("workflow_id", S),
    T.StructField("page", T.IntegerType()),
    T.StructField("run", T.StructType([T.StructField("createdAt", S)])),
    T.StructField("shape", T.ArrayType(T.StructType([
        T.StructField("taskName", S),
        T.StructField("taskExternalId", S),
    ]))),
    T.StructField("taskEvents", T.ArrayType(T.StructType([
        T.StructField("taskId", S),
        T.StructField("eventType", S),
        T.StructField("timestamp", S),
        T.StructField("workerId", S),
    ]))),
    T.StructField("tasks", T.ArrayType(T.StructType([
        T.StructField("taskExternalId", S),
        T.StructField("taskInsertedAt", S),
        T.StructField("startedAt", S),
        T.StructField("finishedAt", S),
        T.StructField("workerId", S),
    ]))),
])

# Execution document with taskRunList[].state.histories[].
EXECUTION = T.StructType([
    T.StructField("workflow_id", S),
    T.StructField("page", T.IntegerType()),
    T.StructField("taskRunList", T.ArrayType(T.StructType([
        T.StructField("id", S),
        T.StructField("taskId", S),
        T.StructField("value", S),
        T.StructField("state", T.StructType([
            T.StructField("histories", T.ArrayType(T.StructType([
                T.StructField("state", S),
                T.StructField("date", S),
            ]))),
        ])),
    ]))),
])

# DAG-run document with task groups.
DAG_RUN = T.StructType([
    T.StructField("workflow_id", S),
    T.StructField("page", T.IntegerType()),
    T.StructField("groups", T.StructType([
        T.StructField("children", T.ArrayType(T.StructType([
            T.StructField("id", S),
            T.StructField("instances", T.ArrayType(T.StructType([
                T.StructField("queued_dttm", S),
                T.StructField("start_date", S),
                T.StructField("end_date", S),
                T.StructField("state", S),
                T.StructField("try_number", T.IntegerType()),
            ]))),
        ]))),
    ])),
])

# Job tables (completed jobs and their completion records).
JOBS = T.StructType([
    T.StructField("id", S),
    T.StructField("parent_job", S),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("duration_ms", T.LongType()),
])
JOB_COMPLETIONS = T.StructType([
    T.StructField("id", S),
    T.StructField("worker", S),
])

# Task-run listing.
TASK_RUN = T.StructType([
    T.StructField("id", S),
    T.StructField("created", T.TimestampType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
])

# Timing CSV written by the history-phase operator (K6). Header names.
TIMING_CSV_COLUMNS = [
    "Task ID", "Value", "Created Time", "Started Time", "Success Time",
    "Transition Time (s)", "Assignment Time (s)", "Execution Time (s)", "Total Time (s)",
]
TIMING_CSV = T.StructType([
    T.StructField("Task ID", S),
    T.StructField("Value", S),
    T.StructField("Created Time", T.TimestampType()),
    T.StructField("Started Time", T.TimestampType()),
    T.StructField("Success Time", T.TimestampType()),
    T.StructField("Transition Time (s)", T.DoubleType()),
    T.StructField("Assignment Time (s)", T.DoubleType()),
    T.StructField("Execution Time (s)", T.DoubleType()),
    T.StructField("Total Time (s)", T.DoubleType()),
])


def _json(spark: SparkSession, path, schema: T.StructType, multiline: bool) -> DataFrame:
    df = spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)
    return df.withColumn("page", F.coalesce(F.col("page"), F.lit(0)))


def read_event_history(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Landed history pages; many files = concatenated pages.

    Pages landed twice or not at all: ``operators.pages.chained_pages`` and ``page_report``.
    """
    return _json(spark, path, EVENT_HISTORY, multiline)


def read_run_documents(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Landed run documents."""
    return _json(spark, path, RUN_DOCUMENT, multiline)


def read_executions(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Landed execution documents."""
    return _json(spark, path, EXECUTION, multiline)


def read_dag_runs(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Landed DAG-run documents."""
    return _json(spark, path, DAG_RUN, multiline)


def job_predicates(root_ids: list[str], per_read: int = 100, multi_worker: bool = True) -> list[str]:
    """WHERE texts that read the roots, their children and (multi worker) grandchildren, ``per_read`` roots each.

    The database filters by parent id; each text is one task's read.
    """
    texts = []
    for at in range(0, len(root_ids), per_read):
        ids = ", ".join("'" + r.replace("'", "''") + "'" for r in root_ids[at:at + per_read])
        below = f" OR parent_job IN (SELECT id FROM {{table}} WHERE parent_job IN ({ids}))" if multi_worker else ""
        texts.append(f"id IN ({ids}) OR parent_job IN ({ids}){below}")
    return texts


def read_jobs_jdbc(spark: SparkSession, url: str, jobs_table: str, completions_table: str, root_ids: list[str],
                   properties: dict | None = None, per_read: int = 100, multi_worker: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(jobs, completions)`` of the given roots over JDBC, read by as many tasks as there are predicates."""
    texts = [t.format(table=jobs_table) for t in job_predicates(root_ids, per_read, multi_worker)]
    jobs = spark.read.jdbc(url, jobs_table, predicates=texts, properties=properties or {})
    of_jobs = [f"id IN (SELECT id FROM {jobs_table} WHERE {t})" for t in texts]
    return jobs, spark.read.jdbc(url, completions_table, predicates=of_jobs, properties=properties or {})


def read_task_runs(spark: SparkSession, path) -> DataFrame:
    """Landed task-run listings (``id, created, start_time, end_time``) as JSON lines, unordered."""
    return spark.read.schema(TASK_RUN).json(path)


def task_run_phases(runs: DataFrame, workflow: str = "task_runs") -> DataFrame:
    """S12 rows -> phase rows of one workflow of the given name, by creation order."""
    from tally.operators.sequence import ordinal

    timed = runs.select(F.lit(workflow).alias("workflow_id"), F.col("id").alias("task_run_id"), F.col("created").alias("created_at"),
                        F.col("start_time").alias("started_at"), F.col("end_time").alias("success_at"))
    whole = timed.dropna(subset=["created_at", "started_at", "success_at"])
    return ordinal(whole, ["workflow_id"], ["created_at", "task_run_id"], out="pos")


def read_timing_csv(spark: SparkSession, path) -> DataFrame:
    """Timing CSV with header, timestamps parsed."""
    return (
        spark.read.option("header", "true").option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX]")
        .schema(TIMING_CSV).csv(path)
    )


def read_csv_phases(spark: SparkSession, path) -> DataFrame:
    """S13 -> phase rows, in the order of the files' lines within each workflow.

    ``path`` holds CSV with the workflow as a column or as folders (``write_timing_csv``).
    """
    from tally.operators.sequence import ordinal

    lines = (spark.read.option("header", "true").option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX]")
             .schema(T.StructType([T.StructField("workflow_id", S), *TIMING_CSV.fields])).csv(path))
    rows = lines.select(
        "workflow_id", F.col("Task ID").alias("task_run_id"), F.col("Value").alias("value"),
        F.col("Created Time").alias("created_at"), F.col("Started Time").alias("started_at"), F.col("Success Time").alias("success_at"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"))
    return ordinal(rows, ["workflow_id"], ["_file", "_split", "_line"], out="pos").drop("_file", "_split", "_line")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Workflow ids one per line, stripped, blanks dropped, file order kept as ``pos``.

    Line order is part of the semantics (results are concatenated in file
    order). ``pos`` is the 0-based line number over all files in path order
    (blank lines count, as in the file). Lines are ordered by ``(file path,
    split start, row in the split)``: the scan keeps line order, which
    ``monotonically_increasing_id`` records. ``ordinal`` cuts that order by
    the data, so no task and no driver sees a whole long list.
    """
    from tally.operators.sequence import ordinal

    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row_in_split"),
    )
    numbered = ordinal(lines, [], ["_file", "_split", "_row_in_split"], out="pos")
    return numbered.select(F.trim(F.col("line")).alias("workflow_id"), "pos").where(F.col("workflow_id") != "")
