"""Registered run-log timing queries over documents derived from ``events``.

Each builder reads the test tables, derives the run-log document shape the
operator consumes (``tally.sources.runlog_fixtures``) and applies the
operator to every workflow at once. Timestamps in outputs are rendered as
text with microseconds so both engines compare them exactly.

The derived documents play the part of landed run logs. Each query derives
and lands its own (reliable checkpoint): nothing is kept between queries, so
changed input is always read anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.timefn import micros_between, parse_ts, seconds
from tally.operators import documents, pages, timing
from tally.operators.sequence import dense_index
from tally.operators.timing import WF
from tally.session import ensure_checkpoint_dir
from tally.sinks import files
from tally.sources import runlog_fixtures as fx
from tally.sources import runlogs
from tally.sources.tables import read_table

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _life(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.land(fx.lifecycle_events(read_table(spark, sf_dir, "events")))


def _doc(spark: SparkSession, sf_dir: str, shape) -> DataFrame:
    return fx.land(shape(_life(spark, sf_dir)))


def _ts(c: str) -> F.Column:
    return F.date_format(c, TS_TEXT).alias(c)


def _relative_seconds(tt: DataFrame, extra=()) -> DataFrame:
    """Relative seconds in place of the timestamps; ``<c>_us`` columns kept for derived values."""
    cols = ("created_at", "started_at", "completed_at", *extra)
    rel = timing.relative_us(tt, cols)
    return rel.withColumns({c: seconds(f"{c}_us") for c in cols})


def _event_history_timing(spark, sf_dir):
    return timing.correlate_event_history(_doc(spark, sf_dir, fx.event_history_pages))


def _run_document_timing(spark, sf_dir):
    return timing.pivot_task_events(_doc(spark, sf_dir, fx.run_document_pages))


def _phase_times(spark, sf_dir):
    return timing.history_phase_times(_doc(spark, sf_dir, fx.execution_pages))


def _jobs(spark, sf_dir):
    jobs, completions = fx.job_tables(_life(spark, sf_dir))
    return fx.land(jobs), fx.land(completions)


def _job_timing(spark, sf_dir):
    jobs, completions = _jobs(spark, sf_dir)
    return timing.relative_job_times(timing.job_hierarchy(jobs, completions))


def t1_correlate_event_history(spark, sf_dir):
    tt = timing.waiting_times(_event_history_timing(spark, sf_dir))
    return _relative_seconds(tt).select(
        WF, "task", "created_at", "started_at", "completed_at",
        seconds(F.col("completed_at_us") - F.col("started_at_us")).alias("duration"),
        "waiting_time", F.col("worker").alias("worker_id"),
    )


def t2_pivot_task_events(spark, sf_dir):
    tt = timing.normalize_workers(_run_document_timing(spark, sf_dir), "lexicographic")
    return timing.clamped_relative(tt).select(WF, "task", "created_at", "started_at", "completed_at",
                                              "worker", "worker_index")


def t3_bulk_task_times(spark, sf_dir):
    life = _life(spark, sf_dir)
    docs, ids = fx.land(fx.run_document_pages(life)), fx.land(fx.id_list(life))
    rows = timing.clamped_relative(timing.bulk_task_times(docs, ids))
    rows = dense_index(rows, [], "worker", [F.col("worker")])
    return rows.select("pos", WF, "created_at", "started_at", "completed_at", "worker", "worker_index")


def t4_history_phase_times(spark, sf_dir):
    return _phase_times(spark, sf_dir).select(
        WF, "pos", "task_run_id", "value", _ts("created_at"), _ts("started_at"), _ts("success_at"),
        "transition_s", "assignment_s", "execution_s", "total_s",
    )


def t5_flatten_task_groups(spark, sf_dir):
    flat = timing.flatten_task_groups(fx.dag_run_pages(_life(spark, sf_dir)))
    return flat.select(
        WF, "id", "queued_dttm", "start_date", "end_date",
        seconds(micros_between(parse_ts("queued_dttm"), parse_ts("start_date"))).alias("assignment_s"),
        seconds(micros_between(parse_ts("start_date"), parse_ts("end_date"))).alias("execution_s"),
    )


def t6_job_hierarchy(spark, sf_dir):
    jobs, completions = _jobs(spark, sf_dir)
    return timing.job_hierarchy(jobs, completions).select(
        "root_id", "sub_parent_id", _ts("sub_parent_created_at"), "id", _ts("created_at"), _ts("started_at"),
        "duration_ms", "worker",
    )


def t7_relative_job_times(spark, sf_dir):
    tt = timing.normalize_workers(_job_timing(spark, sf_dir), "lexicographic")
    rel = _relative_seconds(tt, ("own_created_at",)).withColumn(
        "created_started_diff", seconds(F.col("started_at_us") - F.col("own_created_at_us")))
    return rel.select(WF, "task", "created_at", "started_at", "completed_at", "created_started_diff",
                      "worker", "worker_index")


def t8_normalize_workers(spark, sf_dir):
    tt = timing.normalize_workers(_event_history_timing(spark, sf_dir), "numeric")
    return tt.select(WF, "task", "worker", "worker_index")


def t9_phase_breakdown_by_duration(spark, sf_dir):
    return timing.phase_breakdown_by_duration(_job_timing(spark, sf_dir)).select(timing.DURATION_BREAKDOWN_COLUMNS)


def k8_stats_report(spark, sf_dir):
    return files.stats_report(timing.phase_breakdown_by_duration(_job_timing(spark, sf_dir)))


def t10_phase_breakdown_by_means(spark, sf_dir):
    return timing.phase_breakdown_by_means(_phase_times(spark, sf_dir))


def t11_waiting_times(spark, sf_dir):
    return timing.waiting_times(_run_document_timing(spark, sf_dir)).select(WF, "task", "waiting_time")


def t12_waiting_execution_arrays(spark, sf_dir):
    return timing.waiting_execution(_phase_times(spark, sf_dir))


def k9_printed_arrays(spark, sf_dir):
    arrays = timing.waiting_execution(_phase_times(spark, sf_dir))
    return documents.printed_arrays(arrays, [WF], ["waiting_time", "execution_time"])


def t13_timing_table(spark, sf_dir):
    return timing.timing_table(_phase_times(spark, sf_dir))


def t14_benchmark_document(spark, sf_dir):
    tt = timing.normalize_workers(_event_history_timing(spark, sf_dir), "numeric")
    doc = _document(tt, "run-log timings")
    return doc.select(
        "version", "usecase", "title", "description", "language", "workers",
        *[documents.printed_array(c).alias(c) for c in documents.ARRAYS],
        documents.printed_array("worker_execution", "%d").alias("worker_execution"))


def _document(tt: DataFrame, title: str) -> DataFrame:
    arrays = documents.benchmark_arrays(tt, "worker_index")
    return documents.benchmark_document(arrays, "python", title, "derived from events")


def _stored_document(spark: SparkSession, *commits: DataFrame) -> DataFrame:
    """The entries left in a fresh document after the commits."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/document-{uuid.uuid4().hex}"
    for entries in commits:
        files.commit_documents(documents.document_entries(entries), path)
    body = "workers int, created_at array<double>, started_at array<double>, completed_at array<double>, worker_execution array<int>"
    stored = files.read_documents(spark, path).withColumn("b", F.from_json(F.col("fields")["python"], body))
    return stored.select(
        "version", "usecase", F.col("fields")["title"].alias("title"), F.col("b.workers").alias("workers"),
        F.size("b.created_at").cast("long").alias("tasks"), documents.printed_array("b.completed_at").alias("completed_at"),
        F.coalesce(F.size("b.worker_execution"), F.lit(0)).cast("long").alias("mapped"))


def _both_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The documents of all workflows by event history and by run document, derived from the same landed events."""
    life = _life(spark, sf_dir)
    histories = timing.correlate_event_history(fx.land(fx.event_history_pages(life)))
    runs = timing.pivot_task_events(fx.land(fx.run_document_pages(life)))
    old = _document(timing.normalize_workers(histories, "numeric"), 'the "old" one')
    return fx.land(old), _document(timing.normalize_workers(runs, "lexicographic"), "the new one")


def t14_document_upsert(spark, sf_dir):
    """A stored document of all workflows by their event histories takes their entries by run document."""
    return _stored_document(spark, *_both_documents(spark, sf_dir))


def k5_document_commits(spark, sf_dir):
    """Three commits: two use cases of every workflow by its event history, then one of them by its run document."""
    old, new = _both_documents(spark, sf_dir)
    history = old.withColumn("usecase", F.concat("usecase", F.lit("/history")))
    return _stored_document(spark, old, history, new)


def k4_document_segments(spark, sf_dir):
    """The documents by event history in pieces of 1,024 tasks, no row holding a whole workflow."""
    tt = timing.normalize_workers(_event_history_timing(spark, sf_dir), "numeric")
    arrays = fx.land(documents.benchmark_arrays(tt, "worker_index"))
    return documents.document_segments(arrays, "python", "run-log timings", "derived from events")


def t9_phase_rows(spark, sf_dir):
    tt = timing.phase_timing(_phase_times(spark, sf_dir))
    return timing.phase_breakdown_by_duration(tt).select(timing.DURATION_BREAKDOWN_COLUMNS)


def k8_phase_report(spark, sf_dir):
    return files.phase_report(timing.phase_breakdown_by_duration(timing.phase_timing(_phase_times(spark, sf_dir))))


def t5_dag_run_breakdown(spark, sf_dir):
    flat = timing.flatten_task_groups(_doc(spark, sf_dir, fx.dag_run_pages))
    tt = timing.phase_timing(timing.task_group_phases(flat))
    return timing.phase_breakdown_by_duration(tt).select(timing.DURATION_BREAKDOWN_COLUMNS)


def t12_csv_arrays(spark, sf_dir):
    """Phase rows through the timing CSV: written, read again in line order, then the arrays."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/timing-csv-{uuid.uuid4().hex}"
    files.write_timing_csv(_phase_times(spark, sf_dir), path, per_workflow=False)
    return timing.waiting_execution(runlogs.read_csv_phases(spark, path))


def s10_event_times(spark, sf_dir):
    history = fx.event_history_pages(_life(spark, sf_dir))
    return timing.event_times(history).select(WF, "event_id", "event_type", "event_time")


def _landed_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History pages landed as JSON, some twice, some missing, read by the reader."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pages-{uuid.uuid4().hex}"
    fx.landed_page_chains(_life(spark, sf_dir)).write.json(path)
    return runlogs.read_event_history(spark, path)


def s6_page_report(spark, sf_dir):
    return pages.page_report(_landed_chains(spark, sf_dir))


def s6_events_once(spark, sf_dir):
    """S10 over pages landed twice and out of order: each event once, with the number of its page in the chain."""
    once = pages.chained_pages(_landed_chains(spark, sf_dir))
    return timing.event_times(once).select(
        WF, F.floor(F.col("seq") / timing.SEQ_PAGE).cast("int").alias("page"), "event_id", "event_type", "event_time")


def a17_tasks_per_worker(spark, sf_dir):
    return timing.tasks_per_worker(timing.worker_starts(_doc(spark, sf_dir, fx.event_history_pages)))


def a17_worker_activities(spark, sf_dir):
    acts = documents.worker_activities(timing.worker_starts(_doc(spark, sf_dir, fx.event_history_pages)))
    return acts.select(WF, "worker", "chunk", "tasks", F.array_join("activities", ",").alias("activities"))


TIMING_BUILDERS = {
    "t1_correlate_event_history": t1_correlate_event_history,
    "t2_pivot_task_events": t2_pivot_task_events,
    "t3_bulk_task_times": t3_bulk_task_times,
    "t4_history_phase_times": t4_history_phase_times,
    "t5_flatten_task_groups": t5_flatten_task_groups,
    "t6_job_hierarchy": t6_job_hierarchy,
    "t7_relative_job_times": t7_relative_job_times,
    "t8_normalize_workers": t8_normalize_workers,
    "t9_phase_breakdown_by_duration": t9_phase_breakdown_by_duration,
    "k8_stats_report": k8_stats_report,
    "t10_phase_breakdown_by_means": t10_phase_breakdown_by_means,
    "t11_waiting_times": t11_waiting_times,
    "t12_waiting_execution_arrays": t12_waiting_execution_arrays,
    "k9_printed_arrays": k9_printed_arrays,
    "t13_timing_table": t13_timing_table,
    "t14_benchmark_document": t14_benchmark_document,
    "t14_document_upsert": t14_document_upsert,
    "k5_document_commits": k5_document_commits,
    "k4_document_segments": k4_document_segments,
    "t9_phase_rows": t9_phase_rows,
    "k8_phase_report": k8_phase_report,
    "t5_dag_run_breakdown": t5_dag_run_breakdown,
    "t12_csv_arrays": t12_csv_arrays,
    "s10_event_times": s10_event_times,
    "s6_page_report": s6_page_report,
    "s6_events_once": s6_events_once,
    "a17_tasks_per_worker": a17_tasks_per_worker,
    "a17_worker_activities": a17_worker_activities,
}
