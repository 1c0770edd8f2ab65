"""Run-log timing operators (T1-T13), over every workflow at once.

Adapters turn each run-log shape into the canonical ``task_timing`` table::

    workflow_id string, task_no long, task string,
    created_at, started_at, completed_at, zero_at, own_created_at timestamp,
    worker string

(``own_created_at`` differs from ``created_at`` only for multi-worker job
hierarchies, where a task's creation is its sub-parent's.) Relative times are
derived from these columns as integer microseconds, never stored.

Order-dependent steps (previous / next task, first / last task, dense
positions) use ``tally.operators.sequence`` so a very large workflow is still
processed by many tasks; per-workflow totals are plain grouped aggregates
with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.timefn import (
    activity_label, clamp_round_ms, label_number, micros_between, normalize_event_type,
    parse_ts, percent, round_ms, seconds, strip_host, task_label,
)
from tally.operators.sequence import dense_index, ordinal
from tally.session import land

WF = "workflow_id"
TASK_TIMING_COLUMNS = ["workflow_id", "task_no", "task", "created_at", "started_at", "completed_at",
                       "zero_at", "own_created_at", "worker"]
SEQ_PAGE = 1_000_000_000    # event position = page * SEQ_PAGE + index in page
NO_NUMBER = 1 << 62         # order key for labels without a number (sorted last)

WORKFLOW_STARTED = "EVENT_TYPE_WORKFLOW_EXECUTION_STARTED"
ACTIVITY_SCHEDULED = "EVENT_TYPE_ACTIVITY_TASK_SCHEDULED"
ACTIVITY_STARTED = "EVENT_TYPE_ACTIVITY_TASK_STARTED"
ACTIVITY_COMPLETED = "EVENT_TYPE_ACTIVITY_TASK_COMPLETED"


def _seq(page_col: str = "page", pos_col: str = "_pos"):
    return F.col(page_col).cast("long") * F.lit(SEQ_PAGE) + F.col(pos_col)


def _explode(df: DataFrame, array_col: str, keep=(WF, "page")) -> DataFrame:
    """posexplode an array of documents; ``seq`` orders elements across pages."""
    return (
        df.select(*keep, F.posexplode(array_col).alias("_pos", "_e"))
        .withColumn("seq", _seq())
    )


def _task_order(df: DataFrame, out: str = "pos", previous=(), following=()) -> DataFrame:
    """Dense position by numeric task suffix (labels without a number last, by text).

    A ``pos`` column already present is taken as that dense order (operators
    that number tasks themselves, such as ``relative_job_times``, provide it).
    ``previous`` / ``following`` add the neighbouring task's values
    (``prev_<c>`` / ``next_<c>``) from the same window pass.
    """
    if out in df.columns:
        if not previous and not following:
            return df
        return ordinal(df, [WF], out, out="_given_pos", previous=previous, following=following).drop("_given_pos")
    keyed = df.withColumn("_tn", F.coalesce(F.col("task_no"), F.lit(NO_NUMBER)))
    return ordinal(keyed, [WF], "_tn", out=out, tie_cols=("task",), previous=previous, following=following).drop("_tn")


def relative_us(df: DataFrame, cols=("created_at", "started_at", "completed_at")) -> DataFrame:
    """Add ``<c>_us`` = microseconds from ``zero_at`` for each column."""
    return df.withColumns({f"{c}_us": micros_between("zero_at", c) for c in cols})


# --- T1: event-history correlation -------------------------------------------


def _history_events(pages: DataFrame) -> DataFrame:
    """One row per event with a parsable time (P18), in event order by ``seq``."""
    return _explode(pages, "history.events").select(
        WF,
        F.coalesce(F.col("_e.eventId").try_cast("long"), F.col("seq")).alias("seq"),
        F.col("_e.eventId").alias("event_id"),
        normalize_event_type("_e.eventType").alias("etype"),
        parse_ts("_e.eventTime").alias("t"),
        F.col("_e.activityTaskScheduledEventAttributes.activityId").alias("activity_id"),
        F.col("_e.activityTaskStartedEventAttributes.scheduledEventId").alias("scheduled_ref"),
        F.col("_e.activityTaskStartedEventAttributes.identity").alias("identity"),
        F.col("_e.activityTaskCompletedEventAttributes.startedEventId").alias("started_ref"),
    ).where(F.col("t").isNotNull())


def correlate_event_history(pages: DataFrame) -> DataFrame:
    """Scheduled / started / completed events -> one row per finished activity.

    * events with a missing or unparsable time are skipped (P18);
    * time zero is the first WORKFLOW_EXECUTION_STARTED (by event id); a
      workflow without one yields no rows;
    * label: missing activityId -> ``task_%02d`` of the running number of
      scheduled events, digits -> ``task_%02d``, else verbatim;
    * a completed event belongs to the started event that its
      ``startedEventId`` names, any of the activity's starts, and with it to
      that event's scheduled event; ``scheduledEventId`` of a completion isn't
      needed. Of several starts and completions the latest of each counts;
    * for a repeated label the latest scheduled event wins, with only its own
      started/completed events;
    * activities lacking a phase are dropped (P16).

    Runs jobs when called: the per-activity groups are landed
    (``tally.session.land``) because three branches read them.
    """
    ev = _history_events(pages)

    # Two hops, an exchange each, both on (workflow, event id), so a hot workflow is cut by its events:
    # a completion meets the start it names, then starts meet their scheduled event;
    # WORKFLOW_EXECUTION_STARTED events share the NULL key of their workflow.
    etype = F.col("etype")
    of = lambda name: F.when(etype == name, F.col("seq"))
    attempts = (
        ev.where(etype.isin(ACTIVITY_STARTED, ACTIVITY_COMPLETED))
        .withColumn("start_event", F.when(etype == ACTIVITY_STARTED, F.col("event_id")).otherwise(F.col("started_ref")))
        .groupBy(WF, "start_event")
        .agg(F.max_by(F.struct("t", "identity", "seq", "scheduled_ref"), of(ACTIVITY_STARTED)).alias("a"),
             F.max_by(F.struct("t", "seq"), of(ACTIVITY_COMPLETED)).alias("c"))
        .where(F.col("start_event").isNotNull() & F.col("a.scheduled_ref").isNotNull())
        .select(WF, F.col("a.scheduled_ref").alias("sched_event"), "a", F.when(F.col("c.seq") > F.col("a.seq"), F.col("c")).alias("c"))
    )
    opened = ev.where(etype.isin(WORKFLOW_STARTED, ACTIVITY_SCHEDULED)).select(
        WF, F.when(etype == ACTIVITY_SCHEDULED, F.col("event_id")).alias("sched_event"), "etype", "seq", "t", "activity_id")
    grouped = (
        opened.unionByName(attempts, allowMissingColumns=True)
        .groupBy(WF, "sched_event")
        .agg(
            F.max_by(F.struct("t", "activity_id", "seq"), of(ACTIVITY_SCHEDULED)).alias("s"),
            F.max_by("a", F.col("a.seq")).alias("a"),
            F.max_by("c", F.col("c.seq")).alias("c"),
            F.min_by("t", of(WORKFLOW_STARTED)).alias("zero_at"),
        )
    )
    # ``grouped`` feeds three branches (time zero, the activities, and the
    # sampling for their ordinal); their pruned exchanges differ, so
    # without landing each branch would explode and shuffle the whole history
    # again. Landed once, every branch reads it.
    grouped = land(grouped)
    zero = grouped.where(F.col("sched_event").isNull() & F.col("zero_at").isNotNull()).select(WF, "zero_at")
    scheduled = grouped.where(F.col("sched_event").isNotNull() & F.col("s.t").isNotNull()).select(
        WF, F.col("s.seq").alias("sched_seq"), F.col("s.activity_id").alias("activity_id"),
        F.col("s.t").alias("created_at"), F.col("a.t").alias("started_at"), F.col("a.identity").alias("worker"),
        F.col("c.t").alias("completed_at"),
    )
    labelled = ordinal(scheduled, [WF], "sched_seq", out="sched_no").withColumn(
        "task", activity_label("activity_id", "sched_no"))
    # Latest scheduled event per label wins, with only its own started/completed events.
    latest = (
        labelled.groupBy(WF, "task")
        .agg(F.max_by(F.struct("created_at", "started_at", "worker", "completed_at"), "sched_seq").alias("l"))
        .select(WF, "task", "l.*")
        .where(F.col("started_at").isNotNull() & F.col("completed_at").isNotNull())
    )
    return latest.join(zero, WF).select(
        WF,
        label_number("task", 1).alias("task_no"),
        "task", "created_at", "started_at", "completed_at", "zero_at",
        F.col("created_at").alias("own_created_at"),
        "worker",
    )


# --- T2 / T3: run documents ----------------------------------------------------


def _run_zero(docs: DataFrame) -> DataFrame:
    return docs.groupBy(WF).agg(F.min_by(parse_ts("run.createdAt"), "page").alias("zero_at"))


def pivot_task_events(docs: DataFrame) -> DataFrame:
    """QUEUED / STARTED / FINISHED events -> created / started / completed per task.

    The last event of a (task, type) wins (by document position); the worker
    is that of the last STARTED event naming one, else ``unknown``; tasks
    missing a phase are dropped; time zero is ``run.createdAt``.
    """
    # One pass: names and events of a page are exploded together and meet in
    # one aggregate per task id; a repeated name then keeps its last id.
    nothing = F.lit(None).cast("string")
    name = lambda x: F.struct(x["taskExternalId"].alias("task_id"), x["taskName"].alias("task"),
                              nothing.alias("etype"), nothing.alias("t"), nothing.alias("worker"))
    event = lambda x: F.struct(x["taskId"].alias("task_id"), nothing.alias("task"), x["eventType"].alias("etype"),
                               x["timestamp"].alias("t"), x["workerId"].alias("worker"))
    none = F.array().cast("array<struct<task_id string, task string, etype string, t string, worker string>>")
    both = F.concat(F.coalesce(F.transform("shape", name), none), F.coalesce(F.transform("taskEvents", event), none))
    rows = _explode(docs.select(WF, "page", both.alias("rows")), "rows").select(
        WF, "seq", "_e.task_id", "_e.task", "_e.etype", parse_ts("_e.t").alias("t"), "_e.worker")
    timed = lambda kind: F.when((F.col("etype") == kind) & F.col("t").isNotNull(), F.col("seq"))
    per_id = rows.groupBy(WF, "task_id").agg(
        F.collect_list(F.when(F.col("task").isNotNull(), F.struct("task", "seq"))).alias("names"),
        F.max_by("t", timed("QUEUED")).alias("created_at"),
        F.max_by("t", timed("STARTED")).alias("started_at"),
        F.max_by("t", timed("FINISHED")).alias("completed_at"),
        F.max_by("worker", F.when(F.col("worker").isNotNull(), timed("STARTED"))).alias("worker"),
    ).where(F.col("task_id").isNotNull())
    last = (
        per_id.withColumn("_n", F.explode("names"))
        .groupBy(WF, F.col("_n.task").alias("task"))
        .agg(F.max_by(F.struct("created_at", "started_at", "completed_at", "worker"), "_n.seq").alias("p"))
        .select(WF, "task", "p.*")
    )
    return (
        last.where(F.col("created_at").isNotNull() & F.col("started_at").isNotNull() & F.col("completed_at").isNotNull())
        .join(_run_zero(docs), WF)
        .select(
            WF,
            label_number("task", -1).alias("task_no"),
            "task", "created_at", "started_at", "completed_at", "zero_at",
            F.col("created_at").alias("own_created_at"),
            F.coalesce("worker", F.lit("unknown")).alias("worker"),
        )
    )


def bulk_task_times(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The first task of each listed run, relative to that run's own ``createdAt``.

    ``ids`` has (pos, workflow_id) in list order; duplicates repeat, unknown
    ids are skipped. Output keeps ``pos``.
    """
    # Only listed runs are grouped: the list meets the documents below their first exchange, as a
    # broadcast if AQE finds it small, else as a runtime filter and a semi join whose partitions the grouping reuses.
    listed = ids.select(WF).distinct()
    first = (
        docs.where(F.size("tasks") > 0)
        .join(listed, WF, "left_semi")
        .groupBy(WF)
        .agg(F.min_by(F.struct(F.col("run.createdAt").alias("zero"), F.get("tasks", 0).alias("t")), "page").alias("d"))
        .select(
            WF,
            parse_ts("d.zero").alias("zero_at"),
            parse_ts("d.t.taskInsertedAt").alias("created_at"),
            parse_ts("d.t.startedAt").alias("started_at"),
            parse_ts("d.t.finishedAt").alias("completed_at"),
            F.coalesce(F.col("d.t.workerId"), F.lit("unknown")).alias("worker"),
        )
    )
    return ids.select("pos", WF).join(first, WF).where(
        F.col("created_at").isNotNull() & F.col("started_at").isNotNull() & F.col("completed_at").isNotNull()
    )


def clamped_relative(df: DataFrame) -> DataFrame:
    """``max(0, round(t - zero, 3))`` for created/started/completed (run-document convention)."""
    return df.withColumns({c: clamp_round_ms(micros_between("zero_at", c)) for c in
                           ("created_at", "started_at", "completed_at")})


# --- T4 / T5: execution and DAG-run documents -------------------------------


def history_phase_times(executions: DataFrame, task_types=("python", "script")) -> DataFrame:
    """T4: created/running/success = ``histories[0..2]``; assignment, execution,
    transition (0 for the first kept task) and total, in list order.

    Tasks of other types are skipped (P15); tasks with fewer than three
    parseable history dates are skipped too.
    """
    runs = _explode(executions, "taskRunList").where(F.col("_e.taskId").isin(*task_types))
    h = F.col("_e.state.histories")
    runs = runs.select(
        WF, "seq",
        F.col("_e.id").alias("task_run_id"),
        F.coalesce(F.col("_e.value"), F.lit("N/A")).alias("value"),
        parse_ts(F.get(h, 0)["date"]).alias("created_at"),
        parse_ts(F.get(h, 1)["date"]).alias("started_at"),
        parse_ts(F.get(h, 2)["date"]).alias("success_at"),
    ).where(F.col("created_at").isNotNull() & F.col("started_at").isNotNull() & F.col("success_at").isNotNull())
    runs = ordinal(runs, [WF], "seq", out="pos", previous=("success_at",))
    transition = F.coalesce(micros_between("prev_success_at", "created_at"), F.lit(0))
    assignment = micros_between("created_at", "started_at")
    execution = micros_between("started_at", "success_at")
    return runs.select(
        WF, "pos", "task_run_id", "value", "created_at", "started_at", "success_at",
        seconds(transition).alias("transition_s"),
        seconds(assignment).alias("assignment_s"),
        seconds(execution).alias("execution_s"),
        seconds(transition + assignment + execution).alias("total_s"),
        transition.alias("transition_us"),
        assignment.alias("assignment_us"),
        execution.alias("execution_us"),
    )


def flatten_task_groups(dag_runs: DataFrame) -> DataFrame:
    """T5: id, queued, start and end of each child's first instance."""
    first = F.get(F.col("_e.instances"), 0)
    return _explode(dag_runs, "groups.children").select(
        WF, "seq",
        F.col("_e.id").alias("id"),
        first["queued_dttm"].alias("queued_dttm"),
        first["start_date"].alias("start_date"),
        first["end_date"].alias("end_date"),
    )


def phase_timing(phases: DataFrame) -> DataFrame:
    """Phase rows (``workflow_id, pos, created_at, started_at, success_at``) -> ``task_timing``.

    Time zero is the first row's creation; tasks are ``task_%02d`` by position.
    """
    zero = phases.groupBy(WF).agg(F.min_by("created_at", "pos").alias("zero_at"))
    return phases.join(zero, WF).select(
        WF, F.col("pos").alias("task_no"), "pos", task_label("pos").alias("task"), "created_at", "started_at",
        F.col("success_at").alias("completed_at"), "zero_at", F.col("created_at").alias("own_created_at"),
        F.lit(None).cast("string").alias("worker"))


def task_group_phases(flat: DataFrame) -> DataFrame:
    """``flatten_task_groups`` rows -> phase rows; tasks without all three times are left out."""
    timed = flat.select(WF, "seq", F.col("id").alias("task_run_id"), parse_ts("queued_dttm").alias("created_at"),
                        parse_ts("start_date").alias("started_at"), parse_ts("end_date").alias("success_at"))
    whole = timed.dropna(subset=["created_at", "started_at", "success_at"])
    return ordinal(whole, [WF], "seq", out="pos").select(WF, "pos", "task_run_id", "created_at", "started_at", "success_at")


# --- T6 / T7: job hierarchies ------------------------------------------------


def job_hierarchy(jobs: DataFrame, completions: DataFrame, roots: DataFrame | None = None,
                  multi_worker: bool = True) -> DataFrame:
    """The jobs under each root.

    Single worker: the root's direct children. Multi worker: root ->
    sub-parent -> child, with the child's worker from ``completions`` (left
    joins); sub-parents without children are dropped (P17).
    ``roots`` (``root_id``) defaults to jobs without a parent. Rows carry
    their root's start as ``root_started_at``.
    """
    starts = jobs.select(F.col("id").alias("root_id"), F.col("started_at").alias("root_started_at"), "parent_job")
    if roots is None:
        roots = starts.where(F.col("parent_job").isNull()).drop("parent_job")
    else:
        roots = starts.drop("parent_job").join(roots.select("root_id"), "root_id")
    children = jobs.select("id", "parent_job", "created_at", "started_at", "duration_ms")
    if not multi_worker:
        return (
            children.join(roots, F.col("parent_job") == F.col("root_id"))
            .select("root_id", "root_started_at", "id", "parent_job", "created_at", "started_at", "duration_ms",
                    F.lit(None).cast("string").alias("worker"))
        )
    subs = jobs.join(roots, F.col("parent_job") == F.col("root_id")).select(
        "root_id", "root_started_at",
        F.col("id").alias("sub_parent_id"),
        F.col("created_at").alias("sub_parent_created_at"),
        F.col("started_at").alias("sub_parent_started_at"),
    )
    return (
        subs.join(children, F.col("parent_job") == F.col("sub_parent_id"), "left")
        .join(completions.select("id", "worker"), "id", "left")
        .where(F.col("id").isNotNull())
        .select("root_id", "root_started_at", "sub_parent_id", "sub_parent_created_at", "sub_parent_started_at",
                "id", "parent_job", "created_at", "started_at", "duration_ms", "worker")
    )


def relative_job_times(hierarchy: DataFrame, multi_worker: bool = True) -> DataFrame:
    """Hierarchy rows -> ``task_timing``.

    Zero is the root's ``started_at``; multi-worker rows take their
    sub-parent's creation as ``created_at`` and keep their own in
    ``own_created_at``; completed = started + duration_ms. Tasks are numbered
    ``task_%02d`` in creation order (sub-parent creation first when multi-worker).
    """
    df = hierarchy.withColumn("zero_at", F.col("root_started_at"))
    if multi_worker:
        order, created = ["sub_parent_created_at", "sub_parent_id", "created_at", "id"], F.col("sub_parent_created_at")
    else:
        order, created = ["created_at", "id"], F.col("created_at")
    df = ordinal(df, ["root_id"], order, out="task_no")
    return df.select(
        F.col("root_id").alias(WF),
        "task_no",
        F.col("task_no").alias("pos"),
        task_label("task_no").alias("task"),
        created.alias("created_at"),
        "started_at",
        F.timestamp_add("MILLISECOND", F.col("duration_ms"), F.col("started_at")).alias("completed_at"),
        "zero_at",
        F.col("created_at").alias("own_created_at"),
        "worker",
    )


# --- T8: worker normalisation ----------------------------------------------


def normalize_workers(tt: DataFrame, order: str = "lexicographic", out: str = "worker_index") -> DataFrame:
    """Dense 0-based worker index per workflow; NULL worker -> -1.

    ``lexicographic`` sorts the worker text; ``numeric`` strips ``@host`` and
    sorts by the number (non-numbers after numbers, by text).
    """
    if order == "lexicographic":
        return dense_index(tt, [WF], "worker", [F.col("worker")], out=out)
    if order != "numeric":
        raise ValueError(order)
    keyed = tt.withColumn("_clean", strip_host("worker"))
    num = F.col("_clean").try_cast("long")
    return dense_index(keyed, [WF], "_clean", [num.asc_nulls_last(), F.col("_clean")], out=out).drop("_clean")


# --- T9 / T10: phase breakdowns -----------------------------------------------


def phase_breakdown_by_duration(tt: DataFrame) -> DataFrame:
    """Per workflow, averages and % of total duration for execution,
    assignment and transition.

    Total duration is the **last** task's completion (relative); assignment is
    ``started - own_created``; transition is ``next.created - completed`` over
    the n-1 gaps (0 when n = 1; negative when tasks overlap).
    """
    df = relative_us(tt, ("created_at", "started_at", "completed_at", "own_created_at"))
    df = _task_order(df, following=("created_at_us",))
    agg = df.groupBy(WF).agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.max_by("completed_at_us", "pos").alias("total_us"),
        F.sum(F.col("completed_at_us") - F.col("started_at_us")).alias("exec_us"),
        F.sum(F.col("started_at_us") - F.col("own_created_at_us")).alias("assign_us"),
        F.sum(F.col("next_created_at_us") - F.col("completed_at_us")).alias("trans_us"),
    )
    n = F.col("total_tasks")
    many = n > 1
    return agg.select(
        WF,
        n.cast("long").alias("total_tasks"),
        seconds("total_us").alias("total_duration"),
        (F.col("exec_us") / n / F.lit(1e6)).alias("avg_execution"),
        percent("exec_us", "total_us").alias("execution_pct"),
        (F.col("assign_us") / n / F.lit(1e6)).alias("avg_assignment"),
        percent("assign_us", "total_us").alias("assignment_pct"),
        F.when(many, F.col("trans_us") / (n - 1) / F.lit(1e6)).otherwise(F.lit(0.0)).alias("avg_transition"),
        F.when(many, percent("trans_us", "total_us")).otherwise(F.lit(0.0)).alias("transition_pct"),
        "total_us", "exec_us", "assign_us", "trans_us",
    )


DURATION_BREAKDOWN_COLUMNS = ["workflow_id", "total_tasks", "total_duration", "avg_execution", "execution_pct",
                              "avg_assignment", "assignment_pct", "avg_transition", "transition_pct"]


def phase_breakdown_by_means(phases: DataFrame) -> DataFrame:
    """Per workflow, % of each phase mean over the sum of means (transition
    averaged over all n tasks, the first counting 0), plus total running time
    ``max(success) - min(created)``. Input: ``history_phase_times`` output.
    """
    agg = phases.groupBy(WF).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.sum("assignment_us").alias("a"),
        F.sum("execution_us").alias("e"),
        F.sum("transition_us").alias("t"),
        F.max("success_at").alias("last_success"),
        F.min("created_at").alias("first_created"),
    )
    n = F.col("tasks")
    total = F.col("a") + F.col("e") + F.col("t")
    return agg.select(
        WF,
        n.cast("long").alias("tasks"),
        (F.col("e") / n / F.lit(1e6)).alias("avg_execution"),
        (F.col("a") / n / F.lit(1e6)).alias("avg_assignment"),
        (F.col("t") / n / F.lit(1e6)).alias("avg_transition"),
        percent("e", total).alias("execution_pct"),
        percent("a", total).alias("assignment_pct"),
        percent("t", total).alias("transition_pct"),
        seconds(micros_between("first_created", "last_success")).alias("total_running_time"),
    )


# --- T11 / T12 / T13: waits, arrays, tables -----------------------------------


def waiting_times(tt: DataFrame) -> DataFrame:
    """First task ``started - created``; others ``started - previous completed``."""
    df = _task_order(tt, previous=("completed_at",))
    wait = micros_between(F.coalesce(F.col("prev_completed_at"), F.col("created_at")), F.col("started_at"))
    return df.withColumn("waiting_time", seconds(wait)).drop("prev_completed_at")


def waiting_execution(phases: DataFrame) -> DataFrame:
    """waiting = started - created, execution = success - started, 3 decimals."""
    return phases.select(
        WF, "pos",
        round_ms(micros_between("created_at", "started_at")).alias("waiting_time"),
        round_ms(micros_between("started_at", "success_at")).alias("execution_time"),
    )


TIMING_TABLE_HEADER = [
    "|  **Task**   | **Created at** | **Started at** | **Completed at** |",
    "| :---------: | -------------: | -------------: | ---------------: |",
]


def timing_table(phases: DataFrame) -> DataFrame:
    """One markdown row per task, times relative to the first row's creation.

    The first row's creation per workflow is a grouped ``min_by`` joined
    back on the workflow id (AQE broadcasts it when small).
    """
    ref = phases.groupBy(WF).agg(F.min_by("created_at", "pos").alias("ref_at"))
    df = phases.join(ref, WF)
    rel = lambda c: round_ms(micros_between("ref_at", c))
    return df.select(
        WF, "pos",
        rel("created_at").alias("relative_created"),
        rel("started_at").alias("relative_started"),
        rel("success_at").alias("relative_completed"),
    ).withColumn(
        "line",
        F.format_string("| **task_%02d** | %14.3f | %14.3f | %16.3f |",
                        F.col("pos"), F.col("relative_created"), F.col("relative_started"),
                        F.col("relative_completed")),
    )


# --- S10 / A17: event filter and tasks per worker -----------------------------


def event_times(pages: DataFrame, types=(ACTIVITY_SCHEDULED, ACTIVITY_STARTED, ACTIVITY_COMPLETED)) -> DataFrame:
    """Events of the given types (either spelling) with their time, per workflow."""
    wanted = [t if t.startswith("EVENT_TYPE_") else f"EVENT_TYPE_{t}" for t in types]
    ev = _explode(pages, "history.events").select(
        WF, "seq",
        F.col("_e.eventId").alias("event_id"),
        normalize_event_type("_e.eventType").alias("event_type"),
        F.col("_e.eventTime").alias("event_time"),
    )
    return ev.where(F.col("event_type").isin(*wanted))


def worker_starts(pages: DataFrame) -> DataFrame:
    """One row per STARTED event of a scheduled activity, completed or not.

    ``workflow_id, worker, task, task_no, seq, started_at``; ``seq`` is the event order. Labels
    are those of ``correlate_event_history``; a started event counts if its
    scheduled event came before it. A missing identity is the empty worker.
    """
    ev = _history_events(pages)
    scheduled = ordinal(ev.where(F.col("etype") == ACTIVITY_SCHEDULED).select(WF, "event_id", "activity_id", F.col("seq").alias("sched_seq")),
                        [WF], "sched_seq", out="sched_no")
    labelled = scheduled.select(WF, F.col("event_id").alias("scheduled_ref"), "sched_seq",
                                activity_label("activity_id", "sched_no").alias("task"))
    started = ev.where(F.col("etype") == ACTIVITY_STARTED).select(
        WF, "scheduled_ref", "seq", F.coalesce("identity", F.lit("")).alias("worker"), F.col("t").alias("started_at"))
    return (started.join(labelled, [WF, "scheduled_ref"]).where(F.col("sched_seq") < F.col("seq"))
            .select(WF, "worker", "task", label_number("task", 1).alias("task_no"), "seq", "started_at"))


def tasks_per_worker(starts: DataFrame) -> DataFrame:
    """Per (workflow, worker) the number of started tasks and the first / last by task number.

    Labels without a number come after those with one, by text. The full
    worker -> tasks mapping is ``worker_starts`` itself; it is not packed into
    one list per worker, which could be unbounded.
    """
    by_number = F.struct(F.col("task_no").isNull().alias("unnumbered"), "task_no", "task")
    return starts.groupBy(WF, "worker").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.min(by_number)["task"].alias("first_task"),
        F.max(by_number)["task"].alias("last_task"),
    )
