"""Run-log documents derived from the ``events`` table (test layer).

No run log ships with the test data, so each document shape is built from
``events`` by one deterministic rule (the same rule the DuckDB oracle uses):

* a workflow is a ``user_id``; its events in ``(ts, event_id)`` order are
  numbered ``rn``; ``task_no = rn div 3``, ``phase = rn % 3`` with phases
  created / started / completed; the worker is ``props.k`` of the started
  row. The last task of a workflow may lack phases and must be dropped;
* the workflow starts one second before its first event.

Documents are split into pages of at most ``PAGE_TASKS`` tasks, so array
sizes stay bounded however long a workflow is. Everything is lazy Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.timefn import iso_string, micros
from tally.operators.sequence import ordinal
from tally.session import land  # noqa: F401 - landed run logs are reliable checkpoints

PAGE_TASKS = 32
PAGE_EVENTS = 3 * PAGE_TASKS
PHASE_NAMES = ["created", "started", "completed"]


def lifecycle_events(events: DataFrame) -> DataFrame:
    """One row per event: workflow_id, rn, task_no, phase, ts, k."""
    ev = events.select(
        F.col("user_id").cast("string").alias("workflow_id"),
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    ev = ordinal(ev, ["workflow_id"], ["ts", "event_id"], out="rn")
    return ev.select(
        "workflow_id", "rn", "ts", "k",
        F.floor(F.col("rn") / 3).cast("long").alias("task_no"),
        (F.col("rn") % 3).cast("int").alias("phase"),
    )


def workflow_starts(life: DataFrame) -> DataFrame:
    """workflow_id, start_at = first event - 1 s."""
    return life.groupBy("workflow_id").agg(
        (F.min("ts") - F.expr("INTERVAL 1 SECOND")).alias("start_at")
    )


def lifecycle_tasks(life: DataFrame) -> DataFrame:
    """One row per task with created/started/completed (NULL if missing) and worker k."""
    return life.groupBy("workflow_id", "task_no").agg(
        *[F.max(F.when(F.col("phase") == i, F.col("ts"))).alias(f"{name}_at") for i, name in enumerate(PHASE_NAMES)],
        F.max(F.when(F.col("phase") == 1, F.col("k"))).alias("k"),
    )


def _complete(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("created_at").isNotNull() & F.col("started_at").isNotNull()
                       & F.col("completed_at").isNotNull())


def event_history_pages(life: DataFrame, page_events: int = PAGE_EVENTS) -> DataFrame:
    """S6 shape: paged ``history.events`` with scheduled/started/completed events."""
    event_id = lambda n: (n + F.lit(2)).cast("string")  # noqa: E731 - id 1 is the start event
    base = F.col("rn") - F.col("phase")
    typ = F.element_at(F.array(*[F.lit(f"EVENT_TYPE_ACTIVITY_TASK_{t}") for t in
                                 ("SCHEDULED", "STARTED", "COMPLETED")]), F.col("phase") + 1)
    null_struct = F.lit(None)
    activity = F.struct(
        F.col("rn").alias("seq"),
        event_id(F.col("rn")).alias("eventId"),
        iso_string("ts").alias("eventTime"),
        typ.alias("eventType"),
        F.when(F.col("phase") == 0, F.struct(F.col("task_no").cast("string").alias("activityId")))
        .otherwise(null_struct).alias("activityTaskScheduledEventAttributes"),
        F.when(F.col("phase") == 1, F.struct(
            event_id(base).alias("scheduledEventId"),
            F.concat(F.col("k").cast("string"), F.lit("@fixture-host")).alias("identity"),
        )).otherwise(null_struct).alias("activityTaskStartedEventAttributes"),
        F.when(F.col("phase") == 2, F.struct(
            # Some completions name only the start that they end.
            F.when(F.col("task_no") % 5 != 4, event_id(base)).alias("scheduledEventId"),
            event_id(base + 1).alias("startedEventId"),
        )).otherwise(null_struct).alias("activityTaskCompletedEventAttributes"),
    )
    acts = life.select("workflow_id", F.floor(F.col("rn") / page_events).cast("int").alias("page"),
                       activity.alias("e"), "ts")
    act_pages = acts.groupBy("workflow_id", "page").agg(F.collect_list("e").alias("evs"), F.min("ts").alias("first"))
    # The start event is derived from the (small) page table, not from a second pass over events.
    start = act_pages.groupBy("workflow_id").agg(
        (F.min("first") - F.expr("INTERVAL 1 SECOND")).alias("start_at")).select(
        "workflow_id",
        F.lit(0).alias("page"),
        F.struct(
            F.lit(-1).cast("long").alias("seq"),
            F.lit("1").alias("eventId"),
            iso_string("start_at").alias("eventTime"),
            F.lit("EVENT_TYPE_WORKFLOW_EXECUTION_STARTED").alias("eventType"),
            F.lit(None).cast(acts.schema["e"].dataType["activityTaskScheduledEventAttributes"].dataType)
            .alias("activityTaskScheduledEventAttributes"),
            F.lit(None).cast(acts.schema["e"].dataType["activityTaskStartedEventAttributes"].dataType)
            .alias("activityTaskStartedEventAttributes"),
            F.lit(None).cast(acts.schema["e"].dataType["activityTaskCompletedEventAttributes"].dataType)
            .alias("activityTaskCompletedEventAttributes"),
        ).alias("e"),
    )
    # The start event goes first in page 0 (every workflow has a page 0).
    pages = (
        act_pages.join(start.select("workflow_id", "page", F.col("e").alias("start_e")), ["workflow_id", "page"], "left")
        .select("workflow_id", "page",
                F.sort_array(F.when(F.col("start_e").isNull(), F.col("evs"))
                             .otherwise(F.concat(F.array("start_e"), F.col("evs")))).alias("evs"))
    )
    return pages.select(
        "workflow_id",
        F.lit(None).cast("string").alias("run_id"),
        "page",
        F.struct(F.transform("evs", lambda x: x.dropFields("seq")).alias("events")).alias("history"),
        F.lit(None).cast("string").alias("nextPageToken"),
    )


CHAIN_EVENTS = 6


def landed_page_chains(life: DataFrame) -> DataFrame:
    """History pages of six events with their tokens, badly landed.

    Pages 1, 4, 7, .. are landed twice, all numbers are lost (0); workflows
    whose id leaves 3 by 7 lack their second page if they have three or more,
    and those that leave 5 lack their last page if they have two or more.
    """
    pages = event_history_pages(life, CHAIN_EVENTS)
    last = pages.groupBy("workflow_id").agg(F.max("page").alias("last"))
    token = lambda n: F.concat(F.lit("t-"), "workflow_id", F.lit("-"), n.cast("string"))
    page, left = F.col("page"), F.col("workflow_id").cast("long") % 7
    chained = pages.join(last, "workflow_id").withColumns({
        "pageToken": F.when(page > 0, token(page)), "nextPageToken": F.when(page < F.col("last"), token(page + 1))})
    kept = chained.where(~((left == 3) & (page == 1) & (F.col("last") >= 2)) & ~((left == 5) & (page == F.col("last")) & (page > 0)))
    copies = F.explode(F.when(page % 3 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return kept.select("*", copies).select("workflow_id", "run_id", F.lit(0).alias("page"), "history", "pageToken", "nextPageToken")


def run_document_pages(life: DataFrame) -> DataFrame:
    """S7 shape: ``run.createdAt``, paged ``shape``, ``taskEvents`` and ``tasks``."""
    tasks = lifecycle_tasks(life)
    ext_id = F.concat(F.col("workflow_id"), F.lit("-"), F.col("task_no").cast("string"))
    page = F.floor(F.col("task_no") / PAGE_TASKS).cast("int")
    shape = tasks.select("workflow_id", page.alias("page"), F.struct(
        F.col("task_no").alias("seq"),
        F.concat(F.lit("task_"), F.col("task_no").cast("string")).alias("taskName"),
        ext_id.alias("taskExternalId"),
    ).alias("s"))
    typ = F.element_at(F.array(F.lit("QUEUED"), F.lit("STARTED"), F.lit("FINISHED")), F.col("phase") + 1)
    task_events = life.select("workflow_id", page.alias("page"), F.struct(
        F.col("rn").alias("seq"),
        ext_id.alias("taskId"),
        typ.alias("eventType"),
        iso_string("ts").alias("timestamp"),
        F.when(F.col("phase") == 1, F.concat(F.lit("worker-"), F.col("k").cast("string"))).alias("workerId"),
    ).alias("t"))
    details = tasks.select("workflow_id", page.alias("page"), F.struct(
        F.col("task_no").alias("seq"),
        ext_id.alias("taskExternalId"),
        iso_string("created_at").alias("taskInsertedAt"),
        iso_string("started_at").alias("startedAt"),
        iso_string("completed_at").alias("finishedAt"),
        F.concat(F.lit("worker-"), F.col("k").cast("string")).alias("workerId"),
    ).alias("b"))
    shape_p = shape.groupBy("workflow_id", "page").agg(F.sort_array(F.collect_list("s")).alias("shape"))
    events_p = task_events.groupBy("workflow_id", "page").agg(F.sort_array(F.collect_list("t")).alias("taskEvents"))
    tasks_p = details.groupBy("workflow_id", "page").agg(F.sort_array(F.collect_list("b")).alias("tasks"))
    starts = workflow_starts(life).select("workflow_id", F.struct(iso_string("start_at").alias("createdAt")).alias("run"))
    drop_seq = lambda c: F.transform(c, lambda x: x.dropFields("seq"))
    return (
        shape_p.join(events_p, ["workflow_id", "page"], "full")
        .join(tasks_p, ["workflow_id", "page"], "full")
        .join(starts, "workflow_id")
        .select("workflow_id", "page", "run",
                drop_seq("shape").alias("shape"), drop_seq("taskEvents").alias("taskEvents"),
                drop_seq("tasks").alias("tasks"))
    )


def id_list(life: DataFrame) -> DataFrame:
    """S14 shape: (pos, workflow_id), every workflow once, in numeric id order."""
    ids = life.select("workflow_id").distinct().withColumn("wf_num", F.col("workflow_id").cast("long"))
    return ordinal(ids, [], "wf_num", out="pos").select("pos", "workflow_id")


def execution_pages(life: DataFrame) -> DataFrame:
    """S8 shape: ``taskRunList`` with a ``processIterations`` wrapper first, then complete tasks."""
    tasks = _complete(lifecycle_tasks(life))
    hist = lambda s, c: F.struct(F.lit(s).alias("state"), iso_string(c).alias("date"))
    runs = tasks.select("workflow_id", F.floor(F.col("task_no") / PAGE_TASKS).cast("int").alias("page"), F.struct(
        F.col("task_no").alias("seq"),
        F.concat(F.col("workflow_id"), F.lit("-"), F.col("task_no").cast("string")).alias("id"),
        F.when(F.col("task_no") % 2 == 0, F.lit("python")).otherwise(F.lit("script")).alias("taskId"),
        F.col("task_no").cast("string").alias("value"),
        F.struct(F.array(hist("CREATED", "created_at"), hist("RUNNING", "started_at"),
                         hist("SUCCESS", "completed_at")).alias("histories")).alias("state"),
    ).alias("r"))
    bounds = life.groupBy("workflow_id").agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
    wrapper = bounds.select("workflow_id", F.lit(0).alias("page"), F.struct(
        F.lit(-1).cast("long").alias("seq"),
        F.concat(F.col("workflow_id"), F.lit("-iterations")).alias("id"),
        F.lit("processIterations").alias("taskId"),
        F.lit(None).cast("string").alias("value"),
        F.struct(F.array(hist("CREATED", "first_at"), hist("RUNNING", "first_at"),
                         hist("SUCCESS", "last_at")).alias("histories")).alias("state"),
    ).alias("r"))
    pages = runs.unionByName(wrapper).groupBy("workflow_id", "page").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    return pages.select("workflow_id", "page", F.transform("rs", lambda x: x.dropFields("seq")).alias("taskRunList"))


def dag_run_pages(life: DataFrame) -> DataFrame:
    """S9 shape: ``groups.children[]`` with one instance per task (running tasks lack an end)."""
    tasks = lifecycle_tasks(life).where(F.col("created_at").isNotNull())
    done = F.col("completed_at").isNotNull()
    child = F.struct(
        F.col("task_no").alias("seq"),
        F.concat(F.lit("task_"), F.col("task_no").cast("string")).alias("id"),
        F.array(F.struct(
            iso_string("created_at").alias("queued_dttm"),
            iso_string("started_at").alias("start_date"),
            iso_string("completed_at").alias("end_date"),
            F.when(done, F.lit("success")).otherwise(F.lit("running")).alias("state"),
            F.lit(1).alias("try_number"),
        )).alias("instances"),
    )
    pages = (
        tasks.select("workflow_id", F.floor(F.col("task_no") / PAGE_TASKS).cast("int").alias("page"), child.alias("c"))
        .groupBy("workflow_id", "page").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    )
    return pages.select("workflow_id", "page",
                        F.struct(F.transform("cs", lambda x: x.dropFields("seq")).alias("children")).alias("groups"))


def job_tables(life: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S11 shape: (jobs, completions).

    Root ``r-<wf>`` (started at the workflow start), sub-parents
    ``s-<wf>-<task_no div 5>`` created/started at their first child's
    creation, children ``c-<wf>-<task_no>`` for complete tasks, one childless
    ``s-<wf>-empty``. Completions name worker ``wk-<k>``; workflows with
    ``id % 10 = 0`` have none.
    """
    tasks = _complete(lifecycle_tasks(life))
    starts = workflow_starts(life)
    wf = F.col("workflow_id")
    ms = F.expr("INTERVAL 1 SECOND")
    children = tasks.select(
        wf,
        F.concat(F.lit("c-"), wf, F.lit("-"), F.col("task_no").cast("string")).alias("id"),
        F.concat(F.lit("s-"), wf, F.lit("-"), F.floor(F.col("task_no") / 5).cast("string")).alias("parent_job"),
        "created_at", "started_at",
        F.floor((micros("completed_at") - micros("started_at")) / 1000).cast("long").alias("duration_ms"),
        "k",
    )
    subs = children.groupBy(wf, F.col("parent_job").alias("id")).agg(F.min("created_at").alias("created_at")).select(
        wf, "id", F.concat(F.lit("r-"), wf).alias("parent_job"), "created_at",
        F.col("created_at").alias("started_at"), F.lit(0).cast("long").alias("duration_ms"),
    )
    empty = starts.select(wf, F.concat(F.lit("s-"), wf, F.lit("-empty")).alias("id"),
                          F.concat(F.lit("r-"), wf).alias("parent_job"), F.col("start_at").alias("created_at"),
                          F.col("start_at").alias("started_at"), F.lit(0).cast("long").alias("duration_ms"))
    roots = starts.select(wf, F.concat(F.lit("r-"), wf).alias("id"), F.lit(None).cast("string").alias("parent_job"),
                          (F.col("start_at") - ms).alias("created_at"), F.col("start_at").alias("started_at"),
                          F.lit(0).cast("long").alias("duration_ms"))
    cols = ["id", "parent_job", "created_at", "started_at", "duration_ms"]
    jobs = roots.select(cols).unionByName(empty.select(cols)).unionByName(subs.select(cols)).unionByName(children.select(cols))
    completions = children.where(wf.cast("long") % 10 != 0).select(
        "id", F.concat(F.lit("wk-"), F.col("k").cast("string")).alias("worker"))
    return jobs, completions
