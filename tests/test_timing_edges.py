"""Edge cases of the timing operators, on hand-made run logs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tally.operators import timing
from tally.operators.sequence import dense_index, ordinal
from tally.sources import runlogs

T0 = datetime(2024, 1, 1, 12, 0, 0)


def iso(sec: float) -> str:
    return (T0 + timedelta(seconds=sec)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def ev(eid, sec, etype, **attrs):
    e = {"eventId": str(eid), "eventTime": iso(sec) if isinstance(sec, (int, float)) else sec, "eventType": etype}
    e.update(attrs)
    return e


def activity(eid, t, activity_id, worker="1@h", dur=1.0, wait=0.5):
    """Scheduled, started and completed events with ids eid, eid+1, eid+2."""
    return [
        ev(eid, t, "EVENT_TYPE_ACTIVITY_TASK_SCHEDULED",
           activityTaskScheduledEventAttributes={"activityId": activity_id}),
        ev(eid + 1, t + wait, "EVENT_TYPE_ACTIVITY_TASK_STARTED",
           activityTaskStartedEventAttributes={"scheduledEventId": str(eid), "identity": worker}),
        ev(eid + 2, t + wait + dur, "EVENT_TYPE_ACTIVITY_TASK_COMPLETED",
           activityTaskCompletedEventAttributes={"scheduledEventId": str(eid), "startedEventId": str(eid + 1)}),
    ]


def history(spark, wf_events):
    rows = [{"workflow_id": wf, "page": 0, "history": {"events": evs}} for wf, evs in wf_events.items()]
    return spark.createDataFrame(rows, runlogs.EVENT_HISTORY)


START = ev(1, 0, "EVENT_TYPE_WORKFLOW_EXECUTION_STARTED")


def test_labels_ordering_and_waits(spark):
    evs = [START] + activity(10, 1, None) + activity(20, 5, "7") + activity(30, 9, "task_8") + activity(40, 13, "")
    out = timing.waiting_times(timing.correlate_event_history(history(spark, {"w": evs}))).orderBy("pos").collect()
    # missing id -> running number of scheduled events (0, then 3); digits -> task_%02d; else verbatim
    assert [r.task for r in out] == ["task_00", "task_03", "task_07", "task_8"]
    # first: started - created; others: started - previous completed (in label order)
    first = out[0]
    assert (first.started_at - first.created_at).total_seconds() == first.waiting_time == 0.5
    assert out[1].waiting_time == (out[1].started_at - out[0].completed_at).total_seconds()


def test_skips_unparsable_incomplete_and_startless(spark):
    evs = [START] + activity(10, 1, "0") + activity(20, 5, "1")[:2]  # task 1 never completes
    evs.append(ev(30, "not a time", "EVENT_TYPE_ACTIVITY_TASK_SCHEDULED",
                  activityTaskScheduledEventAttributes={"activityId": "2"}))
    no_start = activity(10, 1, "0")
    out = timing.correlate_event_history(history(spark, {"w": evs, "no-start": no_start})).collect()
    assert [(r.workflow_id, r.task) for r in out] == [("w", "task_00")]


def test_duplicate_label_latest_scheduled_wins(spark):
    evs = [START] + activity(10, 1, "3", worker="1@h") + activity(20, 5, "3", worker="2@h")
    (row,) = timing.correlate_event_history(history(spark, {"w": evs})).collect()
    assert row.worker == "2@h" and row.created_at == T0 + timedelta(seconds=5)


def test_completion_by_the_start_it_names(spark):
    """Without a scheduledEventId; naming the earlier of two starts; naming none; naming a start that comes after it."""
    def done(eid, t, **ids):
        return ev(eid, t, "EVENT_TYPE_ACTIVITY_TASK_COMPLETED", activityTaskCompletedEventAttributes=ids)

    def again(eid, t, scheduled, worker):
        return ev(eid, t, "EVENT_TYPE_ACTIVITY_TASK_STARTED", activityTaskStartedEventAttributes={"scheduledEventId": str(scheduled), "identity": worker})

    evs = [START] + activity(10, 1, "1")[:2] + [done(12, 3, startedEventId="11")]
    evs += activity(20, 5, "2", worker="1@h")[:2] + [again(22, 7, 20, "2@h"), done(23, 8, scheduledEventId="20", startedEventId="21")]
    evs += activity(30, 10, "3")[:2] + [done(32, 12, scheduledEventId="30")]
    evs += [activity(40, 13, "4")[0], done(41, 14, startedEventId="42"), again(42, 15, 40, "1@h")]
    evs += activity(50, 16, "5")[:2] + [done(52, 18, scheduledEventId="999", startedEventId="51"), done(53, 19, startedEventId="51")]
    out = {r.task: r for r in timing.correlate_event_history(history(spark, {"w": evs})).collect()}
    at = lambda sec: T0 + timedelta(seconds=sec)
    assert sorted(out) == ["task_01", "task_02", "task_05"]
    assert out["task_01"].completed_at == at(3) and out["task_05"].completed_at == at(19)
    assert (out["task_02"].started_at, out["task_02"].worker, out["task_02"].completed_at) == (at(7), "2@h", at(8))


def test_nanosecond_times_and_zero(spark):
    evs = [ev(1, "2024-01-01T12:00:00.000000999Z", "WorkflowExecutionStarted")] + activity(10, 1.25, "0")
    (row,) = timing.correlate_event_history(history(spark, {"w": evs})).collect()
    assert row.zero_at == T0 and row.created_at == T0 + timedelta(seconds=1.25)


def run_doc(spark, wf, shape, events, created=0):
    row = {"workflow_id": wf, "page": 0, "run": {"createdAt": iso(created)},
           "shape": [{"taskName": n, "taskExternalId": i} for n, i in shape],
           "taskEvents": [{"taskId": i, "eventType": t, "timestamp": iso(s), "workerId": w} for i, t, s, w in events]}
    return spark.createDataFrame([row], runlogs.RUN_DOCUMENT)


def test_pivot_last_event_wins_missing_phase_and_unknown_worker(spark):
    shape = [("fibo_task_2", "b"), ("fibo_task_10", "c"), ("fibo_task_1", "a")]
    events = [
        ("a", "QUEUED", 1, None), ("a", "QUEUED", 2, None), ("a", "STARTED", 3, "w2"), ("a", "FINISHED", 4, None),
        ("b", "QUEUED", 1, None), ("b", "STARTED", 2, None), ("b", "FINISHED", 5, None),
        ("c", "QUEUED", 1, None), ("c", "STARTED", 2, "w1"),  # never finished -> dropped
    ]
    tt = timing.normalize_workers(timing.pivot_task_events(run_doc(spark, "r", shape, events)))
    out = timing.clamped_relative(tt).orderBy("task_no").collect()
    assert [r.task for r in out] == ["fibo_task_1", "fibo_task_2"]
    assert out[0].created_at == 2.0 and out[0].worker == "w2"
    assert out[1].worker == "unknown"
    assert [r.worker_index for r in out] == [1, 0]  # "unknown" < "w2"


def test_clamp_at_zero(spark):
    events = [("a", "QUEUED", -2, None), ("a", "STARTED", 1, None), ("a", "FINISHED", 2, None)]
    (row,) = timing.clamped_relative(timing.pivot_task_events(run_doc(spark, "r", [("t_0", "a")], events))).collect()
    assert row.created_at == 0.0


def test_worker_orders_numeric_vs_lexicographic(spark):
    workers = ["9@a", "10@b", "11@c", "2@d", "x@e", "3"]
    rows = [("w", i, f"task_{i:02d}", T0, T0, T0, T0, T0, wk) for i, wk in enumerate(workers)]
    rows.append(("w", 99, "task_99", T0, T0, T0, T0, T0, None))
    tt = spark.createDataFrame(rows, "workflow_id string, task_no long, task string, created_at timestamp, "
                                     "started_at timestamp, completed_at timestamp, zero_at timestamp, "
                                     "own_created_at timestamp, worker string")
    num = {r.worker: r.worker_index for r in timing.normalize_workers(tt, "numeric").collect()}
    lex = {r.worker: r.worker_index for r in timing.normalize_workers(tt, "lexicographic").collect()}
    assert num == {"2@d": 0, "3": 1, "9@a": 2, "10@b": 3, "11@c": 4, "x@e": 5, None: -1}
    assert lex == {"10@b": 0, "11@c": 1, "2@d": 2, "3": 3, "9@a": 4, "x@e": 5, None: -1}


def jobs_frames(spark):
    ts = lambda s: T0 + timedelta(seconds=s)
    jobs = [
        ("r", None, ts(-1), ts(0), 0),
        ("s1", "r", ts(1), ts(1), 0), ("s2", "r", ts(5), ts(5), 0), ("s-empty", "r", ts(0.5), ts(0.5), 0),
        ("c1", "s1", ts(1.5), ts(2), 1000), ("c2", "s1", ts(1.6), ts(3.5), 500), ("c3", "s2", ts(5.5), ts(6), 250),
    ]
    jobs_df = spark.createDataFrame(jobs, runlogs.JOBS)
    completions = spark.createDataFrame([("c1", "wk-b"), ("c2", "wk-a")], runlogs.JOB_COMPLETIONS)
    return jobs_df, completions


def test_job_hierarchy_multi_worker(spark):
    jobs, completions = jobs_frames(spark)
    h = timing.job_hierarchy(jobs, completions)
    assert sorted(r.id for r in h.collect()) == ["c1", "c2", "c3"]  # s-empty dropped
    tt = timing.normalize_workers(timing.relative_job_times(h))
    out = timing.relative_us(tt, ("created_at", "started_at", "completed_at", "own_created_at")).orderBy("task_no").collect()
    assert [r.task for r in out] == ["task_00", "task_01", "task_02"]
    assert [r.created_at_us for r in out] == [1_000_000, 1_000_000, 5_000_000]  # sub-parent creation
    assert [r.completed_at_us for r in out] == [3_000_000, 4_000_000, 6_250_000]
    assert [r.started_at_us - r.own_created_at_us for r in out] == [500_000, 1_900_000, 500_000]
    assert [r.worker_index for r in out] == [1, 0, -1]


def test_job_hierarchy_single_worker(spark):
    jobs, completions = jobs_frames(spark)
    h = timing.job_hierarchy(jobs, completions, multi_worker=False)
    tt = timing.relative_job_times(h, multi_worker=False).orderBy("task_no")
    assert [r.task for r in tt.collect()] == ["task_00", "task_01", "task_02"]
    assert [r.own_created_at for r in tt.collect()] == [T0 + timedelta(seconds=s) for s in (0.5, 1, 5)]


def test_breakdown_single_task_and_overlap(spark):
    jobs, completions = jobs_frames(spark)
    tt = timing.relative_job_times(timing.job_hierarchy(jobs, completions))
    (row,) = timing.phase_breakdown_by_duration(tt).collect()
    assert row.total_tasks == 3 and row.total_duration == 6.25
    # transitions: 1.0 - 3.0 (overlap, negative) and 5.0 - 4.0
    assert row.avg_transition == ((1_000_000 - 3_000_000) + (5_000_000 - 4_000_000)) / 2 / 1e6
    one = tt.where(F.col("task_no") == 0)
    (single,) = timing.phase_breakdown_by_duration(one).collect()
    assert single.avg_transition == 0.0 and single.transition_pct == 0.0


def test_ordinal_matches_row_number_under_skew(spark):
    random.seed(7)
    rows = [("hot", random.randrange(0, 10_000), i) for i in range(3000)]
    rows += [(f"g{i % 40}", random.randrange(0, 10_000), 10_000 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, o long, id long")
    got = ordinal(df, ["g"], "o", out="pos", tie_cols=("id",), num_partitions=7)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")) - 1)
    assert sorted(got.select("id", "pos").collect()) == sorted(want.select("id", F.col("pos").cast("long")).collect())


def test_ordinal_neighbours_match_lag_lead_under_skew(spark):
    random.seed(11)
    rows = [("hot", random.randrange(0, 5_000), i, None if i % 7 == 0 else i * 3) for i in range(2500)]
    rows += [(f"g{i % 30}", random.randrange(0, 5_000), 10_000 + i, i) for i in range(400)]
    rows += [("single", 5, 99_999, 1)]
    df = spark.createDataFrame(rows, "g string, o long, id long, v long")
    got = ordinal(df, ["g"], "o", out="pos", tie_cols=("id",), previous=("v", "id"), following=("v",), num_partitions=9)
    w = Window.partitionBy("g").orderBy("o", "id")
    want = df.select(
        "id",
        (F.row_number().over(w) - 1).cast("long").alias("pos"),
        F.lag("v").over(w).alias("prev_v"),
        F.lag("id").over(w).alias("prev_id"),
        F.lead("v").over(w).alias("next_v"),
    )
    cols = ["id", "pos", "prev_v", "prev_id", "next_v"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_ordinal_running_sums_match_window_under_skew(spark):
    random.seed(13)
    rows = [("hot", random.randrange(0, 500), i, None if i % 9 == 0 else i) for i in range(2500)]
    rows += [(f"g{i % 30}", random.randrange(0, 500), 10_000 + i, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o long, id long, v long")
    for group in (["g"], []):
        got = ordinal(df, group, "o", tie_cols=("id",), running=("v",), following=("v",), num_partitions=9)
        w = Window.partitionBy(*group).orderBy("o", "id")
        want = df.select("id", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_v"),
                         F.lead("v").over(w).alias("next_v"))
        assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    assert ordinal(df.where("false"), [], "o", running=("v",)).count() == 0


def test_dense_index_of_a_workflow_with_a_worker_a_task(spark):
    """One workflow holds most of the distinct values; nulls get -1, repeats one index."""
    rows = [("hot", f"w{i % 2000:04d}") for i in range(3000)] + [(f"g{i % 20}", f"w{i}") for i in range(200)]
    rows += [("hot", None), ("none", None), (None, "w1")]
    df = spark.createDataFrame(rows, "g string, w string")
    got = sorted(map(tuple, dense_index(df, ["g"], "w", [F.col("w")]).select("g", "w", "worker_index").collect()), key=str)
    values = {}
    for g, w in rows:
        values.setdefault(g, set()).add(w)
    place = {(g, w): i for g, own in values.items() for i, w in enumerate(sorted(own - {None}))}
    want = [(g, w, -1 if g is None or w is None else place[g, w]) for g, w in rows]
    assert got == sorted(want, key=str)


def test_worker_activities_chunks_and_hot_worker(spark):
    from tally.operators.documents import worker_activities

    random.seed(5)
    rows = [("wf", f"task_{i:03d}", i, "hot" if i % 3 else random.choice(["w1", "w2", ""])) for i in random.sample(range(200), 200)]
    rows.append(("other", "task_000", 0, "hot"))
    starts = spark.createDataFrame(rows, "workflow_id string, task string, seq long, worker string")
    got = {(r.workflow_id, r.worker, r.chunk): (r.tasks, r.activities) for r in worker_activities(starts, chunk=7).collect()}
    want = {}
    for wf, worker in {(r[0], r[3]) for r in rows}:
        ordered = [r[1] for r in sorted((r for r in rows if r[0] == wf and r[3] == worker), key=lambda r: r[2])]
        for c in range(0, len(ordered), 7):
            want[(wf, worker, c // 7)] = (len(ordered), ordered[c:c + 7])
    assert got == want


def test_tasks_per_worker_counts_started_tasks_by_number(spark):
    """150 tasks of one worker, every third one never completed; one started without a scheduled event."""
    evs = [START]
    for i in range(150):
        own = activity(10 + 10 * i, 1 + 2 * i, str(i), worker="7@h")
        evs += own[:2] if i % 3 == 0 else own
    stray = dict(activity(9000, 500, "999", worker="7@h")[1])
    pages = history(spark, {"w": evs + [stray]})
    (r,) = timing.tasks_per_worker(timing.worker_starts(pages)).collect()
    assert (r.workflow_id, r.worker, r.tasks, r.first_task, r.last_task) == ("w", "7@h", 150, "task_00", "task_149")


@pytest.mark.parametrize("rows", [
    [("hour", i * 18_000, i) for i in range(4000)],               # 4000 rows within 72 seconds of microseconds
    [("same", 5, i) for i in range(4000)],                        # one order key: only the ties differ
])
def test_ordinal_splits_a_group_by_its_rows(spark, rows):
    df = spark.createDataFrame(rows, "g string, o long, id long").repartition(5)
    got = ordinal(df, ["g"], "o", out="pos", tie_cols=("id",), num_partitions=8)
    assert [r.pos for r in got.orderBy("id").collect()] == list(range(4000))
    cut = df.repartitionByRange(8, "g", "o", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(cut) == 8 and max(r["count"] for r in cut) < 1000


def test_unnumbered_labels_are_ordered_by_text(spark):
    rows = [("w", None, f"label-{i:04d}") for i in range(500)] + [("w", 3, "task_03"), ("w", 1, "task_01")]
    tt = spark.createDataFrame(rows, "workflow_id string, task_no long, task string")
    got = [r.task for r in timing._task_order(tt).orderBy("pos").collect()]
    assert got == ["task_01", "task_03", *(f"label-{i:04d}" for i in range(500))]


def test_history_split_into_pages_in_any_order_matches_one_page(spark):
    evs = [START]
    for i in range(12):
        evs += activity(10 + 10 * i, 1 + 2 * i, None if i % 4 == 0 else str(i), worker=f"{i % 3}@h")
    one = history(spark, {"w": evs})
    pages = [{"workflow_id": "w", "page": p, "history": {"events": evs[s:s + 5]}}
             for p, s in enumerate(range(0, len(evs), 5))]
    paged = spark.createDataFrame(list(reversed(pages)), runlogs.EVENT_HISTORY)
    cols = ["task", "created_at", "started_at", "completed_at", "worker", "waiting_time"]

    def result(df):
        return sorted(tuple(r) for r in timing.waiting_times(timing.correlate_event_history(df)).select(cols).collect())

    got, want = result(paged), result(one)
    assert got == want and len(want) == 12
