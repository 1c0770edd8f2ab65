"""Golden values printed in the reference's run listings and sample documents."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tally.functions.timefn import micros_between, parse_ts, seconds
from tally.operators import timing
from tally.sources import runlogs

# 10 x fibo(33) listing (created time, assignment s, execution s).
KESTRA_10 = [
    ("2024-11-15 19:39:58.722", 0.047, 1.301), ("2024-11-15 19:40:00.119", 0.054, 1.281),
    ("2024-11-15 19:40:01.486", 0.047, 1.320), ("2024-11-15 19:40:02.933", 0.065, 1.309),
    ("2024-11-15 19:40:04.363", 0.047, 1.364), ("2024-11-15 19:40:05.819", 0.060, 1.313),
    ("2024-11-15 19:40:07.242", 0.046, 1.366), ("2024-11-15 19:40:08.713", 0.058, 1.308),
    ("2024-11-15 19:40:10.133", 0.044, 1.337), ("2024-11-15 19:40:11.542", 0.048, 1.287),
]
# 40 x fibo(10) listing.
KESTRA_40 = [
    ("2024-11-15 19:41:26.605", 0.062, 0.770), ("2024-11-15 19:41:27.462", 0.056, 0.591),
    ("2024-11-15 19:41:28.141", 0.045, 0.613), ("2024-11-15 19:41:28.873", 0.058, 0.645),
    ("2024-11-15 19:41:29.630", 0.045, 0.617), ("2024-11-15 19:41:30.333", 0.059, 0.616),
    ("2024-11-15 19:41:31.044", 0.045, 0.624), ("2024-11-15 19:41:31.752", 0.056, 0.602),
    ("2024-11-15 19:41:32.457", 0.048, 0.691), ("2024-11-15 19:41:33.244", 0.082, 0.610),
    ("2024-11-15 19:41:34.005", 0.070, 0.607), ("2024-11-15 19:41:34.713", 0.056, 0.610),
    ("2024-11-15 19:41:35.422", 0.045, 0.637), ("2024-11-15 19:41:36.138", 0.051, 0.618),
    ("2024-11-15 19:41:36.848", 0.061, 0.660), ("2024-11-15 19:41:37.610", 0.095, 0.670),
    ("2024-11-15 19:41:38.417", 0.068, 0.684), ("2024-11-15 19:41:39.204", 0.056, 0.652),
    ("2024-11-15 19:41:39.968", 0.063, 0.638), ("2024-11-15 19:41:40.710", 0.071, 0.645),
    ("2024-11-15 19:41:41.463", 0.070, 0.675), ("2024-11-15 19:41:42.315", 0.071, 0.638),
    ("2024-11-15 19:41:43.065", 0.065, 0.634), ("2024-11-15 19:41:43.808", 0.067, 0.683),
    ("2024-11-15 19:41:44.610", 0.059, 0.622), ("2024-11-15 19:41:45.334", 0.055, 0.612),
    ("2024-11-15 19:41:46.051", 0.057, 0.603), ("2024-11-15 19:41:46.749", 0.051, 0.626),
    ("2024-11-15 19:41:47.479", 0.068, 0.624), ("2024-11-15 19:41:48.255", 0.061, 0.633),
    ("2024-11-15 19:41:49.001", 0.065, 0.612), ("2024-11-15 19:41:49.722", 0.069, 0.634),
    ("2024-11-15 19:41:50.475", 0.061, 0.637), ("2024-11-15 19:41:51.227", 0.078, 0.615),
    ("2024-11-15 19:41:51.960", 0.070, 0.615), ("2024-11-15 19:41:52.689", 0.061, 0.667),
    ("2024-11-15 19:41:53.482", 0.062, 0.622), ("2024-11-15 19:41:54.208", 0.058, 0.616),
    ("2024-11-15 19:41:54.935", 0.072, 0.635), ("2024-11-15 19:41:55.720", 0.057, 0.630),
]


def _iso(dt: datetime) -> str:
    return dt.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _execution_doc(listing, wf="exec-1"):
    runs = [{"id": "wrapper", "taskId": "processIterations", "state": {"histories": []}}]
    for i, (created, a, e) in enumerate(listing):
        c = datetime.fromisoformat(created)
        r = c + timedelta(seconds=a)
        s = r + timedelta(seconds=e)
        runs.append({
            "id": f"run-{i}", "taskId": "python", "value": str(i),
            "state": {"histories": [{"state": "CREATED", "date": _iso(c)}, {"state": "RUNNING", "date": _iso(r)},
                                    {"state": "SUCCESS", "date": _iso(s)}]},
        })
    return {"workflow_id": wf, "taskRunList": runs}


def _write_json(tmp_path, name, docs):
    path = tmp_path / name
    path.write_text("\n".join(json.dumps(d) for d in docs))
    return str(path)


@pytest.mark.parametrize("listing,expected,total", [
    (KESTRA_10, (93.15, 3.65, 3.20), "14.15"),
    (KESTRA_40, (85.34, 8.28, 6.38), "29.80"),
])
def test_kestra_percentage_breakdown(spark, tmp_path, listing, expected, total):
    docs = runlogs.read_executions(spark, _write_json(tmp_path, "exec.json", [_execution_doc(listing)]))
    phases = timing.history_phase_times(docs)
    assert phases.count() == len(listing)  # the processIterations wrapper is filtered out
    (row,) = timing.phase_breakdown_by_means(phases).collect()
    assert (round(row.execution_pct, 2), round(row.assignment_pct, 2), round(row.transition_pct, 2)) == expected
    assert f"{row.total_running_time:.2f}" == total


def test_kestra_first_transition_is_zero(spark, tmp_path):
    docs = runlogs.read_executions(spark, _write_json(tmp_path, "exec.json", [_execution_doc(KESTRA_10)]))
    out = timing.history_phase_times(docs).orderBy("pos").collect()
    assert out[0].transition_s == 0.0
    # second task: created 19:40:00.119 - previous success (19:39:58.722 + 0.047 + 1.301)
    assert out[1].transition_s == pytest.approx(0.049, abs=1e-6)
    assert out[1].total_s == pytest.approx(0.049 + 0.054 + 1.281, abs=1e-6)


def _temporal_page(event_type_style="camel"):
    # Events 5-6-7 of the sample history, plus a start event we add for time zero.
    t = (lambda s: s) if event_type_style == "camel" else (lambda s: "EVENT_TYPE_" + s)
    return {
        "workflow_id": "bench-10",
        "history": {"events": [
            {"eventId": "1", "eventTime": "2023-11-09T14:55:51.000000000Z",
             "eventType": t("WORKFLOW_EXECUTION_STARTED") if event_type_style != "camel" else "WorkflowExecutionStarted"},
            {"eventId": "5", "eventTime": "2023-11-09T14:55:51.381932302Z",
             "eventType": "ActivityTaskScheduled" if event_type_style == "camel" else t("ACTIVITY_TASK_SCHEDULED"),
             "activityTaskScheduledEventAttributes": {"activityId": "task_0"}},
            {"eventId": "6", "eventTime": "2023-11-09T14:55:51.389407802Z",
             "eventType": "ActivityTaskStarted" if event_type_style == "camel" else t("ACTIVITY_TASK_STARTED"),
             "activityTaskStartedEventAttributes": {"scheduledEventId": "5", "identity": "39827@gorilla.local"}},
            {"eventId": "7", "eventTime": "2023-11-09T14:55:51.768861927Z",
             "eventType": "ActivityTaskCompleted" if event_type_style == "camel" else t("ACTIVITY_TASK_COMPLETED"),
             "activityTaskCompletedEventAttributes": {"scheduledEventId": "5", "startedEventId": "6"}},
        ]},
    }


@pytest.mark.parametrize("style", ["camel", "upper"])
def test_temporal_triple(spark, tmp_path, style):
    pages = runlogs.read_event_history(spark, _write_json(tmp_path, "h.json", [_temporal_page(style)]))
    (row,) = timing.correlate_event_history(pages).collect()
    assert row.task == "task_0" and row.worker == "39827@gorilla.local"
    us = lambda a, b: (getattr(row, b) - getattr(row, a)) / timedelta(microseconds=1)
    assert us("created_at", "started_at") == 7475     # assignment 0.007475 s (nanoseconds truncated)
    assert us("started_at", "completed_at") == 379454  # execution 0.379454 s


def test_temporal_payloads(spark):
    # Payload data of the sample (base64 JSON): input 33, result 3524578.
    df = spark.createDataFrame([("MzM=", "MzUyNDU3OA==")], "inp string, res string")
    r = df.select(F.unbase64("inp").cast("string").cast("int").alias("n"),
                  F.unbase64("res").cast("string").cast("long").alias("r")).first()
    assert r.n == 33 and r.r == 3524578


def test_airflow_task_groups(spark, tmp_path):
    # task_0 and task_9 instances of the sample DAG run.
    doc = {"workflow_id": "bench-10", "groups": {"children": [
        {"id": "task_0", "instances": [{"queued_dttm": "2023-11-09T14:45:14.204623+00:00",
                                        "start_date": "2023-11-09T14:45:15.527698+00:00",
                                        "end_date": "2023-11-09T14:45:16.210983+00:00", "state": "success",
                                        "try_number": 1}]},
        {"id": "task_9", "instances": [{"queued_dttm": "2023-11-09T14:45:31.864154+00:00",
                                        "start_date": "2023-11-09T14:45:32.347408+00:00",
                                        "end_date": "2023-11-09T14:45:33.071092+00:00", "state": "success",
                                        "try_number": 1}]},
    ]}}
    flat = timing.flatten_task_groups(runlogs.read_dag_runs(spark, _write_json(tmp_path, "dag.json", [doc])))
    out = {r.id: r for r in flat.select(
        "id",
        seconds(micros_between(parse_ts("queued_dttm"), parse_ts("start_date"))).alias("a"),
        seconds(micros_between(parse_ts("start_date"), parse_ts("end_date"))).alias("e"),
    ).collect()}
    assert (out["task_0"].a, out["task_0"].e) == (1.323075, 0.683285)
    assert (out["task_9"].a, out["task_9"].e) == (0.483254, 0.723684)
