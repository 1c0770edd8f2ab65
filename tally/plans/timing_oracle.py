"""DuckDB oracle SQL for the run-log timing queries.

Written from the reference loop semantics over the flat lifecycle rows of
``events`` (FIXTURES.md §6), with plain window functions: the oracle is a
single-node check, the Spark side is the scalable plan. Seconds are integer
microseconds divided by 1e6; 3-decimal rounding is printf's, on the binary value.
"""

from __future__ import annotations

# The report and document wording below, which must match.
US = "epoch_us"


def sec(expr: str) -> str:
    return f"(cast({expr} as double) / cast(1000000 as double))"


def rms(expr: str) -> str:
    """3-decimal seconds from microseconds: the double as printf rounds it, on its exact binary value."""
    return f"cast(printf('%.3f', cast(({expr}) as double) / 1000000) as double)"


def clamp(expr: str) -> str:
    return f"greatest(cast(0 as double), {rms(expr)})"


def diff(a: str, b: str) -> str:
    """microseconds from a to b."""
    return f"({US}({b}) - {US}({a}))"


def half_up(num: str, den: str) -> str:
    """Exact half-up integer rounding of num / den (integers); NULL when den = 0."""
    n = f"(({num}) * sign({den}))"
    d = f"abs({den})"
    x, y = f"(2 * {n} + {d})", f"(2 * {d})"
    return f"(case when {d} <> 0 then ({x} - ((({x} % {y}) + {y}) % {y})) // {y} end)"


def fixed(num: str, den: str, decimals: int, scale: int = 1) -> str:
    units = half_up(f"({num}) * {scale * 10 ** decimals}", den)
    return f"printf('%.{decimals}f', cast({units} as double) / cast({10 ** decimals} as double))"


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')"


BASE = """
with e as (
    select cast(user_id as varchar) as workflow_id, user_id as wf_num, event_id, ts,
           cast(json_extract_string(props, '$.k') as integer) as k,
           row_number() over (partition by user_id order by ts, event_id) - 1 as rn
    from events
),
life as (select workflow_id, wf_num, rn, ts, k, rn // 3 as task_no, rn % 3 as phase from e),
starts as (select workflow_id, min(ts) - interval 1 second as start_at from life group by workflow_id),
tasks as (
    select workflow_id, any_value(wf_num) as wf_num, task_no,
           max(case when phase = 0 then ts end) as created_at,
           max(case when phase = 1 then ts end) as started_at,
           max(case when phase = 2 then ts end) as completed_at,
           max(case when phase = 1 then k end) as k
    from life group by workflow_id, task_no
),
done as (
    select t.*, s.start_at from tasks t join starts s using (workflow_id)
    where created_at is not null and started_at is not null and completed_at is not null
)"""

# T7 rows: multi-worker job hierarchy (root -> sub-parent -> child).
JOBS = BASE + """,
children as (
    select workflow_id, wf_num, start_at, task_no,
           'c-' || workflow_id || '-' || cast(task_no as varchar) as id,
           's-' || workflow_id || '-' || cast(task_no // 5 as varchar) as parent_job,
           created_at, started_at,
           cast(floor(cast(epoch_us(completed_at) - epoch_us(started_at) as double) / 1000) as bigint) as duration_ms,
           case when wf_num % 10 <> 0 then 'wk-' || cast(k as varchar) end as worker
    from done
),
subs as (select parent_job as sub_id, min(created_at) as sub_created from children group by parent_job),
hier as (
    select c.*, s.sub_id, s.sub_created,
           row_number() over (partition by c.workflow_id order by s.sub_created, s.sub_id, c.created_at, c.id) - 1
               as task_pos
    from children c join subs s on c.parent_job = s.sub_id
),
t7 as (
    select 'r-' || workflow_id as workflow_id, task_pos, printf('task_%02d', task_pos) as task,
           epoch_us(sub_created) - epoch_us(start_at) as created_us,
           epoch_us(started_at) - epoch_us(start_at) as started_us,
           epoch_us(started_at) + duration_ms * 1000 - epoch_us(start_at) as completed_us,
           epoch_us(started_at) - epoch_us(created_at) as assign_us,
           worker
    from hier
)"""

# T4 rows: kestra-style phase times, complete tasks in task order.
PHASES = BASE + """,
phases as (
    select workflow_id, row_number() over w - 1 as pos, task_no,
           workflow_id || '-' || cast(task_no as varchar) as task_run_id,
           cast(task_no as varchar) as value,
           created_at, started_at, completed_at as success_at,
           coalesce(epoch_us(created_at) - epoch_us(lag(completed_at) over w), 0) as trans_us,
           epoch_us(started_at) - epoch_us(created_at) as assign_us,
           epoch_us(completed_at) - epoch_us(started_at) as exec_us
    from done
    window w as (partition by workflow_id order by task_no)
)"""

WAITEXEC = PHASES + f""",
we as (
    select workflow_id, pos, {rms('assign_us')} as waiting_time, {rms('exec_us')} as execution_time from phases
)"""

T1 = BASE + f""",
t1 as (
    select workflow_id, task_no, printf('task_%02d', task_no) as task,
           {sec(diff('start_at', 'created_at'))} as created_at,
           {sec(diff('start_at', 'started_at'))} as started_at,
           {sec(diff('start_at', 'completed_at'))} as completed_at,
           {sec(diff('started_at', 'completed_at'))} as duration,
           {sec(diff('coalesce(lag(completed_at) over (partition by workflow_id order by task_no), created_at)', 'started_at'))}
               as waiting_time,
           cast(k as varchar) || '@fixture-host' as worker_id, k, start_at,
           created_at as c_ts, started_at as s_ts, completed_at as e_ts
    from done
)"""

# One document entry per workflow.
DOCUMENT = T1 + f""",
d as (
    select workflow_id, task_no,
           {rms(diff('start_at', 'c_ts'))} as c, {rms(diff('start_at', 's_ts'))} as s,
           {rms(diff('start_at', 'e_ts'))} as f,
           dense_rank() over (partition by workflow_id order by k) - 1 as w,
           count(distinct worker_id) over (partition by workflow_id) as workers
    from t1
),
doc as (
    select workflow_id as usecase, cast(any_value(workers) as integer) as workers, count(*) as tasks,
           '[' || string_agg(printf('%.3f', c), ', ' order by task_no) || ']' as created_at,
           '[' || string_agg(printf('%.3f', s), ', ' order by task_no) || ']' as started_at,
           '[' || string_agg(printf('%.3f', f), ', ' order by task_no) || ']' as completed_at,
           case when any_value(workers) > 1
                then '[' || string_agg(printf('%d', w), ', ' order by task_no) || ']' end as worker_execution
    from d group by workflow_id
)"""


CHAINS = BASE + """,
pages as (
    select workflow_id, any_value(wf_num) as wf_num, rn // 6 as page,
           max(rn // 6) over (partition by workflow_id) as last
    from life group by workflow_id, rn // 6
),
kept as (
    select *, (wf_num % 7 = 3 and last >= 2) or (wf_num % 7 = 5 and last > 0) as lost from pages
    where not (wf_num % 7 = 3 and page = 1 and last >= 2) and not (wf_num % 7 = 5 and page = last and page > 0)
)"""


def breakdown(rows: str) -> str:
    """T9 over rows (workflow_id, pos, created, started, completed in microseconds from zero, assign)."""
    return f"""
x as (select *, lead(created_us) over (partition by workflow_id order by pos) - completed_us as trans_us from {rows}),
a as (
    select workflow_id, count(*) as n, arg_max(completed_us, pos) as total_us,
           sum(completed_us - started_us) as exec_us, sum(assign_us) as assign_us, sum(trans_us) as trans_us
    from x group by workflow_id
)"""


BREAKDOWN_COLUMNS = """
select workflow_id, cast(n as bigint) as total_tasks,
       cast(total_us as double) / cast(1000000 as double) as total_duration,
       cast(exec_us as double) / n / cast(1000000 as double) as avg_execution,
       cast(exec_us as double) / nullif(cast(total_us as double), 0) * cast(100 as double) as execution_pct,
       cast(assign_us as double) / n / cast(1000000 as double) as avg_assignment,
       cast(assign_us as double) / nullif(cast(total_us as double), 0) * cast(100 as double) as assignment_pct,
       case when n > 1 then cast(trans_us as double) / (n - 1) / cast(1000000 as double) else 0.0 end
           as avg_transition,
       case when n > 1 then cast(trans_us as double) / nullif(cast(total_us as double), 0) * cast(100 as double)
            else 0.0 end as transition_pct
from a
"""

# Phase rows from the first row's creation.
PHASE_ROWS = PHASES + """,
z as (
    select workflow_id, pos,
           epoch_us(created_at) - first_us as created_us, epoch_us(started_at) - first_us as started_us,
           epoch_us(success_at) - first_us as completed_us, assign_us
    from (select *, epoch_us(first_value(created_at) over (partition by workflow_id order by pos)) as first_us from phases)
),"""

TIMING_SQL = {
    "t1_correlate_event_history": T1 + """
select workflow_id, task, created_at, started_at, completed_at, duration, waiting_time, worker_id from t1
""",
    "t2_pivot_task_events": BASE + f"""
select workflow_id, 'task_' || cast(task_no as varchar) as task,
       {clamp(diff('start_at', 'created_at'))} as created_at,
       {clamp(diff('start_at', 'started_at'))} as started_at,
       {clamp(diff('start_at', 'completed_at'))} as completed_at,
       'worker-' || cast(k as varchar) as worker,
       cast(dense_rank() over (partition by workflow_id order by 'worker-' || cast(k as varchar)) - 1 as integer)
           as worker_index
from done
""",
    "t3_bulk_task_times": BASE + f""",
ids as (
    select workflow_id, row_number() over (order by wf_num) - 1 as pos
    from (select distinct workflow_id, wf_num from life)
)
select cast(i.pos as bigint) as pos, d.workflow_id,
       {clamp(diff('d.start_at', 'd.created_at'))} as created_at,
       {clamp(diff('d.start_at', 'd.started_at'))} as started_at,
       {clamp(diff('d.start_at', 'd.completed_at'))} as completed_at,
       'worker-' || cast(d.k as varchar) as worker,
       cast(dense_rank() over (order by 'worker-' || cast(d.k as varchar)) - 1 as integer) as worker_index
from ids i join done d on d.workflow_id = i.workflow_id and d.task_no = 0
""",
    "t4_history_phase_times": PHASES + f"""
select workflow_id, cast(pos as bigint) as pos, task_run_id, value,
       {ts_text('created_at')} as created_at, {ts_text('started_at')} as started_at,
       {ts_text('success_at')} as success_at,
       {sec('trans_us')} as transition_s, {sec('assign_us')} as assignment_s, {sec('exec_us')} as execution_s,
       {sec('trans_us + assign_us + exec_us')} as total_s
from phases
""",
    "t5_flatten_task_groups": BASE + f"""
select workflow_id, 'task_' || cast(task_no as varchar) as id,
       {iso('created_at')} as queued_dttm, {iso('started_at')} as start_date, {iso('completed_at')} as end_date,
       {sec(diff('created_at', 'started_at'))} as assignment_s,
       {sec(diff('started_at', 'completed_at'))} as execution_s
from tasks where created_at is not null
""",
    "t6_job_hierarchy": JOBS + f"""
select 'r-' || workflow_id as root_id, sub_id as sub_parent_id, {ts_text('sub_created')} as sub_parent_created_at,
       id, {ts_text('created_at')} as created_at, {ts_text('started_at')} as started_at, duration_ms, worker
from hier
""",
    "t7_relative_job_times": JOBS + f"""
select workflow_id, task, {sec('created_us')} as created_at, {sec('started_us')} as started_at,
       {sec('completed_us')} as completed_at, {sec('assign_us')} as created_started_diff, worker,
       cast(case when worker is null then -1
                 else dense_rank() over (partition by workflow_id order by worker nulls last) - 1 end as integer)
           as worker_index
from t7
""",
    "t8_normalize_workers": T1 + """
select workflow_id, task, worker_id as worker,
       cast(dense_rank() over (partition by workflow_id order by k) - 1 as integer) as worker_index
from t1
""",
    "t9_phase_breakdown_by_duration": JOBS + """,
x as (select *, lead(created_us) over (partition by workflow_id order by task_pos) - completed_us as trans_us from t7),
a as (
    select workflow_id, count(*) as n, arg_max(completed_us, task_pos) as total_us,
           sum(completed_us - started_us) as exec_us, sum(assign_us) as assign_us, sum(trans_us) as trans_us
    from x group by workflow_id
)
select workflow_id, cast(n as bigint) as total_tasks,
       cast(total_us as double) / cast(1000000 as double) as total_duration,
       cast(exec_us as double) / n / cast(1000000 as double) as avg_execution,
       cast(exec_us as double) / nullif(cast(total_us as double), 0) * cast(100 as double) as execution_pct,
       cast(assign_us as double) / n / cast(1000000 as double) as avg_assignment,
       cast(assign_us as double) / nullif(cast(total_us as double), 0) * cast(100 as double) as assignment_pct,
       case when n > 1 then cast(trans_us as double) / (n - 1) / cast(1000000 as double) else 0.0 end
           as avg_transition,
       case when n > 1 then cast(trans_us as double) / nullif(cast(total_us as double), 0) * cast(100 as double)
            else 0.0 end as transition_pct
from a
""",
    "t10_phase_breakdown_by_means": PHASES + """,
a as (
    select workflow_id, count(*) as n, sum(assign_us) as a, sum(exec_us) as e, sum(trans_us) as t,
           epoch_us(max(success_at)) - epoch_us(min(created_at)) as run_us
    from phases group by workflow_id
)
select workflow_id, cast(n as bigint) as tasks,
       cast(e as double) / n / cast(1000000 as double) as avg_execution,
       cast(a as double) / n / cast(1000000 as double) as avg_assignment,
       cast(t as double) / n / cast(1000000 as double) as avg_transition,
       cast(e as double) / nullif(cast(a + e + t as double), 0) * cast(100 as double) as execution_pct,
       cast(a as double) / nullif(cast(a + e + t as double), 0) * cast(100 as double) as assignment_pct,
       cast(t as double) / nullif(cast(a + e + t as double), 0) * cast(100 as double) as transition_pct,
       cast(run_us as double) / cast(1000000 as double) as total_running_time
from a
""",
    "t11_waiting_times": BASE + f"""
select workflow_id, 'task_' || cast(task_no as varchar) as task,
       {sec(diff('coalesce(lag(completed_at) over (partition by workflow_id order by task_no), created_at)', 'started_at'))}
           as waiting_time
from done
""",
    "t12_waiting_execution_arrays": WAITEXEC + """
select workflow_id, cast(pos as bigint) as pos, waiting_time, execution_time from we
""",
    "k9_printed_arrays": WAITEXEC + """
select workflow_id, cast(pos // 1024 as bigint) as chunk,
       '[' || string_agg(printf('%.3f', waiting_time), ', ' order by pos) || ']' as waiting_time,
       '[' || string_agg(printf('%.3f', execution_time), ', ' order by pos) || ']' as execution_time
from we group by workflow_id, pos // 1024
""",
    "t13_timing_table": PHASES + f""",
r as (
    select p.*, first_value(created_at) over (partition by workflow_id order by pos) as ref_at from phases p
),
v as (
    select workflow_id, pos,
           {rms(diff('ref_at', 'created_at'))} as relative_created,
           {rms(diff('ref_at', 'started_at'))} as relative_started,
           {rms(diff('ref_at', 'success_at'))} as relative_completed
    from r
)
select workflow_id, cast(pos as bigint) as pos, relative_created, relative_started, relative_completed,
       printf('| **task_%02d** | %14.3f | %14.3f | %16.3f |', pos, relative_created, relative_started,
              relative_completed) as line
from v
""",
    "t14_benchmark_document": DOCUMENT + """
select '2.34.0' as version, usecase, 'run-log timings' as title, 'derived from events' as description,
       'python' as language, workers, created_at, started_at, completed_at, worker_execution
from doc
""",
    "t14_document_upsert": DOCUMENT + """
select '2.34.0' as version, usecase, 'the new one' as title,
       workers, cast(tasks as bigint) as tasks, completed_at,
       cast(case when workers > 1 then tasks else 0 end as bigint) as mapped
from doc
""",
    # The use case that was committed again has its last entry, the other one its only one.
    "k5_document_commits": DOCUMENT + """,
entries as (
    select usecase, 'the new one' as title, workers, tasks, completed_at from doc
    union all
    select usecase || '/history', 'the "old" one', workers, tasks, completed_at from doc
)
select '2.34.0' as version, usecase, title, workers, cast(tasks as bigint) as tasks, completed_at,
       cast(case when workers > 1 then tasks else 0 end as bigint) as mapped
from entries
""",
    "k4_document_segments": DOCUMENT + """,
pieces as (
    select workflow_id, task_no // 1024 as chunk, max(workers) as workers, max(task_no) as top,
           string_agg(printf('%.3f', c), ', ' order by task_no) as c, string_agg(printf('%.3f', s), ', ' order by task_no) as s,
           string_agg(printf('%.3f', f), ', ' order by task_no) as f, string_agg(printf('%d', w), ', ' order by task_no) as w
    from d group by workflow_id, task_no // 1024
),
ends as (select *, chunk = max(chunk) over (partition by workflow_id) as last from pieces),
arrays as (
    select workflow_id, chunk, last, 1 as part, 'created_at' as name, c as text from ends
    union all select workflow_id, chunk, last, 2, 'started_at', s from ends
    union all select workflow_id, chunk, last, 3, 'completed_at', f from ends
    union all select workflow_id, chunk, last, 4, 'worker_execution', w from ends where workers > 1
)
select workflow_id as usecase, cast(part as integer) as part, cast(chunk as bigint) as chunk,
       case when chunk = 0 then ', "' || name || '": [' else '' end || text || case when last then ']' else ', ' end as value
from arrays
union all
select workflow_id, 0, 0,
       '{"version": "2.34.0", "usecases": {"' || workflow_id || '": {"title": "run-log timings", "description": "derived from events", '
       || '"python": {"workers": ' || cast(max(workers) as varchar)
from d group by workflow_id
union all
select workflow_id, 5, 0, '}}}}' from d group by workflow_id
""",
    "t9_phase_rows": PHASE_ROWS + breakdown("z") + BREAKDOWN_COLUMNS,
    "t5_dag_run_breakdown": PHASE_ROWS + breakdown("z") + BREAKDOWN_COLUMNS,
    "k8_phase_report": PHASE_ROWS + breakdown("z") + f"""
select workflow_id,
       printf('# Performance Statistics\n\n## Total Duration: %ss\n\n## Average Times\n\n'
              || '- **Execution time**: %ss (%s%% of total)\n'
              || '  - The time it takes for the orchestrator to execute the task once it has been assigned to an executor\n\n'
              || '- **Assignment time**: %ss (%s%% of total)\n'
              || '  - The time it takes for a task to be assigned to an executor once it has been created in the queue\n\n'
              || '- **Transition time**: %ss (%s%% of total)\n'
              || '  - The time it takes to create the following task once a task is finished\n\n'
              || 'Total tasks analyzed: %d\n',
              {fixed('total_us', '1000000', 3)},
              {fixed('exec_us', 'n * 1000000', 3)}, {fixed('exec_us', 'total_us', 2, 100)},
              {fixed('assign_us', 'n * 1000000', 3)}, {fixed('assign_us', 'total_us', 2, 100)},
              case when n > 1 then {fixed('trans_us', '(n - 1) * 1000000', 3)} else '0.000' end,
              case when n > 1 then {fixed('trans_us', 'total_us', 2, 100)} else '0.00' end,
              n) as report
from a
""",
    "t12_csv_arrays": WAITEXEC + """
select workflow_id, cast(pos as bigint) as pos, waiting_time, execution_time from we
""",
    "k8_stats_report": JOBS + f""",
x as (select *, lead(created_us) over (partition by workflow_id order by task_pos) - completed_us as trans_us from t7),
a as (
    select workflow_id, count(*) as n, arg_max(completed_us, task_pos) as total_us,
           sum(completed_us - started_us) as exec_us, sum(assign_us) as assign_us, sum(trans_us) as trans_us
    from x group by workflow_id
)
select workflow_id,
       printf('# Performance Statistics\n\n## Total Duration: %ss\n\n## Average Times\n\n'
              || '- **Execution time**: %ss (%s%%)\n- **Assignment time**: %ss (%s%%)\n'
              || '- **Transition time**: %ss (%s%%)\n\nTotal tasks analyzed: %d\n',
              {fixed('total_us', '1000000', 3)},
              {fixed('exec_us', 'n * 1000000', 3)}, {fixed('exec_us', 'total_us', 2, 100)},
              {fixed('assign_us', 'n * 1000000', 3)}, {fixed('assign_us', 'total_us', 2, 100)},
              case when n > 1 then {fixed('trans_us', '(n - 1) * 1000000', 3)} else '0.000' end,
              case when n > 1 then {fixed('trans_us', 'total_us', 2, 100)} else '0.00' end,
              n) as report
from a
""",
    "s10_event_times": BASE + f"""
select workflow_id, cast(rn + 2 as varchar) as event_id,
       case phase when 0 then 'EVENT_TYPE_ACTIVITY_TASK_SCHEDULED' when 1 then 'EVENT_TYPE_ACTIVITY_TASK_STARTED'
                  else 'EVENT_TYPE_ACTIVITY_TASK_COMPLETED' end as event_type,
       {iso('ts')} as event_time
from life
""",
    # Pages of six events, landed as the fixture says; a run of missing pages is one gap.
    "s6_page_report": CHAINS + """
select workflow_id, cast(count(*) + count(*) filter (page % 3 = 1) as bigint) as landed, count(*) as pages,
       count(*) filter (page % 3 = 1) as duplicates, cast(0 as bigint) as conflicts,
       cast(case when any_value(lost) then 1 else 0 end as bigint) as gaps, not any_value(lost) as complete
from kept group by workflow_id
""",
    "s6_events_once": CHAINS + f"""
select l.workflow_id, cast(p.place as integer) as page, cast(rn + 2 as varchar) as event_id,
       case phase when 0 then 'EVENT_TYPE_ACTIVITY_TASK_SCHEDULED' when 1 then 'EVENT_TYPE_ACTIVITY_TASK_STARTED'
                  else 'EVENT_TYPE_ACTIVITY_TASK_COMPLETED' end as event_type,
       {iso('ts')} as event_time
from life l join (select *, row_number() over (partition by workflow_id order by page) - 1 as place from kept) p
     on p.workflow_id = l.workflow_id and p.page = l.rn // 6
""",
    # From the started events, in event order; the task need not have completed.
    "a17_tasks_per_worker": BASE + """
select workflow_id, coalesce(cast(k as varchar) || '@fixture-host', '') as worker, count(*) as tasks,
       arg_min(printf('task_%02d', task_no), task_no) as first_task,
       arg_max(printf('task_%02d', task_no), task_no) as last_task
from life where phase = 1 group by all
""",
    "a17_worker_activities": BASE + """,
started as (
    select workflow_id, coalesce(cast(k as varchar) || '@fixture-host', '') as worker_id,
           printf('task_%02d', task_no) as task, rn
    from life where phase = 1
),
ranked as (
    select workflow_id, worker_id, task,
           row_number() over (partition by workflow_id, worker_id order by rn) - 1 as pos,
           count(*) over (partition by workflow_id, worker_id) as tasks
    from started
)
select workflow_id, worker_id as worker, cast(pos // 1024 as bigint) as chunk, cast(max(tasks) as bigint) as tasks,
       string_agg(task, ',' order by pos) as activities
from ranked group by workflow_id, worker_id, pos // 1024
""",
}
