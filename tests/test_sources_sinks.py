"""Sources and sinks: .tbl ingest, id lists, timing CSV, documents, upsert."""

import json

import pytest
from pyspark.sql import functions as F

from tally.operators import documents, timing
from tally.sinks import files
from tally.sources import runlogs, tables
from tests.conftest import SF_SMALL


def test_tbl_ingest_trims_chars_and_drops_trailing_field(spark, tmp_path):
    src = tmp_path / "nation.tbl"
    src.write_text("0|ALGERIA                  |0| haggle. carefully final deposits|\n"
                   "1|ARGENTINA                |1|al foxes promise slyly|\n")
    df = tables.read_tbl(spark, str(src), "nation")
    assert df.columns == ["n_nationkey", "n_name", "n_regionkey", "n_comment"]
    assert [(r.n_nationkey, r.n_name) for r in df.orderBy("n_nationkey").collect()] == [(0, "ALGERIA"), (1, "ARGENTINA")]
    out = tables.ingest_tbl(spark, str(src), str(tmp_path / "landed"), "nation")
    assert spark.read.parquet(out).count() == 2


def test_tbl_money_and_dates_are_typed(spark, tmp_path):
    src = tmp_path / "orders.tbl"
    src.write_text("1|370|O|172799.49|1996-01-02|5-LOW          |Clerk#000000951|0|nstructions sleep|\n")
    (r,) = tables.read_tbl(spark, str(src), "orders").collect()
    assert str(r.o_totalprice) == "172799.49" and str(r.o_orderdate) == "1996-01-02"
    assert r.o_orderpriority == "5-LOW" and r.o_shippriority == 0


def test_one_bad_line_leaves_all_others(spark, tmp_path):
    src = tmp_path / "region.tbl"
    src.write_text("0|AFRICA|x|\n1|AMERICA|y|\nnot a number|ASIA|z|\n3||w|\n4|MIDDLE EAST||\n5|TOO|many|fields|\n")
    root = str(tmp_path / "landed")
    with pytest.raises(tables.TooManyRejects):
        tables.ingest_tbl(spark, str(src), root, "region", max_rejects=2)
    assert not (tmp_path / "landed" / "region.parquet").exists()
    out = tables.ingest_tbl(spark, str(src), root, "region", max_rejects=3)
    assert sorted((r.r_regionkey, r.r_name) for r in spark.read.parquet(out).collect()) == [(0, "AFRICA"), (1, "AMERICA"), (4, "MIDDLE EAST")]
    rejects = {r.line.split("|")[0]: r for r in spark.read.parquet(tables.table_path(root, "region-rejects")).collect()}
    assert rejects.keys() == {"not a number", "3", "5"} and rejects["3"].reason == "null in r_name"
    assert rejects["5"].line == "5|TOO|many|fields|" and all(r.file.endswith("region.tbl") and r.split == 0 for r in rejects.values())


def test_checked_load_is_whole_once_and_by_name(spark, tmp_path):
    root = str(tmp_path / "w")
    rows = spark.createDataFrame([("x", 0, "A", 1), ("y", 1, "B", 2)], "r_comment string, r_regionkey int, r_name string, extra int")
    assert tables.checked_load(rows, root, "region", "one", key=["r_regionkey"]) == {"rows": 2}
    assert tables.checked_load(rows, root, "region", "one", key=["r_regionkey"]) == {"rows": 0}
    read = lambda: sorted(map(tuple, spark.read.parquet(tables.table_path(root, "region")).collect()))
    whole = [(0, "A", "x", "one"), (1, "B", "y", "one")]
    assert read() == whole
    null = spark.createDataFrame([(2, "C", None), (None, "D", None)], "r_regionkey int, r_name string, r_comment string")
    with pytest.raises(tables.LoadRefused, match="nulls in {'r_regionkey': 1}"):
        tables.checked_load(null, root, "region", "two")
    with pytest.raises(tables.LoadRefused, match="a key more than once"):
        tables.checked_load(rows.limit(1), root, "region", "three", key=["r_regionkey"])
    with pytest.raises(tables.LoadRefused, match="a key more than once"):
        tables.checked_load(rows.withColumn("r_regionkey", F.lit(9)), root, "region", "four", key=["r_regionkey"])
    with pytest.raises(tables.LoadRefused, match="no column r_name"):
        tables.checked_load(rows.drop("r_name"), root, "region", "five")
    assert read() == whole


def test_rounding_is_that_of_the_double(spark):
    """All half-milliseconds of a thousand seconds, their neighbours, and negative ones, as Python rounds them."""
    from tally.functions.timefn import round_ms
    us = spark.range(1_000_000).select((F.col("id") * 1000 + 500).alias("us"))
    for shift in (0, -1_000_000_000, 1_700_000_000_000_000):
        got = us.select((F.col("us") + shift).alias("us")).select("us", round_ms("us").alias("r")).toPandas()
        assert (got.r == [round(x / 1e6, 3) for x in got.us]).all()
    near = spark.range(-3000, 3000).select(F.col("id").alias("us")).select("us", round_ms("us").alias("r")).toPandas()
    assert (near.r == [round(x / 1e6, 3) for x in near.us]).all()


def test_register_views_and_sql(spark):
    tables.register_views(spark, SF_SMALL)
    assert spark.sql("select count(*) c from nation").first().c == 25


def test_id_list_strips_blanks_and_keeps_order(spark, tmp_path):
    p = tmp_path / "ids.txt"
    p.write_text("  wf-b \n\n wf-a\n   \nwf-b\n")
    ids = runlogs.read_id_list(spark, str(p)).orderBy("pos").collect()
    assert [r.workflow_id for r in ids] == ["wf-b", "wf-a", "wf-b"]
    assert [r.pos for r in ids] == sorted(r.pos for r in ids)


def test_id_list_line_numbers_across_splits_and_files(spark, tmp_path):
    d = tmp_path / "ids"
    d.mkdir()
    files = {"a.txt": [f"wf-{i}" if i % 17 else "  " for i in range(1500)], "b.txt": [f"x{i}" for i in range(700)]}
    for name, lines in files.items():
        (d / name).write_text("\n".join(lines) + "\n")
    want = [(line.strip(), pos) for pos, line in enumerate(files["a.txt"] + files["b.txt"]) if line.strip()]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")   # many splits per file
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = runlogs.read_id_list(spark, str(d))
        rows = sorted((r.workflow_id, r.pos) for r in got.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert rows == sorted(want)


def test_bulk_task_times_in_list_order(spark, tmp_path):
    docs = [{"workflow_id": wf, "run": {"createdAt": "2024-01-01T00:00:00Z"},
             "tasks": [{"taskExternalId": "t", "taskInsertedAt": f"2024-01-01T00:00:0{i}Z",
                        "startedAt": f"2024-01-01T00:00:0{i + 1}Z", "finishedAt": f"2024-01-01T00:00:0{i + 3}Z",
                        "workerId": w}]}
            for i, (wf, w) in enumerate([("wf-a", "w2"), ("wf-b", None)])]
    path = tmp_path / "docs.json"
    path.write_text("\n".join(json.dumps(d) for d in docs))
    ids = tmp_path / "ids.txt"
    ids.write_text("wf-b\n\nwf-a\nwf-missing\n")
    out = timing.clamped_relative(timing.bulk_task_times(runlogs.read_run_documents(spark, str(path)),
                                                         runlogs.read_id_list(spark, str(ids))))
    got = [(r.workflow_id, r.created_at, r.completed_at, r.worker) for r in out.orderBy("pos").collect()]
    assert got == [("wf-b", 1.0, 4.0, "unknown"), ("wf-a", 0.0, 3.0, "w2")]


def test_timing_csv_round_trip(spark, tmp_path):
    doc = {"workflow_id": "e1", "taskRunList": [
        {"id": "a", "taskId": "python", "value": "0", "state": {"histories": [
            {"state": "CREATED", "date": "2024-01-01T00:00:00.100Z"},
            {"state": "RUNNING", "date": "2024-01-01T00:00:00.250Z"},
            {"state": "SUCCESS", "date": "2024-01-01T00:00:01.000Z"}]}},
        {"id": "b", "taskId": "script", "state": {"histories": [
            {"state": "CREATED", "date": "2024-01-01T00:00:01.200Z"},
            {"state": "RUNNING", "date": "2024-01-01T00:00:01.300Z"},
            {"state": "SUCCESS", "date": "2024-01-01T00:00:02.000Z"}]}},
    ]}
    src = tmp_path / "exec.json"
    src.write_text(json.dumps(doc))
    phases = timing.history_phase_times(runlogs.read_executions(spark, str(src)))
    out = str(tmp_path / "csv")
    files.write_timing_csv(phases, out)
    back = runlogs.read_timing_csv(spark, out + "/workflow_id=e1").collect()
    assert [r["Task ID"] for r in back] == ["a", "b"]
    assert [r["Value"] for r in back] == ["0", "N/A"]
    assert back[1]["Transition Time (s)"] == 0.2 and back[1]["Total Time (s)"] == 1.0
    arrays = timing.waiting_execution(phases)
    printed = documents.printed_arrays(arrays, ["workflow_id"], ["waiting_time", "execution_time"]).first()
    assert printed.waiting_time == "[0.150, 0.100]" and printed.execution_time == "[0.750, 0.700]"
    table = files.markdown_lines(timing.timing_table(phases)).orderBy("line_no").collect()
    assert table[0].line.startswith("|  **Task**")
    assert table[2].line == "| **task_00** |          0.000 |          0.150 |            0.900 |"


def test_upsert_by_usecase(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "usecase string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "usecase string, v int")
    got = sorted(tuple(r) for r in documents.upsert_by_key(old, new).collect())
    assert got == [("a", 1), ("b", 20), ("c", 30)]


def test_benchmark_document_and_json_sink(spark, tmp_path):
    t0 = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    tt = spark.range(3).select(
        F.lit("w").alias("workflow_id"), F.col("id").alias("task_no"),
        F.format_string("task_%02d", "id").alias("task"),
        (t0 + F.make_dt_interval(secs=F.col("id") * 2 + 0.0004)).alias("created_at"),
        (t0 + F.make_dt_interval(secs=F.col("id") * 2 + 0.5)).alias("started_at"),
        (t0 + F.make_dt_interval(secs=F.col("id") * 2 + 1.5)).alias("completed_at"),
        t0.alias("zero_at"), F.lit(None).cast("timestamp").alias("own_created_at"),
        F.concat(F.col("id").cast("string"), F.lit("@h")).alias("worker"),
    )
    arrays = documents.benchmark_arrays(timing.normalize_workers(tt, "numeric"))
    doc = documents.benchmark_document(arrays, "python", "t", "d", usecase=F.lit("fibonacci_10_33"))
    r = doc.first()
    assert r.created_at == [0.0, 2.0, 4.0] and r.completed_at == [1.5, 3.5, 5.5]
    assert r.worker_execution == [0, 1, 2] and r.workers == 3 and r.version == "2.34.0"
    out = str(tmp_path / "docs")
    entries = documents.document_entries(doc)
    files.write_documents(entries, out)
    (line,) = [json.loads(line) for f in sorted((tmp_path / "docs").glob("part-*")) for line in f.read_text().splitlines()]
    assert line == {"version": "2.34.0", "usecases": {"fibonacci_10_33": {"title": "t", "description": "d", "python": {
        "workers": 3, "created_at": [0.0, 2.0, 4.0], "started_at": [0.5, 2.5, 4.5], "completed_at": [1.5, 3.5, 5.5],
        "worker_execution": [0, 1, 2]}}}}


def test_documents_are_merged_by_usecase_and_swapped(spark, tmp_path):
    """A stored document with several use cases, pretty-printed, keeps those that aren't replaced."""
    (tmp_path / "stored").mkdir()
    old = {"version": "1", "usecases": {u: {"title": f'old "{u}"', "description": "", "rust": {"workers": 1, "created_at": [0.1]}}
                                        for u in ("a", "b")}}
    (tmp_path / "stored" / "doc.json").write_text(json.dumps(old, indent=4))
    stored = files.read_documents(spark, str(tmp_path / "stored"), multiline=True)
    assert sorted(r.usecase for r in stored.collect()) == ["a", "b"]
    new = stored.where("usecase = 'b'").select(
        F.lit("2").alias("version"), "usecase", F.map_concat("fields", F.create_map(F.lit("python"), F.lit('{"workers":2}'))).alias("fields"))
    path = str(tmp_path / "doc")
    files.write_documents(stored, path)
    files.commit_documents(new, path)
    got = {r.usecase: (r.version, dict(r.fields)) for r in files.read_documents(spark, path).collect()}
    version, kept = got["a"]
    assert version == "1" and kept["title"] == 'old "a"' and json.loads(kept["rust"]) == {"workers": 1, "created_at": [0.1]}
    # The document keeps the version it was made with.
    assert got["b"][0] == "1" and got["b"][1]["python"] == '{"workers":2}'
    assert sorted(f.name for f in tmp_path.iterdir()) == ["doc", "stored"]


def entries_of(spark, version, **titles):
    rows = [(version, k, {"title": t, "description": "d", "python": '{"workers":1}'}) for k, t in titles.items()]
    return spark.createDataFrame(rows, "version string, usecase string, fields map<string,string>")


def titles_in(spark, path):
    return {r.usecase: (r.version, r.fields["title"]) for r in files.read_documents(spark, path).collect()}


def test_commit_log_keeps_replaces_and_compacts(spark, tmp_path):
    path = str(tmp_path / "doc")
    assert files.read_documents(spark, path).count() == 0
    assert files.commit_documents(entries_of(spark, "1", a="a1", b="b1"), path) == 1
    assert files.commit_documents(entries_of(spark, "9", b="b2", c="c2"), path) == 2
    want = {"a": ("1", "a1"), "b": ("1", "b2"), "c": ("1", "c2")}
    assert titles_in(spark, path) == want
    assert files.compact_documents(spark, path) == 3 and titles_in(spark, path) == want
    assert len(files.document_state(spark, path)[1]["parts"]) == 1
    files.commit_documents(entries_of(spark, "1", c="c4"), path)
    assert titles_in(spark, path) == {**want, "c": ("1", "c4")}
    # A key repeated in one commit has one entry; an empty commit changes nothing.
    twice = entries_of(spark, "1", d="x").unionByName(entries_of(spark, "1", d="y"))
    files.commit_documents(twice, path)
    files.commit_documents(twice.where("false"), path)
    assert titles_in(spark, path) == {**want, "c": ("1", "c4"), "d": ("1", "y")}


@pytest.mark.parametrize("step", ["write_part", "publish_version", "rename"])
def test_a_crash_between_any_two_steps_loses_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "doc")
    files.commit_documents(entries_of(spark, "1", a="a1"), path)
    before = titles_in(spark, path)

    def crash(*args, **kwargs):
        if step == "rename":  # the version's file is written, not yet in its place
            (tmp_path / "doc" / "staged").mkdir(exist_ok=True)
            (tmp_path / "doc" / "staged" / "half").write_text('{"version"')
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(files, "write_part" if step == "write_part" else "publish_version", crash)
        with pytest.raises(OSError):
            files.commit_documents(entries_of(spark, "1", a="a2", b="b2"), path)
    assert titles_in(spark, path) == before
    files.commit_documents(entries_of(spark, "1", b="b3"), path)
    assert titles_in(spark, path) == {**before, "b": ("1", "b3")}


def test_two_writers_keep_each_others_entries(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "doc")
    files.commit_documents(entries_of(spark, "1", a="a1"), path)
    real, others = files.publish_version, []

    def publish(session, at, n, manifest):
        if not others:  # the other writer commits after this one has read the state
            others.append(n)
            files.commit_documents(entries_of(spark, "1", b="b2", a="a2"), path)
        real(session, at, n, manifest)

    monkeypatch.setattr(files, "publish_version", publish)
    assert files.commit_documents(entries_of(spark, "1", c="c3"), path) == 3
    assert titles_in(spark, path) == {"a": ("1", "a2"), "b": ("1", "b2"), "c": ("1", "c3")}
    with pytest.raises(files.CommitConflict):
        real(spark, path, 2, {"version": "1", "parts": []})


def test_last_of_a_repeated_key_wins(spark):
    old = spark.createDataFrame([("1", "a", 1), ("1", "b", 2)], "version string, usecase string, v int")
    new = spark.createDataFrame([("2", "b", 30), ("2", "b", 20), ("2", "c", 9)], "version string, usecase string, v int")
    got = sorted(tuple(r) for r in documents.upsert_by_key(old, new.withColumn("at", F.col("v") * -1), order=F.col("at")).select("version", "usecase", "v").collect())
    assert got == [("1", "a", 1), ("1", "b", 20), ("1", "c", 9)]
    assert [tuple(r) for r in documents.upsert_by_key(old.where("false"), new.where("v = 9")).collect()] == [("2", "c", 9)]


def test_segments_join_to_one_document(spark, tmp_path):
    """A hot workflow of 30,000 tasks beside small ones: no row above some KB, the files' lines parse as the whole document."""
    tt = spark.range(30_010).select(
        F.when(F.col("id") < 30_000, "hot").when(F.col("id") < 30_009, 'b"1').otherwise("one").alias("workflow_id"), F.col("id").alias("task_no"),
        F.format_string("task_%02d", "id").alias("task"), F.lit("x").alias("extra"),
        *[(F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(secs=F.col("id") + x)).alias(c)
          for c, x in (("created_at", 0.0), ("started_at", 0.25), ("completed_at", 1.0))],
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("zero_at"), F.concat((F.col("id") % 3).cast("string"), F.lit("@h")).alias("worker"))
    arrays = documents.benchmark_arrays(timing.normalize_workers(tt, "numeric"))
    segments = documents.document_segments(arrays, "python", 'a "title"', "d")
    assert segments.agg(F.max(F.length("value"))).first()[0] < 20_000
    files.write_segments(segments, str(tmp_path / "segments"), num_partitions=9)
    hot = sorted((tmp_path / "segments" / "usecase=hot").glob("part-*"))
    assert len(hot) > 3
    doc = json.loads("\n".join(f.read_text() for f in hot))
    body = doc["usecases"]["hot"]["python"]
    assert doc["version"] == "2.34.0" and doc["usecases"]["hot"]["title"] == 'a "title"' and body["workers"] == 3
    assert body["created_at"] == [float(i) for i in range(30_000)] and body["completed_at"] == [i + 1.0 for i in range(30_000)]
    assert body["worker_execution"] == [i % 3 for i in range(30_000)]
    whole = {r["usecase"]: r for r in documents.benchmark_document(arrays, "python", 'a "title"', "d").collect()}
    values = {}
    for r in segments.orderBy("part", "chunk").collect():
        values[r.usecase] = values.get(r.usecase, "") + r.value
    for usecase, text in values.items():
        entry = json.loads(text)["usecases"][usecase]["python"]
        assert entry.pop("workers") == whole[usecase]["workers"]
        assert entry == {c: whole[usecase][c] for c in entry} and ("worker_execution" in entry) == (whole[usecase]["workers"] > 1)


def test_pieces_of_printed_arrays_join_to_the_whole(spark):
    rows = spark.range(25).selectExpr("'w' as workflow_id", "id as pos", "id / 4 as v")
    pieces = documents.printed_arrays(rows, ["workflow_id"], ["v"], piece=10).orderBy("chunk").collect()
    whole = documents.printed_arrays(rows, ["workflow_id"], ["v"], piece=100).collect()
    assert len(pieces) == 3 and "".join(p.v for p in pieces) == whole[0].v
    assert whole[0].v.startswith("[0.000, 0.250") and whole[0].v.endswith("6.000]")


def test_csv_phases_keep_line_order_and_feed_the_tables(spark, tmp_path):
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    phases = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("workflow_id"), F.col("id").alias("pos"),
        F.col("id").cast("string").alias("task_run_id"), F.lit("v").alias("value"),
        (start + F.make_dt_interval(secs=F.col("id") * 2)).alias("created_at"),
        (start + F.make_dt_interval(secs=F.col("id") * 2 + 0.25)).alias("started_at"),
        (start + F.make_dt_interval(secs=F.col("id") * 2 + 1)).alias("success_at"),
        *[F.lit(0.0).alias(f"{c}_s") for c in ("transition", "assignment", "execution", "total")])
    for per_workflow in (True, False):
        out = str(tmp_path / f"csv-{per_workflow}")
        files.write_timing_csv(phases, out, num_partitions=4, per_workflow=per_workflow)
        back = runlogs.read_csv_phases(spark, out)
        got = [(r.workflow_id, r.pos, r.task_run_id) for r in back.orderBy("workflow_id", "pos").collect()]
        want = [("x", i, str(3 * i)) for i in range(100)] + [("y", i, str(i // 2 * 3 + 1 + i % 2)) for i in range(200)]
        assert got == want
        assert timing.timing_table(back).where("workflow_id = 'x' and pos = 1").first().relative_started == 6.25
    arrays = str(tmp_path / "arrays")
    files.write_waiting_execution_csv(timing.waiting_execution(back), arrays)
    first = spark.read.option("header", "true").csv(arrays).where("workflow_id = 'x'").first()
    assert (first.waiting_time, first.execution_time) == ("0.250", "0.750")


def test_task_run_listing_and_job_predicates(spark, tmp_path):
    runs = [{"id": f"r{i}", "created": f"2024-01-01T00:00:0{i}Z", "start_time": f"2024-01-01T00:00:0{i + 1}Z",
             "end_time": None if i == 2 else f"2024-01-01T00:00:0{i + 2}Z"} for i in (3, 1, 2)]
    (tmp_path / "runs.json").write_text("\n".join(json.dumps(r) for r in runs))
    phases = runlogs.task_run_phases(runlogs.read_task_runs(spark, str(tmp_path / "runs.json")))
    assert [(r.pos, r.task_run_id) for r in phases.orderBy("pos").collect()] == [(0, "r1"), (1, "r3")]
    tt = timing.phase_timing(phases)
    assert timing.phase_breakdown_by_duration(tt).first().total_tasks == 2
    texts = runlogs.job_predicates(["a", "b'c", "d"], per_read=2)
    assert len(texts) == 2 and "'b''c'" in texts[0] and texts[1].startswith("id IN ('d') OR parent_job IN ('d')")
    assert "SELECT" not in runlogs.job_predicates(["a"], multi_worker=False)[0]


def test_result_sinks_views_and_tables(spark, tmp_path, capsys):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    path = files.write_result(df, str(tmp_path), "1g", "q1")
    assert path.endswith("/tpc-h/1g/output/q1.parquet") and spark.read.parquet(path).collect() == df.collect()
    files.preview(spark.read.parquet(path))
    assert "|1  |x  |" in capsys.readouterr().out
    spark.sql(f"CREATE TABLE load_target (k INT, v STRING) USING parquet LOCATION '{tmp_path}/target'")
    try:
        tables.load_into_table(df, "load_target")
        tables.load_into_table(df, "load_target")
        assert spark.table("load_target").count() == 2
    finally:
        spark.sql("DROP TABLE load_target")
    tables.configure_object_store(spark, access_key="a", secret_key="b", endpoint="http://store", path_style=True)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert conf.get("fs.s3a.endpoint") == "http://store" and conf.get("fs.s3a.path.style.access") == "true"


def test_read_documents_missing_path_is_empty(spark, tmp_path):
    assert files.read_documents(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.json").write_text("{broken")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_documents(spark, str(tmp_path / "d")).collect()


def test_streaming_landed_run_documents(spark, tmp_path):
    from tally.streaming.landed_runs import stream_run_documents

    src = tmp_path / "landed"
    src.mkdir()
    for wf in ("r1", "r2"):
        doc = {"workflow_id": wf, "run": {"createdAt": "2024-01-01T00:00:00Z"},
               "shape": [{"taskName": "task_0", "taskExternalId": f"{wf}-0"}],
               "taskEvents": [{"taskId": f"{wf}-0", "eventType": t, "timestamp": f"2024-01-01T00:00:0{i + 1}Z",
                               "workerId": "w"} for i, t in enumerate(["QUEUED", "STARTED", "FINISHED"])]}
        (src / f"{wf}.json").write_text(json.dumps(doc))
    out = tmp_path / "out"
    q = stream_run_documents(spark, str(src), str(out), checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(out)).select("workflow_id", "task").collect()
    assert sorted((r.workflow_id, r.task) for r in got) == [("r1", "task_0"), ("r2", "task_0")]


def test_read_table_sees_files_appended_below_a_partition(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).selectExpr("id", "1 as d").write.partitionBy("d").parquet(f"{root}/t.parquet")
    assert tables.read_table(spark, root, "t").count() == 3
    spark.range(4).write.mode("append").parquet(f"{root}/t.parquet/d=1")
    assert tables.read_table(spark, root, "t").count() == 7


def test_a_missing_column_raises(spark, tmp_path):
    from tally.sources.fixtures import tpch_frames

    spark.createDataFrame([(1, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    with pytest.raises(ValueError, match="r_comment"):
        tpch_frames(spark, str(tmp_path), ("region",))
    full = tmp_path / "full"
    spark.createDataFrame([(1, "EUROPE", "c")], tables.schema("region")).write.parquet(f"{full}/region.parquet")
    assert tpch_frames(spark, str(full), ("region",))["region"].count() == 1


def test_text_sink_splits_a_hot_workflow_and_keeps_line_order(spark, tmp_path):
    import pathlib

    rows = [("hot", i, f"line {i:05d}") for i in range(3000)] + [("cold", i, f"c {i}") for i in range(5)]
    df = spark.createDataFrame(rows, "workflow_id string, pos long, line string")
    out = tmp_path / "text"
    files.write_text_by_workflow(df, "line", str(out), order_col="pos", num_partitions=6)
    parts = sorted(pathlib.Path(out, "workflow_id=hot").glob("part-*"))
    assert len(parts) > 1                                     # the hot workflow is written by several tasks
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert lines == [f"line {i:05d}" for i in range(3000)]
