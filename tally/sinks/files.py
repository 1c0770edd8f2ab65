"""Sinks (K1-K9): Parquet results, timing CSV, markdown tables, stats reports, JSON documents.

Every sink is one DataFrame write; text outputs are built as columns first
(``format_string``) and written with ``write.text``, so report generation
runs on the executors like the rest of the job. Reports are partitioned by
workflow, one file set per output.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.timefn import fixed3, fixed_ratio
from tally.operators.documents import DOCUMENT_VERSION, document_lines, last_of_key
from tally.operators.timing import TIMING_TABLE_HEADER, WF

DOCUMENT_LINE = "version string, usecases map<string, map<string, string>>"

# The report text.
PHASE_REPORT = (
    "# Performance Statistics\n\n## Total Duration: %ss\n\n## Average Times\n\n"
    "- **Execution time**: %ss (%s%% of total)\n"
    "  - The time it takes for the orchestrator to execute the task once it has been assigned to an executor\n\n"
    "- **Assignment time**: %ss (%s%% of total)\n"
    "  - The time it takes for a task to be assigned to an executor once it has been created in the queue\n\n"
    "- **Transition time**: %ss (%s%% of total)\n"
    "  - The time it takes to create the following task once a task is finished\n\n"
    "Total tasks analyzed: %d\n"
)


def result_path(root: str, scale: str, query: str) -> str:
    return f"{root.rstrip('/')}/tpc-h/{scale}/output/{query}.parquet"


def write_result(df: DataFrame, root: str, scale: str, query: str) -> str:
    """K1/K2: query result as Parquet, overwriting, one path per scale and query."""
    path = result_path(root, scale, query)
    df.write.mode("overwrite").parquet(path)
    return path


def preview(df: DataFrame, n: int = 20) -> None:
    """K3: console preview. Call after the write (or on a written table), not before it."""
    df.show(n, truncate=False)


def timing_csv(phases: DataFrame) -> DataFrame:
    """K6: history-phase rows in the timing-CSV layout (times with microseconds)."""
    ts = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return phases.select(
        WF, "pos",
        F.col("task_run_id").alias("Task ID"),
        F.col("value").alias("Value"),
        ts("created_at").alias("Created Time"),
        ts("started_at").alias("Started Time"),
        ts("success_at").alias("Success Time"),
        F.col("transition_s").alias("Transition Time (s)"),
        F.col("assignment_s").alias("Assignment Time (s)"),
        F.col("execution_s").alias("Execution Time (s)"),
        F.col("total_s").alias("Total Time (s)"),
    )


def _ordered_by_workflow(df: DataFrame, order_col: str, num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``(workflow, order_col)`` and sort inside each partition.

    Range partitioning splits a hot workflow's key range over several
    tasks (hash partitioning on the workflow would give it one task), and
    partitions are numbered in key order, so a workflow's part files read in
    name order give its rows in order. ``num_partitions`` defaults to the
    session's shuffle partitions, coalesced by AQE.
    """
    keys = [WF, order_col]
    out = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)


def _write_csv(rows: DataFrame, path: str, num_partitions: int | None, per_workflow: bool) -> None:
    ordered = _ordered_by_workflow(rows, "pos", num_partitions).drop("pos")
    writer = ordered.write.mode("overwrite").option("header", "true")
    (writer.partitionBy(WF) if per_workflow else writer).csv(path)


def write_timing_csv(phases: DataFrame, path: str, num_partitions: int | None = None, per_workflow: bool = True) -> None:
    """K6: CSV with header, no index, one directory per workflow (``workflow_id=<id>/``).

    A large workflow may span several part files (each with its header); read
    in name order they give its tasks in order. ``per_workflow=False`` keeps
    the workflow as a column instead: with millions of workflows, a folder for
    each would be millions of small files.
    """
    _write_csv(timing_csv(phases), path, num_partitions, per_workflow)


def write_waiting_execution_csv(arrays: DataFrame, path: str, num_partitions: int | None = None,
                                per_workflow: bool = True) -> None:
    """K6 (arrays form): ``waiting_time, execution_time`` with 3 decimals, laid out like ``write_timing_csv``."""
    _write_csv(waiting_execution_csv(arrays), path, num_partitions, per_workflow)


def waiting_execution_csv(arrays: DataFrame) -> DataFrame:
    """K6 (arrays form): ``waiting_time, execution_time`` with ``%.3f``."""
    return arrays.select(WF, "pos", fixed3("waiting_time").alias("waiting_time"),
                         fixed3("execution_time").alias("execution_time"))


def markdown_lines(table_rows: DataFrame) -> DataFrame:
    """K7: header lines + one row line per task, per workflow, ordered by ``line_no``."""
    header = (
        table_rows.select(WF).distinct()
        .select(WF, F.posexplode(F.array(*[F.lit(h) for h in TIMING_TABLE_HEADER])).alias("i", "line"))
        .select(WF, (F.col("i") - F.lit(len(TIMING_TABLE_HEADER))).cast("long").alias("line_no"), "line")
    )
    return header.unionByName(table_rows.select(WF, F.col("pos").alias("line_no"), "line"))


def stats_report(stats: DataFrame) -> DataFrame:
    """K8: the statistics report of ``phase_breakdown_by_duration`` as one text per workflow.

    Numbers are rounded exactly from the integer microsecond sums
    (``fixed_ratio``) before printing.
    """
    n = F.col("total_tasks")
    many = n > 1
    zero3, zero2 = F.lit("0.000"), F.lit("0.00")
    return stats.select(
        WF,
        F.format_string(
            "# Performance Statistics\n\n## Total Duration: %ss\n\n## Average Times\n\n"
            "- **Execution time**: %ss (%s%%)\n- **Assignment time**: %ss (%s%%)\n"
            "- **Transition time**: %ss (%s%%)\n\nTotal tasks analyzed: %d\n",
            fixed_ratio("total_us", F.lit(1_000_000), 3),
            fixed_ratio("exec_us", n * 1_000_000, 3), fixed_ratio("exec_us", "total_us", 2, 100),
            fixed_ratio("assign_us", n * 1_000_000, 3), fixed_ratio("assign_us", "total_us", 2, 100),
            F.when(many, fixed_ratio("trans_us", (n - 1) * 1_000_000, 3)).otherwise(zero3),
            F.when(many, fixed_ratio("trans_us", "total_us", 2, 100)).otherwise(zero2),
            n,
        ).alias("report"),
    )


def phase_report(stats: DataFrame) -> DataFrame:
    """K8, second layout: each phase with what it means (fixed text), one report per workflow."""
    n = F.col("total_tasks")
    many = n > 1
    return stats.select(
        WF,
        F.format_string(
            PHASE_REPORT,
            fixed_ratio("total_us", F.lit(1_000_000), 3),
            fixed_ratio("exec_us", n * 1_000_000, 3), fixed_ratio("exec_us", "total_us", 2, 100),
            fixed_ratio("assign_us", n * 1_000_000, 3), fixed_ratio("assign_us", "total_us", 2, 100),
            F.when(many, fixed_ratio("trans_us", (n - 1) * 1_000_000, 3)).otherwise(F.lit("0.000")),
            F.when(many, fixed_ratio("trans_us", "total_us", 2, 100)).otherwise(F.lit("0.00")),
            n,
        ).alias("report"),
    )


def write_text_by_workflow(df: DataFrame, text_col: str, path: str, order_col: str | None = None,
                           num_partitions: int | None = None) -> None:
    """Write one text file set per workflow (``workflow_id=<id>/``), lines in ``order_col`` order.

    A large workflow may span several part files; read in name order they
    give its lines in order.
    """
    out = _ordered_by_workflow(df, order_col or text_col, num_partitions)
    out.select(WF, text_col).write.mode("overwrite").partitionBy(WF).text(path)


def write_documents(entries: DataFrame, path: str) -> None:
    """K4: document entries, one ``{version, usecases: {<usecase>: {...}}}`` a line, to a new folder.

    To add to or replace entries of a stored document, these files too: ``commit_documents``.
    """
    document_lines(entries).select("value").write.text(path)


# --- the document as a commit log ------------------------------------------------
#
# <path>/parts/<id>/      entries of one commit, immutable
# <path>/versions/<n>     {"version": .., "parts": [ids, oldest first]}: the document after commit n


class CommitConflict(Exception):
    """Another writer made the version first."""


def _fs(spark, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def document_state(spark, path: str) -> tuple[int, dict | None]:
    """``(n, manifest)`` of the newest version below ``path``; ``(0, None)`` if it has none."""
    fs, at = _fs(spark, f"{path.rstrip('/')}/versions")
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    newest = max((int(n) for n in names if n.isdigit()), default=0)
    if not newest:
        return 0, None
    text = spark.read.option("wholetext", "true").text(f"{path.rstrip('/')}/versions/{newest:09d}").first()[0]
    return newest, json.loads(text)


def publish_version(spark, path: str, n: int, manifest: dict) -> None:
    """Make version ``n`` in one step: a whole file is renamed to its number, which fails if that is there already.

    HDFS refuses an existing target atomically.
    """
    jvm, root = spark.sparkContext._jvm, path.rstrip("/")
    fs, staged = _fs(spark, f"{root}/staged/{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/versions/{n:09d}")
    fs.mkdirs(target.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(staged), fs.makeQualified(target), none)
    except Py4JJavaError as error:
        fs.delete(staged, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise CommitConflict(f"{path}: version {n}") from error
        raise


def write_part(entries: DataFrame, path: str) -> str:
    """Write the entries of one commit to a folder of their own; they count once a version names it. Returns its id."""
    part = uuid.uuid4().hex
    document_lines(last_of_key(entries, ["usecase"])).select("value").write.text(f"{path.rstrip('/')}/parts/{part}")
    return part


def commit_documents(entries: DataFrame, path: str, tries: int = 20) -> int:
    """K5: entries replace those of the same use case, all others stay; returns the new version's number.

    Nothing that is stored is written again: a commit adds one immutable part
    and one version. A crash before the version leaves the document as it was;
    a writer that finds its number taken goes on from the version that took
    it, so no writer's entries are lost. The document keeps the ``version``
    text of its first commit. ``compact_documents`` folds many parts into one.
    """
    spark = entries.sparkSession
    part = write_part(entries, path)
    for _ in range(tries):
        n, manifest = document_state(spark, path)
        if manifest is None:
            stored = _plain_entries(spark, path)
            first = (entries if stored is None else stored).agg(F.max("version")).first()[0]
            manifest = {"version": first or DOCUMENT_VERSION, "parts": [] if stored is None else [write_part(stored, path)]}
        try:
            publish_version(spark, path, n + 1, {**manifest, "parts": [*manifest["parts"], part]})
        except CommitConflict:
            continue
        return n + 1
    raise CommitConflict(f"{path}: {tries} versions were taken by others")


def compact_documents(spark, path: str) -> int:
    """Write the document's entries as a single part and publish it; a commit in between makes it fail, not the commit.

    Earlier versions and their parts stay readable until they are removed by hand.
    """
    n, manifest = document_state(spark, path)
    if manifest is None:
        return 0
    part = write_part(read_documents(spark, path), path)
    publish_version(spark, path, n + 1, {**manifest, "parts": [part]})
    return n + 1


def _plain_entries(spark, path: str, multiline: bool = False) -> DataFrame | None:
    """Entries of the files right in ``path``, a document a line (or a file); None without such files."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    if fs.getFileStatus(at).isDirectory():
        files = [f.getPath().toString() for f in fs.listStatus(at) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    else:
        files = [path]
    if not files:
        return None
    docs = spark.read.schema(DOCUMENT_LINE).option("mode", "FAILFAST").option("multiLine", str(multiline).lower()).json(files)
    return docs.select("version", F.explode("usecases").alias("usecase", "fields"))


def _logged_entries(spark, path: str, manifest: dict) -> DataFrame:
    """Entries of all parts, of each use case that of the newest part."""
    parts = [spark.read.schema(DOCUMENT_LINE).option("mode", "FAILFAST").json(f"{path.rstrip('/')}/parts/{p}")
             .select(F.lit(i).alias("part"), F.explode("usecases").alias("usecase", "fields")) for i, p in enumerate(manifest["parts"])]
    rows = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:  # only keys are grouped, the entries themselves stay where they are read
        newest = rows.groupBy("usecase").agg(F.max("part").alias("part"))
        rows = rows.join(newest, ["usecase", "part"], "left_semi")
    return rows.select(F.lit(manifest["version"]).alias("version"), "usecase", "fields")


def write_segments(segments: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """K4: the rows of ``document_segments``, a folder for each use case, a hot one written by many tasks.

    The lines of a use case's files, read in name order, are its JSON document.
    """
    keys = ["usecase", "part", "chunk"]
    dealt = segments.repartitionByRange(num_partitions, *keys) if num_partitions else segments.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).select("usecase", "value").write.mode("overwrite").partitionBy("usecase").text(path)


def read_documents(spark, path: str, multiline: bool = False) -> DataFrame:
    """Entries ``version, usecase, fields`` of existing result documents; a missing path gives none.

    ``path`` is the folder of a commit log (``commit_documents``), or files
    with a document a line; ``multiline`` reads files that hold one document
    with all its use cases.

    Unlike a reset-on-parse-error, a corrupt document fails the read
    (``FAILFAST``), so a merge never silently drops earlier results.
    """
    _, manifest = document_state(spark, path)
    if manifest is not None:
        return _logged_entries(spark, path, manifest)
    stored = _plain_entries(spark, path, multiline)
    return spark.createDataFrame([], "version string, usecase string, fields map<string,string>") if stored is None else stored
