"""Result documents: parallel arrays per workflow (T14, K4) and keyed upsert (K5).

The long ``task_timing`` table is the primary result. ``benchmark_arrays`` and
``printed_arrays`` pack it in pieces of at most ``piece`` tasks - one row per
``(workflow, chunk)`` - so no row holds an unbounded workflow; concatenating
the pieces in order gives the full arrays and the full printed text.
``benchmark_document`` makes the result document itself, one value per use
case, which is as long as the workflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.timefn import micros_between, round_ms
from tally.operators.sequence import ordinal
from tally.operators.timing import WF, _task_order

PIECE = 1024                 # tasks per packed row unless the caller says otherwise
DOCUMENT_VERSION = "2.34.0"  # fixed value: version field of a new document
ARRAYS = ["created_at", "started_at", "completed_at"]


def _packed(df: DataFrame, group: list[str], value_cols: list[str], piece: int) -> DataFrame:
    """Sorted ``collect_list`` per (group, chunk) of the named columns, ordered by ``pos``; ``last`` marks the last chunk."""
    items = F.sort_array(F.collect_list(F.struct("pos", *value_cols)))
    packed = df.withColumn("chunk", F.floor(F.col("pos") / piece).cast("long")).groupBy(*group, "chunk").agg(
        items.alias("_items"))
    ends = df.groupBy(*group).agg(F.floor(F.max("pos") / piece).cast("long").alias("_end"))
    return packed.join(ends, group).select(
        *group, "chunk", (F.col("chunk") == F.col("_end")).alias("last"),
        *[F.transform("_items", _field(c)).alias(c) for c in value_cols])


def _field(name: str):
    return lambda x: x[name]


def benchmark_arrays(tt: DataFrame, worker_index_col: str | None = "worker_index", clamp: bool = False,
                     piece: int = PIECE) -> DataFrame:
    """Per (workflow, chunk) arrays ``created_at``, ``started_at``, ``completed_at``
    (seconds from zero, 3 decimals) and ``worker_execution`` when an index column is given.
    Also ``workers`` = distinct workers of the workflow.
    """
    rel = lambda c: round_ms(micros_between("zero_at", c))
    df = _task_order(tt).withColumns({f"_{c}": rel(c) for c in ARRAYS})
    if clamp:
        df = df.withColumns({f"_{c}": F.greatest(F.lit(0.0), F.col(f"_{c}")) for c in ARRAYS})
    df = df.select(WF, "pos", "worker", *(f"_{c}" for c in ARRAYS),
                   *([F.col(worker_index_col).alias("_worker_execution")] if worker_index_col else []))
    values = [f"_{c}" for c in ARRAYS] + (["_worker_execution"] if worker_index_col else [])
    packed = _packed(df, [WF], values, piece)
    workers = df.groupBy(WF).agg(F.count_distinct("worker").cast("int").alias("workers"))
    return packed.join(workers, WF).select(WF, "chunk", "last", "workers", *[F.col(v).alias(v[1:]) for v in values])


def benchmark_document(arrays: DataFrame, language: str, title: str, description: str,
                       usecase: Column | None = None, configured_workers: int | None = None) -> DataFrame:
    """One row per use case (each workflow's own id unless ``usecase`` says otherwise).

    ``version, usecase, title, description, language, workers`` and the whole
    arrays. ``worker_execution`` is kept only when more than one worker is
    configured (or, if not configured, observed).
    """
    values = [c for c in (*ARRAYS, "worker_execution") if c in arrays.columns]
    pieces = F.sort_array(F.collect_list(F.struct("chunk", *values)))
    whole = arrays.groupBy(WF).agg(F.first("workers").alias("workers"), pieces.alias("_p")).select(
        WF, "workers", *[F.flatten(F.transform("_p", _field(c))).alias(c) for c in values])
    if configured_workers is not None:
        whole = whole.withColumn("workers", F.lit(configured_workers))
    if "worker_execution" in values:
        whole = whole.withColumn("worker_execution", F.when(F.col("workers") > 1, F.col("worker_execution")))
    return whole.select(
        F.lit(DOCUMENT_VERSION).alias("version"), (F.col(WF) if usecase is None else usecase).alias("usecase"),
        F.lit(title).alias("title"), F.lit(description).alias("description"), F.lit(language).alias("language"),
        "workers", *values)


def document_segments(arrays: DataFrame, language: str, title: str, description: str,
                      configured_workers: int | None = None) -> DataFrame:
    """K4/T14 for workflows of any length: the document of each use case in pieces.

    ``arrays``: of ``benchmark_arrays``. Rows ``usecase, part, chunk, value``:
    part 0 is the header, parts 1.. are the arrays, a row for each chunk, the
    last part closes the document. The values of a use case in the order of
    ``part, chunk``, white space or nothing between them, are the JSON text
    ``{"version": .., "usecases": {<usecase>: {title, description, <language>: {workers, arrays}}}}``;
    no row holds more than a chunk. ``worker_execution`` is there only with more than one worker.
    """
    workers = F.col("workers") if configured_workers is None else F.lit(configured_workers)
    values = [c for c in (*ARRAYS, "worker_execution") if c in arrays.columns]
    body = F.explode(F.array(*[F.struct(
        F.lit(i).alias("part"), F.lit(c).alias("name"), F.lit(c == "worker_execution").alias("mapped"),
        F.array_join(F.transform(c, lambda x: F.format_string("%d" if c == "worker_execution" else "%.3f", x)), ", ").alias("text"))
        for i, c in enumerate(values, 1)])).alias("b")
    rows = arrays.select(F.col(WF).alias("usecase"), "chunk", "last", workers.alias("workers"), body).where("not b.mapped or workers > 1")
    opened = F.when(F.col("chunk") == 0, F.concat(F.lit(', "'), F.col("b.name"), F.lit('": ['))).otherwise("")
    closed = F.when(F.col("last"), "]").otherwise(", ")
    pieces = rows.select("usecase", F.col("b.part").alias("part"), "chunk", F.concat(opened, "b.text", closed).alias("value"))
    # Header and tail from the first chunk's row: every workflow has one.
    head = F.concat(
        F.lit('{"version": '), _json_text(F.lit(DOCUMENT_VERSION)), F.lit(', "usecases": {'), _json_text("usecase"), F.lit(': {"title": '),
        _json_text(F.lit(title)), F.lit(', "description": '), _json_text(F.lit(description)), F.lit(", "), _json_text(F.lit(language)),
        F.lit(': {"workers": '), F.col("workers").cast("string"))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("part"), head.alias("value")),
                             F.struct(F.lit(len(values) + 1).alias("part"), F.lit("}}}}").alias("value")))).alias("e")
    first = arrays.where("chunk = 0").select(F.col(WF).alias("usecase"), workers.alias("workers"))
    return first.select("usecase", ends).select("usecase", "e.part", F.lit(0).cast("long").alias("chunk"), "e.value").unionByName(pieces)


def _json_text(value) -> Column:
    """A string as JSON text, quoted and escaped."""
    return F.regexp_extract(F.to_json(F.array(value)), r"^\[(.*)\]$", 1)


def document_entries(doc: DataFrame) -> DataFrame:
    """Rows ``version, usecase, fields``: the document's ``usecases`` map, one entry a row.

    ``fields`` maps ``title`` and ``description`` to their text and the
    language to the JSON text of its arrays.
    """
    body = F.to_json(F.struct("workers", *[c for c in (*ARRAYS, "worker_execution") if c in doc.columns]))
    fields = F.map_from_arrays(F.array(F.lit("title"), F.lit("description"), "language"), F.array("title", "description", body))
    return doc.select("version", "usecase", fields.alias("fields"))


def document_lines(entries: DataFrame) -> DataFrame:
    """``usecase, value``: each entry as a document ``{version, usecases: {<usecase>: {...}}}`` of its own."""
    plain = lambda k: k.isin("title", "description")
    one_line = lambda v: F.regexp_replace(v, r"\s*\n\s*", " ")  # noqa: E731 - line ends in JSON text stand between values only
    pairs = F.transform(F.map_entries("fields"), lambda e: F.concat(
        _json_text(e["key"]), F.lit(": "), F.when(plain(e["key"]), _json_text(e["value"])).otherwise(one_line(e["value"]))))
    return entries.select("usecase", F.concat(
        F.lit('{"version": '), _json_text("version"), F.lit(', "usecases": {'), _json_text("usecase"), F.lit(": {"),
        F.array_join(pairs, ", "), F.lit("}}}")).alias("value"))


def last_of_key(rows: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """One row of each key: the one with the largest ``order``, or, without it, with the largest JSON text."""
    by = F.to_json(F.struct(*rows.columns)) if order is None else order
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), by).alias("_last")).select("_last.*")


def upsert_by_key(existing: DataFrame, new: DataFrame, key: str | list[str] = "usecase", order: Column | None = None) -> DataFrame:
    """K5: rows of ``new`` replace rows of ``existing`` with the same key; others kept.

    Of rows of ``new`` that repeat a key, the last by ``order`` counts (see
    ``last_of_key``). If ``existing`` has a ``version``, new rows take it: the
    version is the document's, not the entry's.
    Write the result to a fresh path and swap, never over the input in place
    (``sinks.files.commit_documents`` does neither: it appends to a log).
    """
    keys = [key] if isinstance(key, str) else list(key)
    last = last_of_key(new, keys, order)
    kept = existing.join(last.select(*keys), keys, "left_anti").select(existing.columns)
    if "version" in existing.columns and "version" in new.columns:
        stored = existing.agg(F.max("version").alias("_stored"))  # one row, null if nothing is stored
        last = last.join(F.broadcast(stored)).withColumn("version", F.coalesce("_stored", "version")).drop("_stored")
    return kept.unionByName(last, allowMissingColumns=True)


def printed_array(values_col: str, fmt: str = "%.3f", first: Column | bool = True, last: Column | bool = True) -> Column:
    """K9: ``[v1, v2, ...]`` with fixed decimals, from an array column.

    Brackets stand only where ``first`` / ``last`` hold; a piece that isn't
    the last ends in a comma, so the pieces' texts join to the whole one.
    """
    return F.concat(
        F.when(F.lit(first), "[").otherwise(""),
        F.array_join(F.transform(values_col, lambda x: F.format_string(fmt, x)), ", "),
        F.when(F.lit(last), "]").otherwise(", "),
    )


def printed_arrays(df: DataFrame, group: list[str], value_cols: list[str], piece: int = PIECE) -> DataFrame:
    """K9 over long rows (``pos`` + values): the printed array of each value column, in pieces."""
    packed = _packed(df, group, value_cols, piece)
    first, last = F.col("chunk") == 0, F.col("last")
    return packed.select(*group, "chunk", *[printed_array(c, first=first, last=last).alias(c) for c in value_cols])


def worker_activities(starts: DataFrame, chunk: int = PIECE) -> DataFrame:
    """Per (workflow, worker) the tasks that the worker started, in event order (``timing.worker_starts``).

    One row per ``(workflow, worker, chunk)`` with ``activities`` (at most
    ``chunk`` task labels) and ``tasks``, the worker's total; concatenating
    the chunks in order gives the full list.
    """
    group = [WF, "worker"]
    ranked = ordinal(starts.select(*group, "task", "seq"), group, "seq", out="pos", tie_cols=("task",))
    lists = (
        ranked.withColumn("chunk", F.floor(F.col("pos") / chunk).cast("long"))
        .groupBy(*group, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "task"))).alias("_items"))
    )
    totals = ranked.groupBy(*group).agg(F.count(F.lit(1)).alias("tasks"))
    return lists.join(totals, group).select(
        *group, "chunk", F.col("tasks").cast("long").alias("tasks"), F.transform("_items", _field("task")).alias("activities"))
