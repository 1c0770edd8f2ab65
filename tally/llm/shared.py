"""Folders and fold rules shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import ensure_checkpoint_dir

BATCH_ROWS = 1000
#: ``[^\x20\x09-\x0D]+`` as Java and DuckDB regular expressions read it.
WORD = r"[^\x20\x09-\x0D]+"
#: One or more of the characters that the exact-duplicate normalisation deletes.
BLANK = r"[\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, rows: int | None = None, per_task: int = 50_000) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage like a checkpoint, keeps the columns prunable, and a lost
    executor costs nothing that was written. ``rows``, an upper bound counted
    from what ``df`` is made of, lets a slim table be dealt anew to as many
    tasks as its rows fill (``per_task`` each) before it is written, instead of
    one small file for each shuffle partition. (``coalesce`` would run all the
    merged partitions' joins in one task, with the memory of all their sorts.)
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    if rows is not None:
        tasks = max(1, -(-rows // per_task))
        if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")):
            df = df.repartition(tasks)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def hash_share(key: Column, bound: int, total: int) -> Column:
    """True for about ``bound`` of ``total`` rows, chosen by the hash of ``key`` alone."""
    if total <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int((1 << 30) * bound / total)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column (ignoring case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors once per application, and keep Arrow batches small.

    A cluster job started with ``--py-files`` needs no such step; a driver that
    merely has the repository on its own path does. Texts are long: a batch
    of Spark's 10,000 rows takes tens of MB in the JVM and again in Python, so
    ``BATCH_ROWS`` is set unless the session has a value of its own.
    """
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(sc, "_tally_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tally-package-")) / "tally_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._tally_shipped = True
