"""Session construction and the few settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every tally job wants: UTC so timestamp arithmetic matches the
# ISO strings of run logs, AQE so join strategy / partition count / skew
# splitting are decided from runtime sizes rather than guesses.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of dropped DataFrames are removed by the context cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "tally", conf: dict | None = None) -> SparkSession:
    """Return (or create) a SparkSession with tally's defaults.

    On a cluster ``master`` stays None so spark-submit decides. Local runs
    (tests, bench) pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset.

    On a cluster the setting names a shared folder (HDFS / object store) that
    survives executor loss. Only a local session without one (tests) gets a
    fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="tally-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def land(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder of the shared ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage like a checkpoint: later branches read the landed rows
    instead of recomputing them, and a lost executor never forces the upstream
    to rerun; unlike one, each branch reads only its columns. Use it where one
    derived table feeds many analyses (a landed run log, the canonical
    ``task_timing`` table). The folder is cleaned as the cluster does for checkpoints.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/landed-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


MB = 1 << 20
SPLIT_BYTES = 256 * MB            # Parquet bytes per scan task
SHUFFLE_TARGET_BYTES = 256 * MB   # shuffled bytes per reduce task before AQE coalescing


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (driver-side metadata call, no data read)."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    total = 0
    for path in ([paths] if isinstance(paths, str) else paths):
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return int(total)


def partition_conf(data_bytes: int, cores: int, max_shuffle_partitions: int | None = None) -> dict:
    """Scan and shuffle partition settings for a job over ``data_bytes`` on ``cores`` task slots.

    Scan splits stay at ``SPLIT_BYTES`` so a task's decoded batch fits in one
    core's share of executor memory. The shuffle starts with about one
    partition per ``SHUFFLE_TARGET_BYTES`` of input (an upper bound on what
    is shuffled: filters, pruning and partial aggregation only shrink it),
    at least two per core, so a reduce task's share does not grow with the
    input. ``max_shuffle_partitions`` is the caller's bound on it, for a
    driver that cannot track map x reduce blocks; none unless given. AQE then
    coalesces to ``advisoryPartitionSizeInBytes`` from measured sizes and
    splits skewed join partitions. The smallest coalesced partition is
    1/256 of the input per core, between 64 KiB and Spark's 1 MiB default:
    a small input's many small shuffles (per-block counts, per-workflow
    totals) then still spread over the cores, while large inputs keep the
    default.
    """
    shuffle = max(2 * cores, -(-data_bytes // SHUFFLE_TARGET_BYTES))
    if max_shuffle_partitions:
        shuffle = min(max_shuffle_partitions, shuffle)
    min_partition = min(MB, max(64 * 1024, data_bytes // (cores * 256)))
    return {
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min_partition),
        "spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    }


def size_partitions(spark: SparkSession, paths, cores: int | None = None,
                    max_shuffle_partitions: int | None = None) -> dict:
    """Apply ``partition_conf`` for the inputs under ``paths`` to the running session."""
    cores = cores or spark.sparkContext.defaultParallelism
    conf = partition_conf(input_bytes(spark, paths), cores, max_shuffle_partitions)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf
