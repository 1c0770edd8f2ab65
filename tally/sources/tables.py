"""TPC-H table catalog: declared schemas, Parquet scans, ``.tbl`` ingest.

Covers sources S1-S5: scan a table by name under a root (local path, HDFS or
an object store), configure object-store access, ingest dbgen ``|``-separated
text into Parquet, and expose tables as temp views for SQL text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)

# The TPC-H DDL (column name, type, CHAR width or None).
# All columns are NOT NULL except n_comment and r_comment.
_DDL = {
    "nation": [
        ("n_nationkey", T.IntegerType(), None),
        ("n_name", T.StringType(), 25),
        ("n_regionkey", T.IntegerType(), None),
        ("n_comment", T.StringType(), None),
    ],
    "region": [
        ("r_regionkey", T.IntegerType(), None),
        ("r_name", T.StringType(), 25),
        ("r_comment", T.StringType(), None),
    ],
    "part": [
        ("p_partkey", T.IntegerType(), None),
        ("p_name", T.StringType(), None),
        ("p_mfgr", T.StringType(), 25),
        ("p_brand", T.StringType(), 10),
        ("p_type", T.StringType(), None),
        ("p_size", T.IntegerType(), None),
        ("p_container", T.StringType(), 10),
        ("p_retailprice", MONEY, None),
        ("p_comment", T.StringType(), None),
    ],
    "supplier": [
        ("s_suppkey", T.IntegerType(), None),
        ("s_name", T.StringType(), 25),
        ("s_address", T.StringType(), None),
        ("s_nationkey", T.IntegerType(), None),
        ("s_phone", T.StringType(), 15),
        ("s_acctbal", MONEY, None),
        ("s_comment", T.StringType(), None),
    ],
    "partsupp": [
        ("ps_partkey", T.IntegerType(), None),
        ("ps_suppkey", T.IntegerType(), None),
        ("ps_availqty", T.IntegerType(), None),
        ("ps_supplycost", MONEY, None),
        ("ps_comment", T.StringType(), None),
    ],
    "customer": [
        ("c_custkey", T.IntegerType(), None),
        ("c_name", T.StringType(), None),
        ("c_address", T.StringType(), None),
        ("c_nationkey", T.IntegerType(), None),
        ("c_phone", T.StringType(), 15),
        ("c_acctbal", MONEY, None),
        ("c_mktsegment", T.StringType(), 10),
        ("c_comment", T.StringType(), None),
    ],
    "orders": [
        ("o_orderkey", T.IntegerType(), None),
        ("o_custkey", T.IntegerType(), None),
        ("o_orderstatus", T.StringType(), 1),
        ("o_totalprice", MONEY, None),
        ("o_orderdate", T.DateType(), None),
        ("o_orderpriority", T.StringType(), 15),
        ("o_clerk", T.StringType(), 15),
        ("o_shippriority", T.IntegerType(), None),
        ("o_comment", T.StringType(), None),
    ],
    "lineitem": [
        ("l_orderkey", T.IntegerType(), None),
        ("l_partkey", T.IntegerType(), None),
        ("l_suppkey", T.IntegerType(), None),
        ("l_linenumber", T.IntegerType(), None),
        ("l_quantity", MONEY, None),
        ("l_extendedprice", MONEY, None),
        ("l_discount", MONEY, None),
        ("l_tax", MONEY, None),
        ("l_returnflag", T.StringType(), 1),
        ("l_linestatus", T.StringType(), 1),
        ("l_shipdate", T.DateType(), None),
        ("l_commitdate", T.DateType(), None),
        ("l_receiptdate", T.DateType(), None),
        ("l_shipinstruct", T.StringType(), 25),
        ("l_shipmode", T.StringType(), 10),
        ("l_comment", T.StringType(), None),
    ],
}
_NULLABLE = {"n_comment", "r_comment"}

TPCH_TABLES = tuple(_DDL)


def schema(table: str) -> T.StructType:
    """Declared StructType of a TPC-H table."""
    return T.StructType(
        [T.StructField(name, dtype, nullable=name in _NULLABLE) for name, dtype, _ in _DDL[table]]
    )


def char_columns(table: str) -> list[str]:
    """Columns declared CHAR(n): trimmed at ingest so padded == unpadded."""
    return [name for name, _, width in _DDL[table] if width is not None]


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet scan of one table under ``root`` (schema from the file footer).

    The folder is listed anew each time, so files appended anywhere below it are read.
    """
    return spark.read.parquet(table_path(root, name))


def configure_object_store(
    spark: SparkSession,
    access_key: str | None = None,
    secret_key: str | None = None,
    endpoint: str | None = None,
    region: str | None = None,
    path_style: bool | None = None,
) -> None:
    """Object-store (s3a) credentials and endpoint as session settings.

    Values left as None are not touched, so credentials supplied by the
    cluster (instance profile, defaults file) keep working.
    """
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    settings = {
        "fs.s3a.access.key": access_key,
        "fs.s3a.secret.key": secret_key,
        "fs.s3a.endpoint": endpoint,
        "fs.s3a.endpoint.region": region,
        "fs.s3a.path.style.access": None if path_style is None else str(path_style).lower(),
    }
    for key, value in settings.items():
        if value is not None:
            hconf.set(key, value)


BAD_LINE = "_bad_line"


def read_tbl(spark: SparkSession, path: str, table: str, keep_bad: bool = False) -> DataFrame:
    """S3: read dbgen ``|``-separated text with the declared schema.

    dbgen ends every line with a separator, which the CSV reader sees as one
    extra empty column; it is declared and dropped. CHAR columns are trimmed.
    A line that doesn't fit the schema ends the read, or, with ``keep_bad``,
    is a row with the text of the line in ``_bad_line`` and its file and split in ``_file, _split``.
    """
    declared = schema(table)
    fields = [T.StructField(f.name, f.dataType, True) for f in declared.fields] + [T.StructField("_trailing", T.StringType(), True)]
    if keep_bad:
        fields.append(T.StructField(BAD_LINE, T.StringType(), True))
    lines = (
        spark.read.schema(T.StructType(fields))
        .option("sep", "|")
        .option("header", "false")
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "PERMISSIVE" if keep_bad else "FAILFAST")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        # A line is judged as a whole, whichever columns are read.
        .option("columnPruning", str(not keep_bad).lower())
        .csv(path)
    )
    if keep_bad:
        lines = lines.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"))
    df = lines.drop("_trailing")
    trims = {c: F.trim(F.col(c)) for c in char_columns(table)}
    return df.withColumns(trims) if trims else df


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in schema(table).fields if not f.nullable]


class TooManyRejects(Exception):
    """More lines of a text load were bad than its limit allows; nothing was loaded."""


def ingest_tbl(spark: SparkSession, src: str, dest_root: str, table: str, max_rejects: int = 0) -> str:
    """S3 + K1: land a ``.tbl`` file set as ``<dest_root>/<table>.parquet``.

    Bad lines - a wrong number of fields, a value that isn't of its type, an
    empty field in a NOT NULL column - go to ``<dest_root>/<table>-rejects.parquet``
    (``file, split, reason, line``) and all others are loaded. With more than
    ``max_rejects`` of them the rejects are there to look at, the table isn't written.
    """
    out, aside = table_path(dest_root, table), table_path(dest_root, f"{table}-rejects")
    lines = read_tbl(spark, src, table, keep_bad=True)
    declared = [f.name for f in schema(table).fields]
    empty = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in not_null_columns(table)])), ", ")
    told = lines.withColumn("_reason", F.when(F.col(BAD_LINE).isNotNull(), "line doesn't fit the schema")
                            .when(empty != "", F.concat(F.lit("null in "), empty)))
    text = F.coalesce(F.col(BAD_LINE), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in declared], F.lit("")))
    (told.where(F.col("_reason").isNotNull())
     .select(F.col("_file").alias("file"), F.col("_split").alias("split"), F.col("_reason").alias("reason"), text.alias("line"))
     .write.mode("overwrite").parquet(aside))
    rejects = spark.read.parquet(aside).count()
    if rejects > max_rejects:
        raise TooManyRejects(f"{rejects} lines of {src}, limit {max_rejects}; see {aside}")
    told.where(F.col("_reason").isNull()).select(declared).write.mode("overwrite").parquet(out)
    return out


class LoadRefused(Exception):
    """A load broke a declared constraint; the table is as it was."""


def checked_load(df: DataFrame, root: str, table: str, load_id: str, key: list[str] | None = None) -> dict:
    """Add ``df`` to the table below ``root`` as the load ``load_id``, once and only if it keeps the declarations.

    Columns go by name: a declared one that ``df`` lacks is refused, others are
    left out. Rows, and nulls of each NOT NULL column, are counted by
    ``Dataset.observe`` in the pass that writes the load aside; then the load's
    keys are checked against themselves and against the table. Only a load that
    passes is renamed to ``<table>.parquet/load_id=<id>/``, so readers see all
    of it or nothing; a load whose folder is there isn't done again. Returns its counts (``rows`` is 0 for a load that was there).
    """
    spark = df.sparkSession
    declared = schema(table)
    missing = [f.name for f in declared.fields if f.name not in df.columns]
    if missing:
        raise LoadRefused(f"{table}: no column {', '.join(missing)}")
    path = table_path(root, table)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/load_id={load_id}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        return {"rows": 0}
    staged = f"{root.rstrip('/')}/_staged/{table}-{uuid.uuid4().hex}"
    seen = Observation()
    checks = [F.count(F.lit(1)).alias("rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in not_null_columns(table)]]
    rows = df.select([F.col(f.name).cast(f.dataType) for f in declared.fields])
    rows.observe(seen, *checks).write.parquet(staged)
    counts = dict(seen.get)
    nulls = {c: n for c, n in counts.items() if c != "rows" and n}
    if nulls:
        raise LoadRefused(f"{table}: nulls in {nulls}; the load is in {staged}")
    if key:
        new = spark.read.schema(declared).parquet(staged).select(key)
        twice = new.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
        if twice is None and fs.exists(target.getParent()):
            twice = new.join(spark.read.schema(declared).parquet(path).select(key), key, "left_semi").first()
        if twice is not None:
            raise LoadRefused(f"{table}: a key more than once, such as {twice}; the load is in {staged}")
    fs.mkdirs(target.getParent())
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), target):
        raise LoadRefused(f"{table}: {load_id} can't be put in its place")
    return {"rows": counts["rows"]}


def register_views(spark: SparkSession, root: str, names=TPCH_TABLES) -> dict[str, DataFrame]:
    """Expose each existing table under ``root`` as a temp view for SQL text."""
    frames = {}
    for name in names:
        try:
            df = read_table(spark, root, name)
        except Exception as exc:  # table not present under this root
            if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
                continue
            raise
        df.createOrReplaceTempView(name)
        frames[name] = df
    return frames


def load_into_table(df: DataFrame, table: str, mode: str = "append") -> None:
    """S5 (persisted form): ``INSERT INTO table SELECT * FROM scan``, columns by name.

    A rerun appends again; ``checked_load`` doesn't.
    """
    columns = df.sparkSession.table(table).columns
    df.select([F.col(c) for c in columns]).write.mode(mode).insertInto(table)
