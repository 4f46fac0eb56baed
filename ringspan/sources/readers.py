"""Readers for CSV, JSON lines, line files, file trees, tables and literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Literal rows up to which they are broadcast to what they are joined with.
BROADCAST_ROWS = 10_000

# The declared call-record schema. Numbers are text, so leading zeros survive.
CALL_SCHEMA = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("organization_id", T.StringType()),
        T.StructField("from_number", T.StringType()),
        T.StructField("to_number", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("duration_seconds", T.IntegerType()),
        T.StructField("data_center", T.StringType()),
        T.StructField("carrier_id", T.IntegerType()),
        T.StructField("packet_loss", T.DoubleType()),
        T.StructField("mos", T.DoubleType()),
        T.StructField("jitter", T.DoubleType()),
    ]
)


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, corrupt_col: str | None = None
) -> DataFrame:
    """CSV files with a header. Without a schema types are inferred, at the cost of one more scan.

    A schema is matched by header name, whatever the order; columns it does not name are not read, and a named
    column that the header lacks is a ValueError. Files whose header differs from the first one's end the job.
    With ``corrupt_col`` rows that do not fit the schema keep their raw text there.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    declared = {f.name: f for f in schema.fields}
    header = reader.csv(path).columns
    missing = [n for n in declared if n not in header]
    if missing and header:
        raise ValueError(f"the header of {path} has no column {missing}")
    in_order = [declared.get(n, T.StructField(n, T.StringType())) for n in header or declared]
    if corrupt_col:
        in_order.append(T.StructField(corrupt_col, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    found = reader.option("enforceSchema", not header).schema(T.StructType(in_order)).csv(path)
    return found.select(*[f"`{n}`" for n in [*declared, *([corrupt_col] if corrupt_col else [])]])


def scan_external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Register the CSV files below ``path`` as table ``name`` unless it exists, and read it."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(
            name, path=path, source="csv", schema=schema, header="true",
            **({} if schema is not None else {"inferSchema": "true"}),
        )
    return spark.table(name)


def scan_project(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """Only the named columns of a parquet table; the scan reads nothing else."""
    return spark.read.parquet(path).select(*cols)


def spread(df: DataFrame) -> DataFrame:
    """Deals the rows of a scan with fewer splits than cores out to all of them, before heavy row-wise work.

    A file of one row group is read by one task however many are free. Scans with enough splits, as
    of any large table, stay as they are. Meant for plain scans: asking for the splits plans the frame.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_text_corpus(
    spark: SparkSession, path: str, sep: str = "\t", names: Sequence[str] = ("id", "text")
) -> DataFrame:
    """Line files with one record per line, fields parted by ``sep``; the last field keeps the rest."""
    parts = F.split(F.col("value"), _literal_pattern(sep), len(names))
    fields = spark.read.text(path).select(parts.alias("p"))
    return fields.select(*[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(names)])


def _literal_pattern(text: str) -> str:
    return r"\Q" + text + r"\E"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path`` as (path, size), by the file system's own recursive listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(root).toUri().getPath().rstrip("/") + "/"
    found, files = [], system.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toUri().getPath().removeprefix(base), status.getLen()))
    return spark.createDataFrame(found, "path string, size long")


def scan_file_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``, empty ones too, as (path, size, is_text, text).

    Content that holds a NUL byte or is not UTF-8 is not text and has NULL there; an empty file is an empty text.
    Files are read whole: one that Spark cannot hold in a row ends the job and names its path.
    """
    base = path.rstrip("/").removeprefix("file:")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    is_text = text.isNotNull() & (F.instr(text, "\x00") == 0)
    relative = F.regexp_replace(F.col("path"), "^[a-z]+:/*" + _literal_pattern(base.lstrip("/")) + "/", "")
    read = files.select(
        relative.alias("path"), F.col("length").alias("size"), F.coalesce(is_text, F.lit(False)).alias("is_text"),
        F.when(is_text, text).alias("text"),
    )
    # Spark's reader leaves out empty files; they come from the listing.
    empty = list_files(spark, path).filter("size = 0").select("path", "size", F.lit(True).alias("is_text"), F.lit("").alias("text"))
    return read.unionByName(empty)


def generate_rows(spark: SparkSession, n: int, **column_exprs: Column) -> DataFrame:
    """Rows 1..n as ``pos`` with further columns computed from it, in one projection."""
    rows = spark.range(1, n + 1).withColumnRenamed("id", "pos")
    return rows.select("pos", *[expr.alias(name) for name, expr in column_exprs.items()])


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: ordinal position, name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "ordinal_position int, column_name string, data_type string")


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """Literal rows. Few of them are marked as the side to broadcast: Spark does not know their size, and would rather
    broadcast a table it does know."""
    rows = list(rows)
    found = spark.createDataFrame(rows, schema)
    return F.broadcast(found) if len(rows) <= BROADCAST_ROWS else found
