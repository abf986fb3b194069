"""Reading and writing tables: full scans, missing tables, refresh and append sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import conform


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _file_system(spark, path)
    return bool(fs.exists(location))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, location = _file_system(spark, path)
    return bool(fs.exists(location)) and bool(fs.getFileStatus(location).isDirectory())


def committed_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders whose write job finished."""
    fs, location = _file_system(spark, path)
    if not fs.exists(location):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [
        status.getPath().getName()
        for status in fs.listStatus(location)
        if status.isDirectory() and fs.exists(done(status.getPath(), "_SUCCESS"))
    ]


def remove_folders(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    """Delete sub-folders; their success marks go first, so no reader takes a half for a whole."""
    fs, _ = _file_system(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path
    for name in names:
        fs.delete(at(f"{path}/{name}/_SUCCESS"), False)
        fs.delete(at(f"{path}/{name}"), True)


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None when nothing is stored there.  Any other failure is raised."""
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None  # gone meanwhile, or a folder without any data file
        raise


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).csv(path, header=True)


def scan_source(df: DataFrame, source: str) -> DataFrame:
    """Rows of one source label; prunes partitions on a table partitioned by ``source``."""
    return df.where(F.col("source") == source)


def write_refresh(df: DataFrame, path: str, full: bool = False) -> None:
    """Replace the sources present in ``df``; with ``full`` replace the whole table.

    The offline table is laid out by source and batch.  A refresh writes batch 0 of its
    sources, so rows that a stream appends under its own source stay.
    """
    mode = "static" if full else "dynamic"
    (
        df.withColumn("batch_id", F.lit(0))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("source", "batch_id")
        .parquet(path)
    )


def write_append(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition).parquet(path)


def require_table(spark: SparkSession, path: str) -> None:
    """Sinks never create their target."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"target table does not exist: {path}")


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, partition: Sequence[str] = ()
) -> None:
    """An empty table with the sink's schema."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partition).parquet(path)


def day_partitioned(df: DataFrame, time: str) -> DataFrame:
    """Adds ``dt``, the UTC day of a timestamp column."""
    return df.withColumn("dt", F.to_date(F.col(time)))


def between_days(df: DataFrame, time: str, since: Column) -> DataFrame:
    """Rows after ``since``, with the matching partition predicate on ``dt``."""
    return df.where((F.col("dt") >= F.to_date(since)) & (F.col(time) > since))


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    schema: T.StructType,
    strict: bool = False,
    day_of: str | None = None,
    source: str | None = None,
) -> DataFrame:
    """Append one micro-batch to an existing table, exactly once, and return it as written.

    Rows live below ``batch_id=N`` (of ``source`` in the offline table, whose rows then all
    have that source); replaying a batch replaces that folder only.
    """
    require_table(df.sparkSession, path)
    shaped = conform(df, schema, strict=strict)
    partitions = []
    if day_of is not None:
        shaped = day_partitioned(shaped, day_of)
        partitions = ["dt"]
    if source is None:
        folder = f"{path}/batch_id={batch_id}"
    else:
        folder = f"{path}/source={source}/batch_id={batch_id}"
        shaped = shaped.drop("source")
    shaped.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partitions
    ).parquet(folder)
    written = df.sparkSession.read.schema(schema).option("basePath", path).parquet(folder)
    return written.select(*schema.fieldNames())


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches of a table written by ``write_batch``."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
