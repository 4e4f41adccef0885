"""Lake tables on Parquet folders: appends, snapshots, compaction, batch audit.

One writer per table is assumed; readers use the snapshot the audit names.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

ROWS_PER_FILE = 10_000_000


def table_exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return False
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def _folder(spark: SparkSession, path: str):
    """A path and the file system it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column by the names of its folders, ascending; no file is opened."""
    folder, system = _folder(spark, path)
    names = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{column}="))


def read_months(spark: SparkSession, path: str, column: str, first_days: Iterable[date]) -> DataFrame | None:
    """The rows of some months of a table partitioned by ``column``; None if it has none of them. No other folder is listed."""
    wanted = {d.isoformat() for d in first_days}
    held = [v for v in folder_values(spark, path, column) if v in wanted]
    if not held:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/{column}={v}" for v in held])


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def append_batch(df: DataFrame, path: str, batch_id: str, partition_by: Sequence[str] = ()) -> None:
    """Add one batch under its own ``_batch_id`` folder; writing the same batch again replaces it.

    Rows are grouped by ``partition_by`` first, so that a task does not write a small file into
    every partition.
    """
    rows = df.drop("_batch_id")
    if partition_by:
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{path}/_batch_id={batch_id}")


def rebuild_partitioned(df: DataFrame, path: str, by: Sequence[str], batch_id: str) -> str:
    """Write a whole table into a fresh snapshot folder, partitioned by ``by``; returns the folder.

    Old snapshots stay readable until the new one is complete and named by the audit. The
    rebalance hint groups rows by partition value but splits a value that holds too many
    rows over several tasks and files.
    """
    target = f"{path}/snapshot={batch_id}"
    (df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite")
       .option("partitionOverwriteMode", "static").option("maxRecordsPerFile", ROWS_PER_FILE)
       .partitionBy(*by).parquet(target))
    return target


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``; all others stay."""
    (df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", ROWS_PER_FILE)
       .partitionBy(*by).parquet(path))


def replace_model_partition(forecasts: DataFrame, path: str) -> None:
    """Replace the forecasts of the models in ``forecasts``; other models stay."""
    replace_partitions(forecasts, path, ["model_name"])


def compact(spark: SparkSession, source: str, target: str, cluster_by: Sequence[str],
            partition_by: Sequence[str] = ()) -> None:
    """Rewrite a table into fewer files, clustered by ``cluster_by``; content is unchanged."""
    order = [*partition_by, *cluster_by]
    writer = (spark.read.parquet(source).repartitionByRange(*order).sortWithinPartitions(*order)
              .write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def record_batch(spark: SparkSession, audit_path: str, table: str, batch_id: str, operation: str,
                 location: str, source_rows: int = 0, inserted: int = 0, updated: int = 0,
                 unchanged: int = 0) -> int:
    """Append one audit row and return its version (0, 1, ... per table)."""
    version = 0
    if table_exists(spark, audit_path):
        last = spark.read.parquet(audit_path).filter(F.col("table") == table).agg(F.max("version")).first()[0]
        version = 0 if last is None else last + 1
    row = spark.range(1).select(
        F.lit(table).alias("table"), F.lit(version).cast("bigint").alias("version"),
        F.lit(batch_id).alias("batch_id"), F.lit(operation).alias("operation"),
        F.lit(location).alias("location"), F.lit(source_rows).cast("bigint").alias("source_rows"),
        F.lit(inserted).cast("bigint").alias("inserted"), F.lit(updated).cast("bigint").alias("updated"),
        F.lit(unchanged).cast("bigint").alias("unchanged"), F.current_timestamp().alias("recorded_at"))
    row.coalesce(1).write.mode("append").parquet(audit_path)
    return version


def current_location(spark: SparkSession, audit_path: str, table: str) -> str | None:
    """Folder of the latest snapshot of ``table``."""
    if not table_exists(spark, audit_path):
        return None
    return (spark.read.parquet(audit_path).filter(F.col("table") == table)
            .agg(F.max_by("location", "version")).first()[0])


def batch_history(audit: DataFrame, operation: str | None = None, last: int = 12) -> DataFrame:
    """The last versions of each table, newest first in ``recency``, with the version before each.

    With ``operation`` only versions of that operation are listed; ``previous_version`` still
    counts every version of the table.
    """
    by_version = Window.partitionBy("table").orderBy("version")
    listed = audit.withColumn("previous_version", F.lag("version").over(by_version))
    if operation is not None:
        listed = listed.filter(F.col("operation") == operation)
    newest = Window.partitionBy("table").orderBy(F.desc("version"))
    return listed.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= last)


def version_before(audit: DataFrame, table: str, version: int) -> DataFrame:
    """One row: the highest version of ``table`` below ``version``, or null."""
    older = (F.col("table") == table) & (F.col("version") < version)
    return audit.filter(older).agg(F.max("version").alias("version"))


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """Files, bytes and rows per partition folder of a table."""
    files = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    per_file = files.groupBy("file").agg(F.first("bytes").alias("bytes"), F.count("*").alias("rows"))
    folder = F.regexp_extract("file", "((?:/[^/=]+=[^/]*)*)/[^/]+$", 1)
    return per_file.groupBy(F.ltrim(folder, F.lit("/")).alias("partition")).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def staged_replace(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace partitions of a table that ``df`` itself reads: write to the shared folder first."""
    spark = df.sparkSession
    staged = scratch_path(spark, "replace")
    df.write.parquet(staged)
    replace_partitions(spark.read.schema(df.schema).parquet(staged), path, by)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that changes with the content of a table, but not with its order or files.

    A row is hashed as the text of its columns in the order of their names, each behind its length, a null as ``-``; the two
    sums take 60 bits each of the MD5.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
    row = F.md5(F.concat_ws(",", *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))
    half = lambda start: F.sum(F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(38,0)")).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), half(1).alias("hash_low"), half(16).alias("hash_high"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Every stored file below ``path``: its place in the table, bytes and SHA-256. A task reads one file at a time."""
    folder, system = _folder(spark, path)
    root = system.makeQualified(folder).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    place = F.expr(f"substring(path, {len(root) + 2})")
    return files.select(place.alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def seal(spark: SparkSession, path: str, seals: str, batch_id: str) -> None:
    """Record the hashes of a table's files under a batch, to prove later that they are unchanged."""
    append_batch(file_hashes(spark, path), seals, batch_id)


def broken_seals(spark: SparkSession, path: str, seals: str, batch_id: str) -> DataFrame:
    """Files that changed, are missing or were added since the table was sealed; no rows prove it unchanged."""
    then = spark.read.parquet(f"{seals}/_batch_id={batch_id}").select("file", F.col("sha256").alias("sealed"))
    joined = file_hashes(spark, path).select("file", "sha256").join(then, "file", "full_outer")
    change = F.when(F.col("sealed").isNull(), "added").when(F.col("sha256").isNull(), "missing").when(F.col("sealed") != F.col("sha256"), "changed")
    return joined.select("file", change.alias("change")).filter("change is not null")
