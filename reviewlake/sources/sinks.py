"""Table creation, appends and bucket-wise overwrites (Parquet).

Appends go through the DataFrame writer: tasks write in parallel and
``maxRecordsPerFile`` caps each file at the loader's batch size.  The
reviews table is partitioned by a hash bucket of review_id; a load replaces
the buckets that it touches by Spark's dynamic partition overwrite, and the
others keep their files.  The number of buckets is chosen when the table is
first written and kept in its schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from reviewlake import schemas

BATCH_SIZE = 200_000
BUCKET = "bucket"
COMPRESSION = "zstd"  # of stored texts: half the bytes of the default
BUCKETS = 64  # of a new table; a bucket should be a few files of some hundred MB


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def create_table(spark: SparkSession, path: str, schema: StructType) -> bool:
    """Create an empty Parquet table at ``path`` if absent; True if created."""
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return True


def create_reviews_table(spark: SparkSession, path: str) -> bool:
    return create_table(spark, path, schemas.REVIEWS)


def create_app_metadata_table(spark: SparkSession, path: str) -> bool:
    return create_table(spark, path, schemas.APP_METADATA)


def create_monitoring_table(spark: SparkSession, path: str) -> bool:
    return create_table(spark, path, schemas.PIPELINE_MONITORING)


def append_batches(df: DataFrame, path: str, max_records: int = BATCH_SIZE) -> None:
    """Append, at most ``max_records`` rows per file."""
    df.write.mode("append").option("maxRecordsPerFile", max_records).parquet(path)


def append_app_metadata(df: DataFrame, path: str) -> None:
    """Append snapshot rows (history; never updated)."""
    df.select(*[f.name for f in schemas.APP_METADATA.fields]).to(schemas.APP_METADATA) \
      .write.mode("append").parquet(path)


def append_run_log(df: DataFrame, path: str) -> None:
    df.select(*[f.name for f in schemas.PIPELINE_MONITORING.fields]).to(schemas.PIPELINE_MONITORING) \
      .write.mode("append").parquet(path)


def _children(spark: SparkSession, base: str) -> list[str]:
    fs, p, _ = _fs(spark, base)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def bucket_count(spark: SparkSession, base: str) -> int | None:
    """The number of buckets of the table under ``base``, a property in its schema; None if it has no buckets yet."""
    if not any(n.startswith(f"{BUCKET}=") for n in _children(spark, base)):
        return None
    return spark.read.parquet(base).schema["review_id"].metadata["buckets"]


def bucket_of(buckets: int, key: str = "review_id") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, base: str, some: list[int] | None = None) -> DataFrame | None:
    """The reviews under ``base``, or those of some buckets (the others' files are pruned); None without buckets."""
    if bucket_count(spark, base) is None:
        return None
    rows = spark.read.schema(schemas.REVIEWS).parquet(base)
    return (rows if some is None else rows.filter(F.col(BUCKET).isin(some))).select(*schemas.REVIEW_COLUMNS)


def overwrite_buckets(rows: DataFrame, base: str, buckets: int, max_records: int = BATCH_SIZE) -> None:
    """Replace the buckets that ``rows`` (with their column ``bucket``) have by those rows; all others keep their files.

    Spark's dynamic partition overwrite: the same rows written again give
    the same table.  Rebalanced by bucket, so that a bucket is a few files
    and a large one is split.
    """
    named = [F.col(c).alias(c, metadata={"buckets": buckets}) if c == "review_id" else F.col(c) for c in schemas.REVIEW_COLUMNS]
    (rows.select(*named, BUCKET).hint("rebalance", BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records).option("compression", COMPRESSION).partitionBy(BUCKET).parquet(base))


def write_reviews(df: DataFrame, base: str, buckets: int | None = None, max_records: int = BATCH_SIZE) -> None:
    """Write ``df`` as the whole rows of the buckets that it touches."""
    n = bucket_count(df.sparkSession, base) or buckets or BUCKETS
    overwrite_buckets(df.withColumn(BUCKET, bucket_of(n)), base, n, max_records)


def save_bucketed_table(df: DataFrame, name: str, path: str, key: str = "review_id",
                        buckets: int | None = None) -> DataFrame:
    """Store ``df`` as an external table bucketed and sorted by ``key``.

    Reads of a table bucketed by review_id carry that hash partitioning, so
    the per-review work (sentiment hits -> sum -> join back, the merge's
    key lookups) runs inside each bucket with no exchange of the table.
    ``buckets`` defaults to the session's shuffle partition count.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.bucketBy(n, key).sortBy(key).option("path", path).option("compression", COMPRESSION)
       .mode("errorifexists").saveAsTable(name))
    return spark.table(name)
