"""Shared helpers: table access, training splits, and tables in the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of one Arrow batch handed to Python: very long texts make short
# batches, so a worker's memory does not follow the longest texts.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound what Spark sends to Python at once, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local folder only where it is unset on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="reviewlake-llm-")
    spark.conf.set("spark.checkpoint.dir", f"file://{root}")
    return f"file://{root}"


class Scratch:
    """Intermediate Parquet tables of one operator call in the shared folder.

    A stored table cuts lineage and is read back after the loss of an
    executor.  ``drop`` removes a table that a later one replaces; what is
    left goes when the interpreter ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        atexit.register(self._remove, self.path)

    def _remove(self, path: str) -> None:
        try:
            hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # noqa: BLE001 - the session may be gone when the interpreter ends
            return

    def store(self, df: DataFrame, name: str, **options: int) -> DataFrame:
        """Write and read back; the shuffle files behind the table go at once, not when the driver collects garbage."""
        tidy, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", None
        try:
            before = self.spark.conf.get(tidy)
            self.spark.conf.set(tidy, "true")
            df.write.mode("overwrite").options(**options).parquet(f"{self.path}/{name}")
        finally:
            if before is not None:
                self.spark.conf.set(tidy, before)
        self.names.add(name)
        return self.spark.read.parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        self._remove(f"{self.path}/{name}")
        self.names.discard(name)

    def keep_only(self, *names: str) -> None:
        """Drop all tables but those that what is returned still reads."""
        for name in self.names.difference(names):
            self.drop(name)


def ranked(rows: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """``rows`` with ``rank`` long, gapless from 0 in the given order, and how many they are.

    The rows are range-partitioned and sorted once and stored with their
    partition and place in it; the partitions' counts (one row for each
    partition) turn the place into the rank.  No row passes a single task.
    """
    n = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tie = F.monotonically_increasing_id()  # equal rows may be cut apart between partitions
    placed = scratch.store(rows.withColumn("_tie", tie).repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
                           .withColumn("_at", F.monotonically_increasing_id()), "placed")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    starts = np.concatenate([[0], np.cumsum([c for _, c in counts])]).tolist()
    first = rows.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(counts, starts)], "_p long, _start long")
    return placed.join(F.broadcast(first), part == F.col("_p")).withColumn("rank", F.col("_start") + place).drop("_at", "_p", "_start"), int(starts[-1])


def held_out(doc_id, buckets: int, remainder: int):
    """crc32 of the id as text falls in the held-out remainder; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % buckets == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, y, text) of at most ``limit`` labelled documents, chosen by the hash of the id.

    ``labels`` has (doc_id, y); several labels of one id count as the
    largest, several texts as the greatest, so that repeated rows weigh
    once.  The chosen ids (16 bytes each) are few by ``limit``, which is
    what makes their broadcast safe.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "y").agg(F.max("text").alias("text")))


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def map_texts(docs: DataFrame, keep: list[str], start: Callable, fields: str, text: str = "text") -> DataFrame:
    """``keep`` columns of every row, unchanged, and the columns ``fields`` computed from its text.

    ``start()`` runs once in a task and returns a function from a list of
    texts (null: None) to one array or list for each field.  Other columns
    are not read.
    """
    bounded_batches(docs.sparkSession)
    names = [f.split()[0] for f in re.split(r",\s*(?![^<]*>)", fields)]  # commas within <...> belong to a type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for b in batches:
            if b.num_rows:
                made = fn(b.column(own).to_pylist())
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *(x if isinstance(x, pa.Array) else pa.array(x) for x in made)], [*keep, *names])
                del made
                pa.default_memory_pool().release_unused()

    own = text if text in keep else unused(docs, "_text")  # a text that is kept is sent once
    source = docs.select(*keep) if own == text else docs.select(*keep, F.col(text).alias(own))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keep]
    return source.mapInArrow(run, ", ".join([*kept, fields]))
