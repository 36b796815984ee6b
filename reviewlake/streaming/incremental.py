"""Incremental ingest of landed review pages with Structured Streaming.

``readStream`` over the landing folder replaces the loader's page walk: the
file source's checkpoint remembers which page files were consumed; it lies
beside the target table, so that a restart goes on where the last run ended
and two targets never share it.  Each micro-batch is exploded, normalised,
typed, de-duplicated and merged into the buckets of the reviews table that
it touches.  Lines that are no page go to a quarantine folder.

A batch is applied exactly once, wherever a run is killed.  The new image of
its buckets and a note (the batch, its row and line counts) are written to
``_pending`` beside the table; a pending folder with its note is a decision,
one without is void.  Then the image overwrites the buckets, the note becomes
the stream's last applied batch, and ``_pending`` goes.  Every load first
finishes a decided one.  A batch that Spark replays after that, because the
run ended before its checkpoint was committed, is known by its number: it
changes neither rows nor quarantine and reports the counts of its note.

With ``since_mark`` only rows newer than the table's newest are loaded.  The
mark is taken once for a run and kept in ``_run`` until the run has ended
well, so all its batches, also those after a restart, use the same one.

``trigger(availableNow=True)`` processes everything landed so far and
stops - the monthly batch run; without it the same query runs continuously.
A table has one writer at a time.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlake import schemas
from reviewlake.operators.ingest import (bad_pages, coerce_types, explode_pages, high_water_mark, merge_reviews, newer_than,
                                         normalize_raw_reviews, parse_pages)
from reviewlake.plans.materialize import materialize
from reviewlake.sources import sinks

QUARANTINE, PENDING, APPLIED, RUN = "_quarantine", "_pending", "_applied", "_run"
NOTE = "stream string, batch long, rows_loaded long, bad_lines long, buckets int"


def _at(base: str, *names: str) -> str:
    return "/".join([base.rstrip("/"), *names])


def current(spark: SparkSession, base: str, buckets: list[int] | None = None) -> DataFrame:
    """The table's rows, or those of some buckets; no rows if there is no table yet."""
    rows = sinks.read_buckets(spark, base, buckets)
    return spark.createDataFrame([], schemas.REVIEWS) if rows is None else rows


def _written(spark: SparkSession, path: str) -> bool:
    """A one-file folder is there as soon as its part file is."""
    return any(n.startswith("part-") for n in sinks._children(spark, path))


def decide(spark: SparkSession, rows: DataFrame | None, base: str, stream: str | None = None, batch: int | None = None, n: int = 0, bad: int = 0,
           buckets: int | None = None) -> None:
    """Write what a load will do: the new image of the touched buckets, then the note that makes it a decision."""
    count = sinks.bucket_count(spark, base) or buckets or sinks.BUCKETS
    sinks.remove(spark, _at(base, PENDING))
    if rows is not None:
        # At most as many numbers as the table has buckets.
        touched = [r["b"] for r in rows.filter("review_id IS NOT NULL").select(sinks.bucket_of(count).alias("b")).distinct().collect()]
        image = merge_reviews(current(spark, base, touched), rows).withColumn(sinks.BUCKET, sinks.bucket_of(count))
        image.write.mode("overwrite").option("compression", sinks.COMPRESSION).parquet(_at(base, PENDING, "image"))
    note = spark.createDataFrame([(stream, batch, n, bad, count)], NOTE)
    note.coalesce(1).write.mode("overwrite").parquet(_at(base, PENDING, "note"))


def finish(spark: SparkSession, base: str) -> None:
    """Carry out a decided load, and drop one that was not decided; both may be done again."""
    if not sinks.path_exists(spark, _at(base, PENDING)):
        return
    if _written(spark, _at(base, PENDING, "note")):
        note = spark.read.schema(NOTE).parquet(_at(base, PENDING, "note"))
        row = note.first()
        if sinks.path_exists(spark, _at(base, PENDING, "image")):
            sinks.overwrite_buckets(spark.read.parquet(_at(base, PENDING, "image")), base, row["buckets"])
        if row["stream"] is not None:
            note.coalesce(1).write.mode("overwrite").parquet(_at(base, APPLIED, row["stream"]))
    sinks.remove(spark, _at(base, PENDING))


def merge_rows(rows: DataFrame, base: str, buckets: int | None = None) -> None:
    """Merge stored review rows into the buckets that they touch; ``buckets`` is the number for a new table."""
    spark = rows.sparkSession
    finish(spark, base)
    decide(spark, rows, base, buckets=buckets)
    finish(spark, base)


def quarantine(bad: DataFrame, base: str, load: str) -> int:
    """Keep the lines that are no page under the load's name, once however often it is done; returns their number."""
    if bad.isEmpty():
        return 0
    path = _at(base, QUARANTINE, f"load={load}")
    bad.write.mode("overwrite").text(path)
    return bad.sparkSession.read.text(path).count()


def quarantined(spark: SparkSession, target_base: str) -> DataFrame:
    """The landed lines that could not be read as pages."""
    path = _at(target_base, QUARANTINE)
    return spark.read.text(path).select("value") if sinks.path_exists(spark, path) else spark.createDataFrame([], "value string")


def run_mark(spark: SparkSession, base: str, now=None):
    """The high-water mark of the run that is under way: its own if it was interrupted, else the table's now."""
    if not _written(spark, _at(base, RUN)):
        mark = spark.range(1).select(high_water_mark(current(spark, base), now).alias("mark"))
        mark.coalesce(1).write.mode("overwrite").parquet(_at(base, RUN))
    return spark.read.parquet(_at(base, RUN)).first()["mark"]


def merge_pages_batch(batch: DataFrame, target_base: str, stream: str, number: int, mark=None, buckets: int | None = None) -> tuple[int, int]:
    """Merge micro-batch ``number`` of a stream of page lines; returns (rows loaded, lines that are no page).

    With ``mark`` only rows newer than it are loaded and counted, as the
    monthly loader does.  Nothing new: no merge.
    """
    spark = batch.sparkSession
    finish(spark, target_base)
    if _written(spark, _at(target_base, APPLIED, stream)):
        last = spark.read.schema(NOTE).parquet(_at(target_base, APPLIED, stream)).first()
        if last["batch"] == number:
            return last["rows_loaded"], last["bad_lines"]
    bad = quarantine(bad_pages(batch), target_base, f"{stream}-{number}")
    rows = coerce_types(normalize_raw_reviews(explode_pages(parse_pages(batch))))
    if mark is not None:
        rows = newer_than(rows, mark)
    rows = materialize(rows, "ingest-batch")  # read by the count, the buckets and both joins
    n = rows.count()
    decide(spark, rows if n else None, target_base, stream, number, n, bad, buckets)
    finish(spark, target_base)
    return n, bad


def incremental_ingest(spark: SparkSession, pages_dir: str, target_base: str,
                       checkpoint: str | None = None, available_now: bool = True,
                       max_files_per_trigger: int | None = None, since_mark: bool = False, now=None,
                       buckets: int | None = None, bad_lines: list[int] | None = None):
    """Start the ingest stream; with ``available_now`` it is awaited and the
    list of rows loaded per micro-batch is returned; the numbers of lines
    that are no page are added to ``bad_lines``."""
    finish(spark, target_base)
    ckpt = checkpoint or _at(target_base, "_ingest_checkpoint")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.text(pages_dir)
    mark = run_mark(spark, target_base, now) if since_mark else None
    loaded: list[int] = []
    started, stream = threading.Event(), []

    def on_batch(batch_df: DataFrame, number: int) -> None:
        started.wait()  # the stream's id, the same for all runs with one checkpoint
        n, bad = merge_pages_batch(batch_df, target_base, stream[0], number, mark, buckets)
        loaded.append(n)
        if bad_lines is not None:
            bad_lines.append(bad)

    writer = pages.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    stream.append(str(query.id))
    started.set()
    if available_now:
        query.awaitTermination()
        if since_mark:
            sinks.remove(spark, _at(target_base, RUN))
        return loaded
    return query
