"""CSV records that may hold line breaks, read from every split of a large file at once.

A reader that keeps quoted line breaks together needs a file in one task.
Here the file is read as lines, split like any text, and the records are put
together afterwards:

1. Every split counts its quotes, in Spark's own partial sums.  Quotes inside
   a quoted value are doubled, so a place lies in a quoted value exactly if
   an odd number of quotes stands before it in the file.  A window over the
   splits (one row each) tells for each split whether it begins inside one.
2. With that, every line knows whether a record begins with it.  Records of
   one line, nearly all, go on where they were read.  Only the lines of
   records that hold line breaks are shuffled, by their record, and joined;
   lines at the head of a split belong to the last record of an earlier one.
3. Each record is parsed by ``from_csv``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

QUOTE = '"'
_SPLIT = ["file", "split"]


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, value): the lines with the file and split that they begin in; a carriage return stays with its line."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta.getField("file_path").alias("file"), meta.getField("file_block_start").alias("split"), "value")


def split_states(lines: DataFrame) -> DataFrame:
    """(file, split, inside): whether a split begins inside a quoted value; one row for each split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    per = lines.groupBy(*_SPLIT).agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*_SPLIT, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("inside"))


def _pieces(lines: DataFrame) -> DataFrame:
    """Lines with ``whole``, whether they are a record, and else with the number ``record`` of the line in
    their split that their record begins with, -1 for an earlier split, and their own number ``no``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, no, open_record = None, 0, 0, -1
        for batch in batches:
            files, splits = batch.column("file").to_pylist(), batch.column("split").to_numpy()
            cuts = [0, *(np.flatnonzero((splits[1:] != splits[:-1]) | np.array([a != b for a, b in zip(files[1:], files[:-1])], bool)) + 1).tolist(), len(splits)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if (files[low], splits[low]) != at:
                    at, state, no, open_record = (files[low], splits[low]), int(part.column("inside")[0].as_py()), 0, -1
                quotes = pc.count_substring(part.column("value"), QUOTE).to_numpy().astype(np.int64)
                end = (state + np.cumsum(quotes)) % 2
                begin = np.concatenate([[state], end[:-1]])
                number = no + np.arange(len(end))
                record = np.maximum.accumulate(np.where(begin == 0, number, open_record))
                whole = (begin == 0) & (end == 0)
                state, no, open_record = int(end[-1]), no + len(end), int(record[-1])
                yield pa.RecordBatch.from_arrays([part.column("file"), part.column("split"), part.column("value"), pa.array(whole), pa.array(record), pa.array(number)],
                                                 ["file", "split", "value", "whole", "record", "no"])

    return lines.mapInArrow(run, "file string, split long, value string, whole boolean, record long, no long")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, record, value): the records of the files under ``path``, with the place where each begins.

    A file may have many splits, and a split many tasks' worth of neither:
    tasks get what ``spark.sql.files.maxPartitionBytes`` allows.  Empty lines
    between records are none; a file that ends inside a quoted value has its
    rest as the last record.  Quotes stand around whole values and are
    doubled inside, as writers of the format do it.
    """
    lines = lines_of(spark, path)
    # One row for each split: the driver holds more than that for every split that it schedules.
    pieces = _pieces(lines.join(F.broadcast(split_states(lines)), _SPLIT))
    parts = pieces.filter("NOT whole")
    # The last record that begins in an earlier split of the file takes the lines at the head of a split.
    last = parts.groupBy(*_SPLIT).agg(F.max("record").alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    owner = last.select(*_SPLIT, F.last(F.when(F.col("last") >= 0, F.struct("split", F.col("last").alias("record"))), ignorenulls=True).over(before).alias("owner"))
    own = F.when(F.col("record") >= 0, F.struct("split", "record")).otherwise(F.col("owner"))
    # Lines of one record lie in few splits; their order is that of split and number.
    joined = (parts.join(owner, _SPLIT).withColumn("own", own).groupBy("file", "own")
              .agg(F.sort_array(F.collect_list(F.struct("split", "no", "value"))).alias("lines"))
              .select("file", "own.split", "own.record", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value")))
    whole = pieces.filter("whole").select("file", "split", "record", "value")
    # A carriage return at the end of a record belongs to the line break.
    return whole.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r$", "")).filter("value <> ''")


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True, **options: str) -> DataFrame:
    """The rows of CSV files with a declared schema, values by their place; ``header`` drops each file's first line."""
    rows = records(spark, path)
    if header:
        rows = rows.filter(~((F.col("split") == 0) & (F.col("record") == 0)))
    parsed = F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": QUOTE, **options})
    return rows.select(parsed.alias("r")).select("r.*")
