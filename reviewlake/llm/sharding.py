"""Sharding along a Hilbert curve: runs of rows that are close in several metadata dimensions.

Each dimension is quantised at its own quantiles, the cells are numbered
along a Hilbert curve, rows are sorted by that number, and the order is cut
into runs of equal row counts.  A shard's files then cover a narrow range in
every dimension, so that readers can skip files on any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reviewlake.llm.common import Scratch, ranked

BITS = 6  # cells for each dimension: 2 to this power


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of rows of cell numbers, one column for each dimension.

    Gray-code transposition: from the highest bit down, a cell's lower bits
    are inverted or exchanged with the first dimension's.
    """
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for d in range(dims):
            inside = (x[d] & high) != 0
            swap = np.where(inside, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap if d else 0
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> bit) & 1)
    return out


def text_cells(rows: DataFrame, name: str, bits: int) -> Column:
    """The cell of the text column ``name`` between its quantiles over all rows, cut on whole strings; null stays null."""
    order, total = ranked(rows.where(F.col(name).isNotNull()).select(F.col(name).alias("s")), ["s"], Scratch(rows.sparkSession, "cuts"))
    at = sorted({k * total // (1 << bits) for k in range(1, 1 << bits)})
    cuts = sorted({r["s"] for r in order.where(F.col("rank").isin(at)).select("s").collect()}, key=lambda x: x.encode())
    below = F.array(*[F.lit(c) for c in cuts]).cast("array<string>")
    return F.when(F.col(name).isNotNull(), F.size(F.filter(below, lambda c: c < F.col(name))).cast("long"))


def id_cells(docs: DataFrame, bits: int) -> Column:
    """What stands for the id among the dimensions: a number itself, a string its cell."""
    return text_cells(docs, "doc_id", bits) if isinstance(docs.schema["doc_id"].dataType, StringType) else F.col("doc_id")


def curve(rows: DataFrame, dims: list[str], bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve`` long: the Hilbert index of the numeric columns ``dims``.

    Cells are cut at approximate quantiles over all rows, so that a frequent
    value fills its own cells; null is the first cell.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(d, shares, 1000).alias(d) for d in dims]).first()
    bounds = [np.unique(np.array(cuts[d] or [], np.float64)) for d in dims]

    @F.pandas_udf("long")
    def index(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            cells = [np.where(c.isna(), 0, np.searchsorted(b, c.fillna(0).to_numpy(np.float64))) for c, b in zip(columns, bounds)]
            yield pd.Series(hilbert_index(np.stack(cells, 1), bits))

    return rows.withColumn("curve", index(*[F.col(d).cast("double") for d in dims]))


def shards(docs: DataFrame, count: int = 8, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, by the law ``rows``.

    Dimensions: source, language, size and id.  Ties on the curve are
    ordered by the text's crc32, then doc_id, so that equal texts of a cell
    are neighbours.  Shard s holds the ranks from s*n/count up to
    (s+1)*n/count, rounded down: counts differ by one at most.  A null text
    has size 1 and crc32 0; an empty table gives no row.  Ids that are
    strings get their cells like source and language.  Only doc_id, text,
    lang and source are read; no text is moved.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        text_cells(docs, "source", bits).alias("source"), text_cells(docs, "lang", bits).alias("lang"), id_cells(docs, bits).alias("number"))
    placed, total = ranked(curve(rows, ["source", "lang", "size", "number"], bits).drop("source", "lang", "number"),
                           ["curve", "text_crc32", "doc_id", "size"], Scratch(docs.sparkSession, "shards"))
    starts = F.array(*[F.lit(s * total // count).cast("long") for s in range(count)])
    # The last shard that starts at or before the rank; empty shards start where the next one does.
    shard = F.size(F.filter(starts, lambda s: s <= F.col("rank"))) - 1
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") - F.element_at(starts, F.col("shard") + 1)).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write(docs: DataFrame, path: str, count: int = 8, bits: int = BITS) -> None:
    """All columns of ``docs`` as Parquet in curve order, in about ``count`` files of neighbouring rows."""
    rows = docs.withColumn("_size", F.octet_length(F.coalesce("text", F.lit("")))).withColumn("_source", text_cells(docs, "source", bits)) \
        .withColumn("_lang", text_cells(docs, "lang", bits)).withColumn("_number", id_cells(docs, bits))
    curved = curve(rows, ["_source", "_lang", "_size", "_number"], bits)
    curved.repartitionByRange(count, "curve", "doc_id", F.xxhash64("text")).sortWithinPartitions("curve", "doc_id").drop("_size", "_source", "_lang", "_number", "curve") \
        .write.mode("overwrite").parquet(path)
