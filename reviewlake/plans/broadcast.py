"""Broadcast only behind an explicit size check.

Lookup sides (lexicon, stop words, modifier tables) are small by nature but
are still inputs, so their size is verified before the broadcast hint.  The
check is a bounded action that reads at most ``max_rows + 1`` rows and adds
up their bytes.  Beyond the bound no hint is given and the
planner falls back to a shuffle join (AQE may still pick a broadcast at
runtime from real sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A lookup side above this many rows, or bytes of them as text, is joined by shuffle instead.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """At most ``max_rows`` rows with at most ``max_bytes`` bytes, all columns as text and eight more for each."""
    size = F.octet_length(F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns])) + 8 * len(df.columns)
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes")).first()
    return found["n"] <= max_rows and found["bytes"] <= max_bytes


def bounded_broadcast(df: DataFrame, name: str = "", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
