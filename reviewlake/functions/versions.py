"""Natural ordering of app version strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DIGIT_RUN = r"\d+"


def version_key(c) -> Column:
    """All digit runs as an integer array; a version without digits -> [0].

    Arrays order lexicographically in Spark, so ``orderBy(version_key)``
    gives 1.2 < 1.2.1 < 1.10.  Runs are cast to DECIMAL(38,0) with
    ``try_cast`` so very long runs never raise under ANSI mode.
    """
    col = F.col(c) if isinstance(c, str) else c
    runs = F.regexp_extract_all(col, F.lit(DIGIT_RUN), 0)
    nums = F.transform(runs, lambda x: x.try_cast("decimal(38,0)"))
    return F.when(col.isNull(), F.lit(None)).when(
        F.array_size(runs) == 0, F.array(F.lit(0).cast("decimal(38,0)"))
    ).otherwise(nums)
