"""Cut lineage by writing a table to the shared checkpoint folder.

``Dataset.checkpoint()`` computes its input twice unless the RDD is also
cached; an explicit Parquet write computes it once, survives executor loss
(the files live in the shared folder named by ``spark.checkpoint.dir``) and
gives the next stages a plain columnar scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from reviewlake.session import checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
