"""Input tables derived from the generated test tables.

The analyses read a ``reviews`` table, a pipeline run log and app metadata
snapshots.  For tests and the benchmark they are derived from the
TPC-H-style tables by plain column expressions (FIXTURES.md gives the same
derivation as SQL, used by the DuckDB oracle).  Every order, document,
event and part is read whole: the reviews that fall on one document carry
its text in consecutive slices.  Everything stays lazy and distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Fixed values of the derivation (see FIXTURES.md).
PHRASES = [
    "GREAT app, love it!!! very helpful http://x.example/a?b=1",
    "good app, really useful and easy to use",
    "the best and awesome helpful app",
    "bad experience, wrong answer and slow. www.example.org/x",
    "not good, the free version is terrible",
    "love the idea, but login problem and bad update",
]
GAP_MONTH_START = "1997-06-01 00:00:00"
GAP_MONTH_END = "1997-07-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    gap_lo = F.lit(GAP_MONTH_START).cast("timestamp_ntz")
    gap_hi = F.lit(GAP_MONTH_END).cast("timestamp_ntz")
    # An empty month for the calendar: its orders move to the month after.
    day = F.col("o_orderdate")
    o = o.withColumn("o_orderdate", F.when((day >= gap_lo) & (day < gap_hi), day + F.expr("INTERVAL 30 DAY")).otherwise(day))

    # Only what an order has is shuffled to the documents; the columns of a review are derived beside its slice.
    k = F.col("o_orderkey")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.length("text").alias("chars"))
    r = o.select(k.alias("k"), F.col("o_custkey").alias("cust"), F.col("o_orderdate").alias("ots"),
                 F.substring("o_orderpriority", 1, 1).alias("prio"), ((k % 89 != 0) & (k % 9 != 0)).cast("int").alias("has_text"))
    # The reviews of one document that have a text take its slices in key order.
    r = r.withColumn("doc_key", F.col("k") % docs.agg(F.max("doc_id") + 1).scalar())
    mates = Window.partitionBy("doc_key")
    r = (r.withColumn("slices", F.sum("has_text").over(mates))
          .withColumn("slice", F.sum("has_text").over(mates.orderBy("k")) - 1))
    j = r.join(docs, r.doc_key == docs.doc_id)

    kk, prio = F.col("k"), F.col("prio")
    phrase_idx = ((F.when(kk % 4 == 0, 3).otherwise(0)
                   + F.when(prio.isin("1", "2"), 0).otherwise(3)) % 6
                  + (kk % 3).cast("int"))
    phrase = F.when(phrase_idx == 0, PHRASES[0])
    for i in range(1, 5):
        phrase = phrase.when(phrase_idx == i, PHRASES[i])
    phrase = phrase.otherwise(PHRASES[5])
    begin = F.expr("(chars * slice) div slices")
    end = F.expr("(chars * (slice + 1)) div slices")
    content = (F.when(kk % 89 == 0, None)
                .when(kk % 9 == 0, F.lit("   "))
                .otherwise(F.concat(phrase, F.lit(" "),
                                    F.substring("text", (begin + 1).cast("int"), (end - begin).cast("int")))))
    version = (F.when(kk % 14 == 0, None)
                .when(kk % 211 == 0, F.lit("beta"))
                .otherwise(F.concat(F.when(kk % 5 == 0, F.lit("v1.")).otherwise(F.lit("1.")),
                                    F.year("ots").cast("string"), F.lit("."),
                                    F.month("ots").cast("string"))))
    return j.select(
        F.concat(F.lit("r"), F.when(kk < 10_000_000, F.lpad(kk.cast("string"), 8, "0")).otherwise(kk.cast("string"))).alias("review_id"),
        F.when(kk % 97 == 0, None)
         .when(kk % 3 == 0, F.concat(F.lit("user_"), F.col("cust").cast("string")))
         .otherwise(F.concat(F.lit("guest_"), kk.cast("string"))).alias("user_name"),
        content.alias("content"),
        F.when(kk % 101 == 0, None).otherwise(6 - prio.cast("int")).cast("int").alias("score"),
        F.when(kk % 103 == 0, None).otherwise(
            F.expr("timestampadd(SECOND, CAST((k * 7919) % 86400 AS INT), ots)")).alias("created_at"),
        version.alias("app_version"))


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log rows (anomaly_flag is computed by ``run_anomaly_flag``)."""
    e = table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return e.select(
        F.to_date("ts").alias("date"),
        "event_id",
        F.when(F.col("user_id") % 10 == 0, "review_sync").otherwise("review_update").alias("task_name"),
        F.when(err, "FAILURE").otherwise("SUCCESS").alias("status"),
        F.when(F.col("event_type").isin("error", "signup") & (F.col("event_id") % 20 == 0), 0)
         .otherwise(F.floor(F.col("value") * 10).cast("int")).cast("int").alias("rows_loaded"),
        F.when(err, F.expr("repeat(concat(props, ' '), CAST(1 + event_id % 150 AS INT))"))
         .alias("error_message"),
        F.col("value").alias("duration_sec"),
        F.col("ts").alias("timestamp"),
    )


def app_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    size = F.col("p_size")
    return p.select(
        F.concat(F.lit("1."), (1995 + key % 7).cast("string"), F.lit("."),
                 (1 + key % 12).cast("string")).alias("app_version"),
        F.col("p_name").alias("title"),
        F.when(key % 5 == 0, None).otherwise(F.col("p_brand")).alias("developer"),
        F.when(key % 7 == 0, None).otherwise(F.col("p_type")).alias("genre"),
        (size.cast("double") / 10).alias("score"),
        (key * 100).alias("ratings_count"),
        (key * 10).alias("reviews_count"),
        F.concat((key * 1000).cast("string"), F.lit("+")).alias("installs"),
        (key * 1234).alias("real_installs"),
        (size < 25).alias("is_free"),
        F.col("p_retailprice").alias("price"),
        F.lit("USD").alias("currency"),
        F.when(key % 3 == 0, None).otherwise(size > 40).alias("sale"),
        (size % 2 == 0).alias("offers_iap"),
        F.when(size % 2 == 0, F.lit("$0.99 - $9.99")).alias("iap_price_range"),
        F.when(key % 11 == 0, None).otherwise(
            F.concat(F.lit("https://store.example/"), key.cast("string"))).alias("url"),
    )


def _review_no(df: DataFrame):
    return F.substring("review_id", 2, 100).cast("bigint")


def merge_target(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    """Like the next two a selection of the reviews, stored ones if given: the texts are cut and written once for all."""
    r = reviews(spark, sf_dir) if r is None else r
    return r.filter(_review_no(r) % 10 != 0)


def merge_batch(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    """Half matches the target (ids % 10 = 5), half is new (ids % 10 = 0);
    every sixth row is dated after all rows of the target."""
    r = reviews(spark, sf_dir) if r is None else r
    k = _review_no(r)
    return r.filter(k % 5 == 0).select(
        "review_id", F.lit("renamed").alias("user_name"),
        F.concat(F.col("content"), F.lit(" (edited)")).alias("content"),
        F.when(F.col("score").isNull(), None).otherwise(6 - F.col("score")).cast("int").alias("score"),
        F.when(k % 30 == 0, F.col("created_at") + F.expr("INTERVAL 4000 DAY")).otherwise(F.col("created_at")).alias("created_at"),
        "app_version")


def raw_reviews(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    """String-typed store rows with some unparsable values and fractional
    seconds, for the lenient typing step."""
    r = reviews(spark, sf_dir) if r is None else r
    k = _review_no(r)
    fmt = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    return r.select(
        "review_id", "user_name", "content",
        F.when(k % 127 == 0, F.lit("n/a")).otherwise(F.col("score").cast("string")).alias("score"),
        F.when(k % 113 == 0, F.lit("not-a-date"))
         .when(k % 7 == 0, F.concat(fmt, F.lit(".5"))).otherwise(fmt).alias("created_at"),
        "app_version")


# ---------------------------------------------------------------- stored inputs
_STORED: dict[tuple, tuple] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build, bucket_by: str | None = None) -> DataFrame:
    """The derived input ``name`` as a stored table.

    In production the analyses read stored tables (reviews, run log,
    metadata history); for the generated test data the derivation is
    written once per session to the shared checkpoint folder and every
    query then scans that table, exactly as it would scan the real one.
    With ``bucket_by`` it is an external table bucketed on that key (the
    layout recommended for the reviews table, see sinks.save_bucketed_table).
    """
    import uuid

    from reviewlake.session import checkpoint_dir
    from reviewlake.sources.sinks import COMPRESSION, save_bucketed_table
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    ref = _STORED.get(key)
    if ref is None:
        tag = uuid.uuid4().hex[:10]
        path = f"{checkpoint_dir(spark).rstrip('/')}/inputs-{tag}/{name}"
        if bucket_by:
            ref = ("table", f"inputs_{tag}_{name}")
            save_bucketed_table(build(spark, sf_dir), ref[1], path, bucket_by)
        else:
            ref = ("path", path)
            build(spark, sf_dir).write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
        _STORED[key] = ref
    kind, where = ref
    return spark.table(where) if kind == "table" else spark.read.parquet(where)
