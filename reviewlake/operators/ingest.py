"""Cleaning and incremental merge of landed reviews.

MERGE on plain Parquet has no row-level catalog, so the merge is written
as joins that produce the new table image (copy-on-write):

* target LEFT JOIN batch - every existing row, updated where the batch
  matches.  AQE broadcasts a batch of few bytes, so the big target is
  streamed once without any exchange;
* batch LEFT ANTI target - the new ids; only the target's key column is
  read and shuffled for it.

The result is stored first and then replaces the buckets that the batch
touches (streaming.incremental.merge_rows); a path is never overwritten
while it is being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reviewlake import schemas

UPDATE_COLUMNS = ("content", "score", "created_at", "app_version")


def normalize_raw_reviews(raw: DataFrame) -> DataFrame:
    """Store payload names -> table names; only the six table columns kept."""
    return raw.select(F.col("reviewId").alias("review_id"), F.col("userName").alias("user_name"),
                      F.col("content"), F.col("score"), F.col("at").alias("created_at"),
                      F.col("appVersion").alias("app_version"))


def coerce_types(df: DataFrame) -> DataFrame:
    """Lenient typing: unparsable timestamps and scores become null,
    timestamps are cut to whole seconds, scores truncated to int."""
    # Whole seconds of the wall clock itself: a way through the session's
    # zone would move times inside a daylight-saving gap.
    ts = F.col("created_at").cast("string").try_cast("timestamp_ntz")
    ts = F.substring_index(ts.cast("string"), ".", 1).try_cast("timestamp_ntz")
    score = F.col("score").cast("string").try_cast("double")
    score = F.when(score.isNull() | F.isnan(score), None).otherwise(score.try_cast("int"))
    return df.select(F.col("review_id").cast("string"), F.col("user_name").cast("string"),
                     F.col("content").cast("string"), score.alias("score"), ts.alias("created_at"),
                     F.col("app_version").cast("string"))


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per review from page records holding an array of reviews."""
    return pages.select(F.explode("reviews").alias("r")).select("r.*")


def _read_pages(json_lines: DataFrame, col: str) -> DataFrame:
    checked = T.StructType([*schemas.REVIEW_PAGE.fields, T.StructField("_bad", T.StringType())])
    page = F.from_json(F.col(col), checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    lines = json_lines.filter(F.trim(F.col(col)) != "").select(F.col(col), page.alias("p"))
    return lines.withColumn("_ok", F.coalesce(F.col("p._bad").isNull() & F.col("p.reviews").isNotNull(), F.lit(False)))


def parse_pages(json_lines: DataFrame, col: str = "value") -> DataFrame:
    """Page records from JSON text (one page per line); lines that are no page are left to ``bad_pages``."""
    return _read_pages(json_lines, col).filter("_ok").select("p.page_no", "p.reviews")


def bad_pages(json_lines: DataFrame, col: str = "value") -> DataFrame:
    """The lines that are no page record: malformed, cut short or without reviews; blank ones are none."""
    return _read_pages(json_lines, col).filter("NOT _ok").select(F.col(col).alias("value"))


def stage_reviews(batch: DataFrame) -> DataFrame:
    """The batch conformed to the target schema (column order and types)."""
    return batch.select(*schemas.REVIEW_COLUMNS).to(schemas.REVIEWS)


def high_water_mark(target: DataFrame, now=None, default_days: int = 30):
    """max(created_at) of the target as a scalar subquery, or now - 30 days
    when the target is empty."""
    now_col = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    fallback = now_col - F.expr(f"INTERVAL {int(default_days)} DAYS")
    return target.agg(F.coalesce(F.max("created_at"), fallback).alias("hwm")).scalar()


def new_reviews_since(batch: DataFrame, target: DataFrame, now=None, default_days: int = 30) -> DataFrame:
    """Batch rows strictly newer than the high-water mark (rows at or before
    it are dropped, as the loader's page filter does)."""
    return newer_than(batch, high_water_mark(target, now, default_days))


def newer_than(batch: DataFrame, mark) -> DataFrame:
    """Batch rows strictly newer than a mark (a column or a time)."""
    return batch.filter(F.col("created_at") > (mark if isinstance(mark, Column) else F.lit(mark).cast("timestamp_ntz")))


def dedupe_batch(batch: DataFrame) -> DataFrame:
    """One row per review_id (latest created_at, then content, user_name,
    app_version, score ascending as a stable tie-break; nulls last); null ids
    are quarantined.

    Written as ``min`` of an ordering struct that holds every column once,
    which combines map-side: many copies of one id cost one partial row per
    input partition, where a window over review_id would sort all copies in
    one task.
    """
    cols = schemas.REVIEW_COLUMNS
    latest_first = F.expr("timestampdiff(MICROSECOND, created_at, TIMESTAMP_NTZ'9999-12-31 23:59:59')")
    order = F.struct(
        F.col("created_at").isNull(), latest_first,
        F.col("content").isNull(), F.col("content"), F.col("user_name").isNull(), F.col("user_name"),
        F.col("app_version").isNull(), F.col("app_version"), F.col("score").isNull(), F.col("score"), F.col("created_at"))
    best = batch.filter(F.col("review_id").isNotNull()).groupBy("review_id").agg(F.min(order).alias("r"))
    return best.select(*[F.col(c) if c == "review_id" else F.col(f"r.{c}").alias(c) for c in cols])


def merge_reviews(target: DataFrame, batch: DataFrame, update=UPDATE_COLUMNS) -> DataFrame:
    """New table image of MERGE ON review_id: matched rows take ``update``
    columns from the batch (nulls included) and keep the rest, in particular
    user_name, from the target; unmatched batch rows are inserted whole."""
    cols = schemas.REVIEW_COLUMNS
    src = dedupe_batch(stage_reviews(batch))
    # No hint: AQE broadcasts the batch when its measured bytes allow it, else
    # the target is joined by shuffle and skewed partitions are split.
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in cols])
    t = target.select(*cols)
    kept = t.join(s, t["review_id"] == s["s_review_id"], "left")
    matched = F.col("s_review_id").isNotNull()
    updated = kept.select(*[
        (F.when(matched, F.col(f"s_{c}")).otherwise(F.col(c)) if c in update else F.col(c)).alias(c)
        for c in cols])
    inserted = src.join(t.select("review_id"), "review_id", "left_anti").select(*cols)
    return updated.unionByName(inserted)


def merge_report(target: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: batch rows, null ids quarantined, duplicates dropped,
    updated and inserted counts."""
    staged = stage_reviews(batch)
    clean = dedupe_batch(staged)
    matched = clean.join(target.select("review_id"), "review_id", "left_semi")
    clean_rows = clean.agg(F.count(F.lit(1))).scalar()
    updated = matched.agg(F.count(F.lit(1))).scalar()
    head = staged.agg(F.count(F.lit(1)).alias("batch_rows"),
                      F.count_if(F.col("review_id").isNull()).alias("null_ids"))
    return head.select(
        "batch_rows", "null_ids",
        (F.col("batch_rows") - F.col("null_ids") - clean_rows).alias("duplicates_dropped"),
        updated.alias("updated"), (clean_rows - updated).alias("inserted"))


def map_app_metadata(meta_json: DataFrame, fetched_at=None, col: str = "value",
                     default_developer: str | None = "unknown developer", default_genre: str | None = "Productivity",
                     default_url: str | None = "https://store.example/app", default_sale: bool = False) -> DataFrame:
    """Store metadata JSON -> app_metadata row.  Defaults apply to absent
    keys unless None is passed; Spark's JSON reader cannot tell absent from
    null, so both get the default."""
    m = meta_json.select(F.from_json(F.col(col), schemas.APP_METADATA_JSON).alias("m")).select("m.*")
    fetched = F.lit(fetched_at).cast("timestamp_ntz") if fetched_at is not None else \
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    dflt = lambda c, v: F.coalesce(F.col(c), F.lit(v)) if v is not None else F.col(c)
    return m.select(
        F.col("version").alias("app_version"), F.col("title"),
        dflt("developer", default_developer).alias("developer"),
        dflt("genre", default_genre).alias("genre"),
        F.col("score").cast("double").alias("score"), F.col("ratings").alias("ratings_count"),
        F.col("reviews").alias("reviews_count"), F.col("installs"),
        F.col("realInstalls").alias("real_installs"), F.col("free").alias("is_free"),
        F.col("price").cast("double").alias("price"), F.col("currency"),
        F.coalesce(F.col("sale"), F.lit(default_sale)).alias("sale"),
        F.col("offersIAP").alias("offers_iap"), F.col("inAppProductPrice").alias("iap_price_range"),
        dflt("url", default_url).alias("url"),
        fetched.alias("fetched_at"))


def metadata_to_json(app_metadata: DataFrame) -> DataFrame:
    """app_metadata rows serialised with the store's key names (nulls omitted)."""
    payload = F.struct(
        F.col("app_version").alias("version"), "title", "developer", "genre", "score",
        F.col("ratings_count").alias("ratings"), F.col("reviews_count").alias("reviews"), "installs",
        F.col("real_installs").alias("realInstalls"), F.col("is_free").alias("free"), "price", "currency",
        "sale", F.col("offers_iap").alias("offersIAP"),
        F.col("iap_price_range").alias("inAppProductPrice"), "url")
    return app_metadata.select(F.to_json(payload).alias("value"))


def reviews_to_pages(reviews: DataFrame, page_size: int = 200) -> DataFrame:
    """Landed page records (JSON text) from reviews: ``page_size`` reviews per
    page, keyed by the numeric part of review_id (each page is bounded);
    ids without one are spread over pages by hash."""
    no = F.coalesce(F.substring("review_id", 2, 100).try_cast("bigint"),
                    F.shiftrightunsigned(F.xxhash64("review_id"), 1))
    raw = F.struct(F.col("review_id").alias("reviewId"), F.col("user_name").alias("userName"),
                   "content", F.col("score").cast("string").alias("score"),
                   F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("at"),
                   F.col("app_version").alias("appVersion"))
    pages = reviews.withColumn("abs_no", no).groupBy(F.expr(f"abs_no div {int(page_size)}").alias("page_no")) \
                   .agg(F.collect_list(raw).alias("reviews"))
    return pages.select(F.to_json(F.struct("page_no", "reviews")).alias("value"))
