"""Table schemas (one lower-case schema serves every reader and writer)."""

from pyspark.sql import types as T

REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("app_version", T.StringType()),
])

REVIEW_COLUMNS = [f.name for f in REVIEWS.fields]

APP_METADATA = T.StructType([
    T.StructField("app_version", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("developer", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ratings_count", T.LongType()),
    T.StructField("reviews_count", T.LongType()),
    T.StructField("installs", T.StringType()),
    T.StructField("real_installs", T.LongType()),
    T.StructField("is_free", T.BooleanType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("sale", T.BooleanType()),
    T.StructField("offers_iap", T.BooleanType()),
    T.StructField("iap_price_range", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
])

PIPELINE_MONITORING = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("task_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.IntegerType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("anomaly_flag", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# Landed store payload: one JSON record per fetched page.
RAW_REVIEW = T.StructType([
    T.StructField("reviewId", T.StringType()),
    T.StructField("userName", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("at", T.StringType()),
    T.StructField("appVersion", T.StringType()),
])

REVIEW_PAGE = T.StructType([
    T.StructField("page_no", T.LongType()),
    T.StructField("reviews", T.ArrayType(RAW_REVIEW)),
])

# Older single-file export layout.
REVIEWS_CSV = T.StructType([
    T.StructField("reviewId", T.StringType()),
    T.StructField("userName", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("thumbsUpCount", T.StringType()),
    T.StructField("reviewCreatedVersion", T.StringType()),
    T.StructField("at", T.StringType()),
    T.StructField("replyContent", T.StringType()),
    T.StructField("repliedAt", T.StringType()),
])

# Store metadata payload keys, as the store client returns them.
APP_METADATA_JSON = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("developer", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ratings", T.LongType()),
    T.StructField("reviews", T.LongType()),
    T.StructField("installs", T.StringType()),
    T.StructField("realInstalls", T.LongType()),
    T.StructField("free", T.BooleanType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("sale", T.BooleanType()),
    T.StructField("offersIAP", T.BooleanType()),
    T.StructField("inAppProductPrice", T.StringType()),
    T.StructField("url", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("valence", T.DoubleType(), False),
])

STOPWORDS = T.StructType([T.StructField("word", T.StringType(), False)])
