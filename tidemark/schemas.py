"""Declared schemas of the landed files (no inference on the hot path)."""

from pyspark.sql import types as T

TWEET_V2 = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("id", T.StringType()), T.StructField("author_id", T.StringType()),
        T.StructField("created_at", T.StringType()), T.StructField("text", T.StringType())])),
])
TWEET_V1 = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("user", T.StructType([T.StructField("id", T.StringType())])),
])
# both layouts in one reader schema: the v2 fields nest under data, v1 are top level
TWEET_ANY = T.StructType(TWEET_V2.fields + TWEET_V1.fields + [
    T.StructField("_corrupt_record", T.StringType())])

COMMENTS_RAW = T.StructType([
    T.StructField("submission_id", T.StringType()), T.StructField("subreddit", T.StringType()),
    T.StructField("comment_id", T.StringType()), T.StructField("comment_body", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("created_datetime", T.StringType()),
    T.StructField("score", T.LongType()), T.StructField("distinguished", T.StringType()),
    T.StructField("total_awards", T.LongType()),
])
SUBMISSIONS_RAW = T.StructType([
    T.StructField("submission_id", T.StringType()), T.StructField("subreddit", T.StringType()),
    T.StructField("submission_title", T.StringType()), T.StructField("submission_text", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("created_datetime", T.StringType()),
    T.StructField("score", T.LongType()), T.StructField("total_awards_received", T.LongType()),
])
METRIC_FILE = T.StructType([T.StructField("t", T.StringType()), T.StructField("value", T.DoubleType())])
PRICE_HISTORY = T.StructType([T.StructField("Data", T.StructType([
    T.StructField("Data", T.ArrayType(T.StructType([
        T.StructField("time", T.LongType()), T.StructField("volumeto", T.DoubleType()),
        T.StructField("close", T.DoubleType())])))]))])
PREDICTIONS = T.StructType([
    T.StructField("token", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("model", T.StringType()), T.StructField("prediction", T.DoubleType()),
    T.StructField("actual", T.DoubleType()),
])
