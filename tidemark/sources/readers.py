"""Readers (S1-S9). Every reader takes a declared schema: no inference job, and
bad records are kept apart instead of failing the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import TWEET_ANY, METRIC_FILE, PRICE_HISTORY


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread CPU-heavy row work over the cluster when the scan yields fewer
    partitions than there are cores (a non-splittable file: gz, or parquet
    with one row group). Large inputs already have more splits than cores and
    pass through without a shuffle. Round-robin repartitioning sorts first,
    so a retried task sees the same rows."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (Spark Connect): leave the layout to the server
        return df
    return df.repartition(target) if n < target else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             cols: Sequence[str] | None = None, multiline: bool = True) -> DataFrame:
    """Header CSV with a declared schema; quoted fields may hold
    newlines and doubled quotes. ``cols`` prunes columns at the reader."""
    df = (spark.read.schema(schema).option("header", True).option("multiLine", multiline)
          .option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    return df.select(*cols) if cols else df


def read_table(spark: SparkSession, path: str, cols: Sequence[str] | None = None,
               parse: dict | None = None) -> DataFrame:
    """S8 (+D3): a stored table with a projection; ``parse`` maps column ->
    timestamp format for text columns (unparseable -> null)."""
    df = spark.read.parquet(path)
    if cols:
        df = df.select(*cols)
    for c, fmt in (parse or {}).items():
        df = df.withColumn(c, F.try_to_timestamp(F.col(c), F.lit(fmt)))
    return df


# year, month and day in a path, as directories (2021/05/03) or in one name (2021-05-03)
DAY_IN_PATH = r"(\d{4})[-/_]?(\d{2})[-/_]?(\d{2})"


def day_of_path(path_col) -> Column:
    """The first date in a file's path, null where there is none."""
    part = [F.regexp_extract(path_col, DAY_IN_PATH, i) for i in (1, 2, 3)]
    return F.try_to_date(F.concat_ws("-", *part), "yyyy-MM-dd")


def read_tweets(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None,
                days: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """JSON-lines tweets of both layouts (compressed or not; bz2 splits,
    gz does not: where that leaves fewer partitions than cores, lines are spread
    over the cores before anything else is done with them).

    Returns ``(tweets, rejects)``: tweets = (tweet_id, author_id, created_at,
    text, source_file, day) for lines with an id (v2 ``data.id`` or v1 ``id``; a
    missing v1 ``user`` gives a null author); rejects = (line, source_file)
    for lines that are not JSON. ``day`` is the date in the file's path;
    ``days`` = (first, last) reads only files of those days: the filter is on
    file metadata, so other files are left out before they are opened."""
    r = (spark.read.schema(TWEET_ANY).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    raw = r.json(path)
    if days is not None:
        raw = raw.filter(day_of_path(F.col("_metadata.file_path")).between(*[F.lit(d).cast("date") for d in days]))
    raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
    # a corrupt-record column must be materialised before it is filtered on
    raw = raw.select("data", "id", "created_at", "text", "user", "_corrupt_record", "source_file")
    raw = spread(raw)
    bad = F.col("_corrupt_record").isNotNull()
    # a broken line has every data field null; testing one keeps the scan from
    # asking for the corrupt-record column alone (which Spark refuses)
    rejects = raw.filter(bad & F.col("id").isNull()).select(F.col("_corrupt_record").alias("line"),
                                                            "source_file")
    good = raw.filter(~bad).select(
        F.coalesce(F.col("data.id"), F.col("id")).alias("tweet_id"),
        F.coalesce(F.col("data.author_id"), F.col("user.id")).alias("author_id"),
        F.coalesce(F.col("data.created_at"), F.col("created_at")).alias("created_at"),
        F.coalesce(F.col("data.text"), F.col("text")).alias("text"),
        "source_file", day_of_path(F.col("source_file")).alias("day")).filter(F.col("tweet_id").isNotNull())
    return good, rejects


def read_metrics(spark: SparkSession, path: str, ts_format: str | None = None) -> DataFrame:
    """One two-column CSV (time, value) per metric and coin, laid out as
    ``.../token=<T>/metric=<m>/*.csv`` -> one long table (ts, token, metric,
    value). Token and metric come from the partition directories."""
    schema = T.StructType(METRIC_FILE.fields + [T.StructField("token", T.StringType()),
                                                T.StructField("metric", T.StringType())])
    df = spark.read.schema(schema).option("header", True).csv(path)
    ts = F.try_to_timestamp(F.col("t"), F.lit(ts_format)) if ts_format else F.try_to_timestamp(F.col("t"))
    return df.select(ts.alias("ts"), "token", "metric", "value")


def read_price_history(spark: SparkSession, path: str) -> DataFrame:
    """The prices of :func:`read_price_histories`."""
    return read_price_histories(spark, path)[0]


def read_price_histories(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """One nested JSON document per symbol ``{"Data": {"Data": [..]}}`` ->
    ``(prices, rejects)``: prices = (symbol, ts, volume, close), the symbol being the file
    name; rejects = (source_file, reason, n) for files that are not JSON ('not json'), hold no
    list of prices ('no data') or entries without a time ('no time', n of them). Files are read
    as one text each (a document is bounded: one symbol's history) and parsed in the plan."""
    schema = T.StructType([*PRICE_HISTORY.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"),
                                                       F.col("_metadata.file_name").alias("_f"), parsed.alias("j"))
    data = F.col("j.Data.Data")
    bad = F.col("j").isNull() | F.col("j._corrupt_record").isNotNull()
    entries = raw.where(~bad).select(F.regexp_extract("_f", r"^([^.]+)", 1).alias("symbol"), F.explode(data).alias("r"))
    prices = entries.where(F.col("r.time").isNotNull()).select(
        "symbol", F.timestamp_seconds("r.time").alias("ts"), F.col("r.volumeto").alias("volume"), F.col("r.close").alias("close"))
    untimed = F.size(F.filter(data, lambda r: r["time"].isNull())).cast("long")
    reason = F.when(bad, "not json").when(data.isNull(), "no data").when(untimed > 0, "no time")
    rejects = raw.select("source_file", reason.alias("reason"), F.when(reason == "no time", untimed).otherwise(F.lit(1)).cast("long").alias("n"))
    return prices, rejects.where(F.col("reason").isNotNull())
