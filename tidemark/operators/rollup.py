"""Label rollups (A1-A4, R2): counts of -1/1 labels per (time, token).

All are grouped aggregates with an explicit pivot list: Spark runs a partial
(map-side) aggregate before the shuffle, so a hot token costs one row per task
and key, and no extra job is needed to discover pivot values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.conditional import percentage


def explode_tokens(df: DataFrame, tokens: str = "tokens", out: str = "token") -> DataFrame:
    """R2: one row per token of the list; rows with an empty or null list vanish."""
    return df.withColumn(out, F.explode(F.col(tokens))).drop(tokens) if out != tokens else \
        df.withColumn(out, F.explode(F.col(tokens)))


def label_pivot(df: DataFrame, ts: str = "ts", key: str = "token", label: str = "label",
                neg=-1, pos=1, count_col: str | None = None) -> DataFrame:
    """A1 + A2: rows with a null key, time or label are not counted; one row per
    (ts, key) with ``count_negative``, ``count_positive``, ``count_total``.
    A missing label value gives a 0 column, never a missing column. With
    ``count_col`` the input is already counted (rows carry a count)."""
    counted = df.filter(F.col(ts).isNotNull() & F.col(key).isNotNull()
                        & F.col(label).isin(neg, pos))
    w = F.col(count_col).cast("long") if count_col else F.lit(1).cast("long")
    out = (counted.groupBy(ts, key)
           .agg(F.sum(F.when(F.col(label) == neg, w).otherwise(F.lit(0).cast("long"))).alias("count_negative"),
                F.sum(F.when(F.col(label) == pos, w).otherwise(F.lit(0).cast("long"))).alias("count_positive")))
    return out.withColumn("count_total", F.col("count_negative") + F.col("count_positive"))


def sentiment_hourly(df: DataFrame, ts: str = "ts", key: str = "token",
                     label: str = "label", count_col: str | None = None) -> DataFrame:
    """A3: A1 + A2 + share of positive labels (percent), token upper-cased."""
    out = label_pivot(df.withColumn(key, F.upper(F.col(key))), ts, key, label, count_col=count_col)
    return out.withColumn("percentage_positive", percentage("count_positive", "count_total"))


def sentiment_daily(df: DataFrame, ts: str = "ts", key: str = "token",
                    label: str = "label", out_date: str = "date",
                    count_col: str | None = None) -> DataFrame:
    """A4: per (day, TOKEN): ``count_positive``, ``count_negative``,
    ``total_count`` and ``percentage_positive``. Labels other than -1/1 (e.g.
    unknown) are not counted."""
    d = df.withColumn(out_date, F.to_date(F.col(ts))).withColumn(key, F.upper(F.col(key)))
    out = label_pivot(d, out_date, key, label, count_col=count_col).withColumnRenamed("count_total", "total_count")
    return out.withColumn("percentage_positive", percentage("count_positive", "total_count"))
