"""Join operators (J1-J10). Equi-joins only; Spark picks broadcast or
sort-merge from runtime sizes (AQE), and AQE splits skewed join partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import AtomicType

from .series import _keys


def metrics_wide(long_df: DataFrame, keys: Sequence[str], metric: str = "metric",
                 value: str = "value", metrics: Sequence[str] | None = None) -> DataFrame:
    """N-way full outer join of one-metric tables on ``keys``, written as one
    grouped pivot over the long table: one shuffle instead of N-1 joins. An
    explicit ``metrics`` list avoids the extra job that finds pivot values."""
    g = long_df.groupBy(*keys)
    g = g.pivot(metric, list(metrics)) if metrics is not None else g.pivot(metric)
    return g.agg(F.first(value, ignorenulls=True))


def hour_day_join(hourly: DataFrame, daily_hourly: DataFrame, key: str = "token", ts: str = "ts",
                  need: str = "price") -> DataFrame:
    """J2 + P4: hourly rows with daily-derived (already resampled) columns.
    Columns present on both sides keep the hourly value. A full outer join
    followed by dropping rows without ``need`` is a left join."""
    shared = set(hourly.columns) & set(daily_hourly.columns) - {key, ts}
    right = daily_hourly.drop(*shared)
    return hourly.join(right, [key, ts], "left").filter(F.col(need).isNotNull())


def mixed_grain_join(hourly: DataFrame, daily: DataFrame, key: str = "token", ts: str = "ts",
                     day_col: str = "date", suffix: str = "_news",
                     fill_zero: Sequence[str] | None = None) -> DataFrame:
    """J6 + C3: hourly rows joined with the daily row of the same day; daily
    columns get ``suffix``; the listed columns (default: all daily columns)
    are 0 where the day had no row."""
    dcols = [c for c in daily.columns if c not in (key, day_col)]
    right = daily.select(F.col(key), F.col(day_col).alias("_d"),
                         *[F.col(c).alias(c + suffix) for c in dcols])
    out = (hourly.withColumn("_d", F.to_date(F.col(ts)))
           .join(right, [key, "_d"], "left").drop("_d"))
    fill = [c + suffix for c in (dcols if fill_zero is None else fill_zero)]
    return out.na.fill(0, subset=fill)


def left_fill(left: DataFrame, right: DataFrame, on: Sequence[str],
              fill_zero: Sequence[str] | None = None) -> DataFrame:
    """J5 + C3: left join, then 0 in the right side's columns where no row matched."""
    out = left.join(right, list(on), "left")
    rc = [c for c in right.columns if c not in on] if fill_zero is None else list(fill_zero)
    return out.na.fill(0, subset=rc)


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence, keep: str = "first",
              nulls_last: bool = False) -> DataFrame:
    """One row per key; the first row in ``order`` (ascending) is kept, or
    the last with ``keep='last'``; equal order values are decided by the other
    atomic columns, so the result is the same on every run.

    Written as a grouped ``min_by``/``max_by`` over the whole row, so Spark
    pre-aggregates per task: a key repeated a billion times costs one row per
    task, not one task holding all its rows (as a row_number window would)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    parts = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        flag = c.isNull() if nulls_last else c.isNotNull()
        parts.append(F.struct(flag.alias("f"), c.alias("v")))
    # remaining columns break ties, so equal order values still pick one row for good
    row = F.struct(*[F.col(c) for c in rest])
    ties = [F.col(c) for c in rest if isinstance(df.schema[c].dataType, AtomicType)]
    parts += [F.struct(c.isNull().alias("f"), c.alias("v")) for c in ties]
    rank = F.struct(*parts) if parts else F.lit(0)
    pick = F.max_by(row, rank) if keep == "last" else F.min_by(row, rank)
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def unique_parent(df: DataFrame, key: str, order: Sequence) -> DataFrame:
    """Deduplicate a parent table before a child -> parent join."""
    return unique_by(df, [key], order)


def lookup_by_time(df: DataFrame, lookup: DataFrame, key: str = "token", ts: str = "ts",
                   lookup_key: str = "base", value: str = "price", out: str = "base_price",
                   order: Sequence | None = None) -> DataFrame:
    """Value of another series (``lookup_key`` of each row) at the same
    time. Duplicate (series, time) keys in ``lookup``: the last row in
    ``order`` wins (without an order, the largest value: deterministic)."""
    lk = lookup.select(F.col(key).alias(lookup_key), F.col(ts), F.col(value).alias(out),
                       *([o for o in order] if order else []))
    if order:
        lk = unique_by(lk, [lookup_key, ts], order, keep="last").select(lookup_key, ts, out)
    else:
        lk = lk.groupBy(lookup_key, ts).agg(F.max(out).alias(out))
    return df.join(lk, [lookup_key, ts], "left")


def semi(df: DataFrame, listed: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key is listed."""
    return df.join(listed, _keys(on), "left_semi")


def anti(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other``."""
    return df.join(other, _keys(on), "left_anti")


def any_in_range(df: DataFrame, key, c: str, lo: float, hi: float) -> DataFrame:
    """F7 + A6: per entity, the total of ``c``, the number of rows and whether
    any value lies in [lo, hi] (one grouped aggregate)."""
    return df.groupBy(*_keys(key)).agg(F.sum(c).alias(f"total_{c}"), F.count(F.lit(1)).alias("n_rows"),
                                       F.max(F.col(c).between(lo, hi)).alias("in_range"))
