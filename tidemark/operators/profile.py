"""Null and correlation profiles (F10, F11, A10-A13, A18) in long form.

A column is a property of the whole table, so per-token choices (drop a column
for one token only) are returned as a long (token, column, ...) mask and
applied by nulling, which keeps one schema for all tokens."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.conditional import pearson
from .series import _keys


def _stack(cols: Sequence[str], exprs_by_col) -> str:
    parts = []
    for c in cols:
        parts.append(f"'{c}'")
        parts.extend(exprs_by_col(c))
    return ", ".join(parts)


def null_profile(df: DataFrame, key, cols: Sequence[str], max_null: float = 0.3) -> DataFrame:
    """Per key and column: ``n_rows``, ``null_count``,
    ``null_fraction`` and ``keep`` (fraction <= max_null). One aggregate pass."""
    keys = _keys(key)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.count(F.when(F.col(c).isNull(), 1)).alias(f"_z{i}"))
    wide = df.groupBy(*keys).agg(*aggs)
    stack = ", ".join(f"'{c}', _z{i}" for i, c in enumerate(cols))
    long = wide.select(*keys, F.col("_n").alias("n_rows"),
                       F.expr(f"stack({len(cols)}, {stack}) AS (column, null_count)"))
    frac = F.col("null_count") / F.col("n_rows")
    return (long.withColumn("null_fraction", frac)
            .withColumn("keep", F.col("null_fraction") <= F.lit(max_null)))


def null_mask(df: DataFrame, key, cols: Sequence[str], max_null: float = 0.3) -> DataFrame:
    """A12 in one aggregate: per key, column ``_k_{c}`` = null fraction of ``c``
    <= max_null. Wide form, ready to join (one row per key)."""
    keys = _keys(key)
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(*[
        ((n - F.count(F.col(c))) / n <= F.lit(max_null)).alias(f"_k_{c}") for c in cols])


def apply_wide_mask(df: DataFrame, wide: DataFrame, key, cols: Sequence[str]) -> DataFrame:
    """Null every (key, column) whose ``_k_{column}`` flag is false."""
    keys = _keys(key)
    out = df.join(wide, keys, "left")
    for c in cols:
        out = out.withColumn(c, F.when(F.coalesce(F.col(f"_k_{c}"), F.lit(True)), F.col(c)))
    return out.drop(*[f"_k_{c}" for c in cols])


def apply_mask(df: DataFrame, mask: DataFrame, key, cols: Sequence[str]) -> DataFrame:
    """Null every (key, column) the mask does not keep. The mask is one row per
    key and column; it is pivoted to one row per key and joined."""
    keys = _keys(key)
    wide = (mask.groupBy(*keys).pivot("column", list(cols))
            .agg(F.first("keep")))
    wide = wide.select(*keys, *[F.col(c).alias(f"_k_{c}") for c in cols])
    out = df.join(wide, keys, "left")
    for c in cols:
        out = out.withColumn(c, F.when(F.coalesce(F.col(f"_k_{c}"), F.lit(True)), F.col(c)))
    return out.drop(*[f"_k_{c}" for c in cols])


def all_null_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """F10 (whole table): names of columns without any value; one aggregate job,
    one row to the driver."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] == 0]


def rows_with_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """rows with a null in any of ``cols``."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.filter(cond)


def corr_vector(df: DataFrame, key, target: str, cols: Sequence[str],
                drop_null_rows: bool = True) -> DataFrame:
    """A10: Pearson r of ``target`` with each column per key, long form
    (key, feature, r). Rows with a null in any used column are left out first."""
    keys = _keys(key)
    d = df.na.drop(subset=[target, *cols]) if drop_null_rows else df
    wide = d.groupBy(*keys).agg(*[pearson(target, c).alias(f"_r{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _r{i}" for i, c in enumerate(cols))
    return wide.select(*keys, F.expr(f"stack({len(cols)}, {stack}) AS (feature, r)"))


def feature_select(corr_long: DataFrame, key, target: str, threshold: float = 0.4) -> DataFrame:
    """Features with |r| >= threshold per key; the target itself always
    kept (rank 0, first), the rest ranked by |r| descending."""
    keys = _keys(key)
    kept = corr_long.filter(F.abs(F.col("r")) >= threshold).select(*keys, "feature", "r")
    tgt = corr_long.select(*keys).distinct().select(*keys, F.lit(target).alias("feature"),
                                                      F.lit(1.0).alias("r"))
    return tgt.unionByName(kept)


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """A18."""
    return df.select(c).distinct()


def null_counts(df: DataFrame, key, cols: Sequence[str]) -> DataFrame:
    """Per key and column, the number of nulls (long form)."""
    return null_profile(df, key, cols).select(*_keys(key), "column", "null_count")
