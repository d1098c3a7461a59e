"""Correlation against base series (A7, A8) and base-price enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.conditional import pearson
from .joins import lookup_by_time
from .series import with_position


def corr_base(df: DataFrame, key: str = "token", ts: str = "ts", c: str = "price",
              bases: Sequence[str] = ("BTC", "ETH"), align: str = "time") -> DataFrame:
    """A7 + A8: Pearson r of each non-base series with each base series and the
    best base. Long (key, base, r) rows plus ``best`` per key.

    ``align='time'`` pairs values at the same time (a join on ts);
    ``align='position'`` pairs the i-th rows (what the reference does).
    Best = highest r, a null r ranks last, a tie goes to the earlier base."""
    bases = list(bases)
    if align == "position":
        df = with_position(df, key, ts, out="_i")
        on = "_i"
    else:
        on = ts
    base = df.filter(F.col(key).isin(bases)).select(
        F.col(key).alias("base"), F.col(on), F.col(c).alias("_bc"))
    other = df.filter(~F.col(key).isin(bases)).select(key, on, c)
    pairs = other.join(base, [on], "inner")
    r = pairs.groupBy(key, "base").agg(pearson(c, "_bc").alias("r"))
    # keys with no pair at all still get one row per base (r null)
    base_list = F.array(*[F.struct(F.lit(b).alias("base"), F.lit(i).alias("_bi"))
                          for i, b in enumerate(bases)])
    grid = other.select(key).distinct().select(key, F.inline(base_list))
    r = grid.join(r, [key, "base"], "left")
    rank = F.struct(F.col("r").isNotNull(), F.coalesce(F.col("r"), F.lit(0.0)), -F.col("_bi"))
    best = r.groupBy(key).agg(F.max_by("base", rank).alias("best"))
    return r.join(best, [key], "inner").drop("_bi")


def base_price(df: DataFrame, key: str = "token", ts: str = "ts", c: str = "price",
               bases: Sequence[str] = ("BTC", "ETH"), align: str = "time",
               out: str = "base_price") -> DataFrame:
    """E8 = A7 + A8 + J8: each non-base series gets the ``c`` of its
    best-correlated base at the same time (``base``, ``base_price``); its rows
    without a base value are dropped. Base series pass through with nulls."""
    best = corr_base(df, key, ts, c, bases, align).select(key, F.col("best").alias("base")).distinct()
    with_base = df.join(best, [key], "left")
    look = df.filter(F.col(key).isin(list(bases))).select(key, ts, c)
    out_df = lookup_by_time(with_base, look, key, ts, "base", c, out)
    return out_df.filter(F.col("base").isNull() | F.col(out).isNotNull())
