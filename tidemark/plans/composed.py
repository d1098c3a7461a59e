"""Composed plans: the reference's end-to-end steps as single lazy Spark plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import hour_day_join, left_fill, mixed_grain_join
from ..operators.profile import apply_wide_mask, null_mask
from ..session import materialize
from ..operators.series import fill_both, interpolate, resample_hourly, upsample_interpolate

SENT_COLS = ["count_positive", "count_negative", "percentage_positive", "total_count"]


def daily_to_hourly(daily: DataFrame, key: str, day_col: str, cols: Sequence[str],
                    ts: str = "ts") -> DataFrame:
    """W6 + W7: daily rows on an hourly grid (value at midnight), interpolated
    linearly in time between known days."""
    d = daily.select(key, F.col(day_col).cast("timestamp").alias(ts), *cols)
    if len(cols) == 1:
        return upsample_interpolate(d, key, ts, cols[0])
    return interpolate(resample_hourly(d, key, ts, cols), key, ts, cols)


def feature_table(market: DataFrame, daily: DataFrame | None, hourly_sent: DataFrame,
                  daily_sent: DataFrame, key: str = "token", ts: str = "ts",
                  day_col: str = "d", daily_cols: Sequence[str] = (),
                  max_null: float = 0.3, fill_mode: str = "bfill_ffill",
                  regular: bool = True, cut_lineage: bool = True) -> DataFrame:
    """One feature table per (token, hour).

    market (hourly) on a regular hourly grid (W6) <- daily metrics resampled and
    interpolated to hours (J2) <- hourly sentiment (J5, 0 where none) <- daily
    news sentiment of the same day (J6, suffix ``_news``, 0 where none); then
    per token, columns with more than ``max_null`` nulls are nulled out (A12
    mask) and remaining gaps filled from both sides (W5)."""
    mcols = [c for c in market.columns if c not in (key, ts)]
    base = resample_hourly(market, key, ts, mcols) if regular else market
    if daily is not None and daily_cols:
        dh = daily_to_hourly(daily, key, day_col, list(daily_cols), ts)
        base = base.join(dh.drop(*[c for c in dh.columns if c in mcols]), [key, ts], "left")
    if "count_total" in hourly_sent.columns:
        hourly_sent = hourly_sent.withColumnRenamed("count_total", "total_count")
    hs = hourly_sent.select(key, ts, *SENT_COLS)
    out = left_fill(base, hs, [key, ts], SENT_COLS)
    ds = daily_sent.select(key, "date", *SENT_COLS)
    out = mixed_grain_join(out, ds, key, ts, "date", "_news")
    value_cols = [c for c in out.columns if c not in (key, ts)]
    out = apply_wide_mask(out, null_mask(out, key, value_cols, max_null), key, value_cols)
    if cut_lineage:
        # the fill reads its input twice (segment counts, then rows): write the
        # joined hourly table once to the shared checkpoint folder instead of
        # recomputing grid, interpolation and joins
        out = materialize(out, "feature_base")
    return fill_both(out, key, ts, mcols + list(daily_cols), fill_mode)


def hour_day_table(market: DataFrame, daily: DataFrame, key: str, day_col: str,
                   daily_cols: Sequence[str], ts: str = "ts", need: str = "price") -> DataFrame:
    """J2 as the reference composes it: hourly rows <- daily rows upsampled and
    interpolated; names on both sides keep the hourly value; rows without
    ``need`` dropped."""
    dh = daily_to_hourly(daily, key, day_col, list(daily_cols), ts)
    return hour_day_join(market, dh, key, ts, need)


def label_articles(df: DataFrame, ts: str, title: str, description: str, dictionary,
                   lexicon=None, scorer=None, id_cols=None) -> DataFrame:
    """News path (T9, T4, H1/H2, T12) -> (ts, token, clean_text, label, label_word):
    title and description joined, cleaned, tagged with tokens (one row per
    token), scored (a fitted model via ``scorer``, else the ``lexicon``), and
    the same item (token, time, clean text) kept once (repeated searches
    store it several times)."""
    from ..functions.text import clean_text, label_word, concat_text
    from ..operators.keywords import extract_tokens, lexicon_score, sign_label
    from ..operators.joins import unique_by
    d = df.withColumn("clean_text", clean_text(concat_text(title, description)))
    d = extract_tokens(d, "clean_text", dictionary, "_tokens")
    if scorer is not None:
        from ..operators.textml import score_text
        d = score_text(d, "clean_text", scorer, "label", "_score").drop("_score")
    else:
        w = F.filter(F.split("clean_text", " "), lambda x: x != "")
        d = d.withColumn("label", sign_label(lexicon_score(w, lexicon or {})))
    d = d.select(F.col(ts).alias("ts"), F.explode("_tokens").alias("token"), "clean_text", "label")
    d = unique_by(d, ["token", "ts", "clean_text"], ["label"])
    return d.withColumn("label_word", label_word("label"))
