"""Conditional and arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coalesce_cols(*cols, default=None) -> Column:
    """First non-null, else ``default``."""
    parts = [_col(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def pick_better(text_label, text_score, title_label, title_score) -> Column:
    """struct(label, score) of the text or the title: the larger score wins,
    a tie goes to the text, a null text score falls back to the title."""
    text = F.struct(_col(text_label).alias("label"), _col(text_score).cast("double").alias("score"))
    title = F.struct(_col(title_label).alias("label"), _col(title_score).cast("double").alias("score"))
    return (F.when(_col(text_score).isNull(), title)
            .when(_col(title_score).isNull(), text)
            .when(_col(text_score) >= _col(title_score), text)
            .otherwise(title))


def mean_of(*cols) -> Column:
    """M2: mean of columns; null if any is null."""
    s = None
    for c in cols:
        s = _col(c) if s is None else s + _col(c)
    return s / F.lit(float(len(cols)))


def percentage(part, total) -> Column:
    """M1: part / total * 100; null (no error) when total is 0 or null."""
    return F.try_divide(_col(part).cast("double"), _col(total).cast("double")) * F.lit(100.0)


def noise_factor(key_col, scales: dict, default_scale: float, seed: int = 42) -> Column:
    """M4: multiplicative noise 1 + s * N(0, 1), ``s`` per key (e.g. 0.025 for
    one token, 0.05 for the rest). Seeded; callers leave it off by default."""
    s = F.lit(float(default_scale))
    for k, v in scales.items():
        s = F.when(_col(key_col) == F.lit(k), F.lit(float(v))).otherwise(s)
    return F.lit(1.0) + s * F.randn(seed)


def noise_factors(key_col, scales: dict, default_scale: float, steps: int, seed: int = 42) -> Column:
    """M4 for a recursion: ``steps`` factors 1 + s * N(0, 1) as an array, by key and step.

    The normal values come from two numbers in (0, 1) each (Box-Muller), the first eight hex
    digits of md5("key|seed|step|1") and of md5("key|seed|step|2"): a rerun, another
    partitioning or another engine draws the same."""
    key = F.coalesce(_col(key_col).cast("string"), F.lit(""))
    s = F.lit(float(default_scale))
    for k, v in scales.items():
        s = F.when(key == F.lit(k), F.lit(float(v))).otherwise(s)

    def u(step, n):
        text = F.concat(key, F.lit(f"|{seed}|"), step.cast("string"), F.lit(f"|{n}"))
        return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    normal = lambda i: F.sqrt(-2.0 * F.log(u(i, 1))) * F.cos(2.0 * F.pi() * u(i, 2))
    return F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: 1.0 + s * normal(i))


def pearson(x, y) -> Column:
    """Pearson r over rows where both values exist, as an aggregate; null (not
    an error under ANSI mode) when a side is constant or has under 2 pairs."""
    xc, yc = _col(x), _col(y)
    both = xc.isNotNull() & yc.isNotNull()
    xs, ys = F.when(both, xc), F.when(both, yc)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))
