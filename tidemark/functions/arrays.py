"""Array expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty_str_array() -> Column:
    return F.array().cast("array<string>")


def union_tokens(a, b) -> Column:
    """A ∪ b, deduplicated, empties out, sorted. A null list counts as empty."""
    u = F.array_union(F.coalesce(_col(a), _empty_str_array()),
                      F.coalesce(_col(b), _empty_str_array()))
    return F.array_sort(F.filter(u, lambda x: x.isNotNull() & (x != F.lit(""))))


def generalise_tokens(c, general: Iterable[str], tag: str = "general") -> Column:
    """Every token in ``general`` becomes ``tag``; dedupe, drop empties, sort."""
    g = sorted(set(general))
    mapped = F.transform(_col(c), lambda t: F.when(t.isin(g), F.lit(tag)).otherwise(t))
    return F.array_sort(F.array_distinct(F.filter(mapped, lambda x: x.isNotNull() & (x != F.lit("")))))


def any_in_range_arr(c, lo: float, hi: float) -> Column:
    """Does any element lie in [lo, hi]."""
    return F.exists(_col(c), lambda x: x.between(F.lit(lo), F.lit(hi)))


def sum_arr(c) -> Column:
    """Array sum (0.0 for an empty array)."""
    return F.aggregate(_col(c), F.lit(0.0).cast("double"), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
