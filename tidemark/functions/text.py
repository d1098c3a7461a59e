"""Text expressions (T1-T4, T9-T12): URL and symbol stripping, stopword removal,
keyword-search pieces. Pure column expressions, evaluated inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from ..constants import (STOPWORDS_EN, URL_PATTERN, SYMBOL_PATTERN, SPLIT_PATTERN,
                         WORD_CLASS, LABEL_WORDS, LABEL_WORD_DEFAULT)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_array(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def words(c, stopwords: Iterable[str] | None = STOPWORDS_EN) -> Column:
    """Cleaned words of ``c`` as an array: URLs out (T1), symbols out (T2),
    lower case, split on whitespace, empties and stopwords out (T3).

    Order of steps matters: symbols go before the stopword test, so ``don't``
    becomes ``dont`` and survives."""
    # one pass for both removals: a URL starts with word characters, which the
    # symbol class never takes, so leftmost matching removes the same text as
    # removing URLs first and symbols after
    s = F.regexp_replace(_col(c), URL_PATTERN + "|" + SYMBOL_PATTERN + "+", "")
    parts = F.split(F.lower(s), SPLIT_PATTERN)
    if stopwords:
        # many literals -> Catalyst plans a hash-set lookup (InSet), not a scan
        sw = sorted(set(stopwords))
        return F.filter(parts, lambda w: (w != F.lit("")) & ~w.isin(sw))
    return F.filter(parts, lambda w: w != F.lit(""))


def clean_text(c, stopwords: Iterable[str] | None = STOPWORDS_EN) -> Column:
    """T4 = T1 . T2 . T3, words joined by one space. Null stays null."""
    return F.array_join(words(c, stopwords), " ")


def _word_count(k: str) -> int:
    import re
    return max(1, len(re.findall(r"\w+", k)))


def word_ngrams(c, max_n: int = 4, first_words: Iterable[str] | None = None) -> Column:
    """Word n-grams (1..max_n words) of the lower-cased text, each keeping the
    exact separators between its words. A keyword ``k`` occurs in the text
    with word bounds on both sides iff ``k`` is one of these strings.

    One regex scan per n: a capturing lookahead anchored at each word start
    yields overlapping matches; no per-element lambda over the text. With
    ``first_words`` the n >= 2 scans only start at those words."""
    low = F.lower(_col(c))
    w, nw = f"[{WORD_CLASS}]", f"[^{WORD_CLASS}]"
    parts = [F.regexp_extract_all(low, F.lit(f"{w}+"), 0)]
    start = w + "+"
    if first_words:
        start = "(?:" + "|".join("\\Q" + x + "\\E" for x in sorted(set(first_words), key=lambda x: -len(x))) + ")"
    for n in range(2, max_n + 1):
        pat = f"(?<!{w})(?=({start}(?:{nw}+{w}+){{{n - 1}}}))"
        parts.append(F.regexp_extract_all(low, F.lit(pat), 1))
    return F.concat(*parts)


def concat_text(*cols) -> Column:
    """Join parts with one space, a missing part counts as ''."""
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in cols])


def token_upper(c) -> Column:
    """T10."""
    return F.upper(_col(c))


def extract_field(c, field: str) -> Column:
    """A field of a JSON text (``$.field``)."""
    return F.get_json_object(_col(c), f"$.{field}")


def map_label(c, mapping: Mapping, default=None) -> Column:
    """Map values through a small fixed table; unmatched -> ``default``."""
    expr = None
    for k, v in mapping.items():
        cond = _col(c) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def label_word(c) -> Column:
    """-1/1 label -> negative/positive, anything else -> unknown."""
    return map_label(c, LABEL_WORDS, LABEL_WORD_DEFAULT)
