"""Keyword tagging and search.

The result depends on the text alone, so a row's tags never depend on other
rows or on ids. A dictionary that is small enough is a constant of the plan,
applied with higher-order functions: no shuffle, no Python. A larger one is
joined: the words (or word n-grams) of each distinct text with the dictionary,
the hits grouped by the text's 128-bit hash and joined back. Both ways give the
same result; the number of words in a keyword is taken from the dictionary.

The keyword search of a constant dictionary is a walk through its word trie: a
state is the keyword prefix read so far (words and exact separators), and the
next word is read only while the longer prefix is one of the trie's. Texts are
cut into words once, whatever the longest keyword, only the words that start a
keyword begin a walk, and only texts with such a word are cut into separators.
All tests are hash-set lookups (InSet)."""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import WORD_CLASS
from ..functions.text import word_ngrams, words as clean_words
from ..session import materialize
from .textml import by_frequency, dealt

# Dictionaries up to this many entries become plan constants.
MAX_LITERAL_ENTRIES = 5000
# ... if they have at most this many bytes.
MAX_LITERAL_BYTES = 1 << 20
# A dictionary table up to this many bytes is broadcast on the join path.
MAX_BROADCAST_BYTES = 32 << 20


def dictionary_rows(d) -> list[tuple[str, str]]:
    """(tag, keyword) pairs from {tag: [words]} or [words] (tag = keyword)."""
    if isinstance(d, Mapping):
        return [(t, w) for t, ws in d.items() for w in ws]
    return [(w, w) for w in d]


def _as_rows(dictionary, df: DataFrame):
    """(rows, None) for a dictionary that becomes a plan constant, else (None, table),
    keywords lower-cased. A stream cannot be grouped and joined back, so its dictionary has to
    be a constant: one beyond the bounds fails."""
    most, most_bytes = MAX_LITERAL_ENTRIES, MAX_LITERAL_BYTES
    if isinstance(dictionary, DataFrame):
        table = dictionary.select("tag", F.lower("keyword").alias("keyword")).where(F.col("keyword").isNotNull())
        # one job, at most most + 1 short rows reach the driver; the bytes are summed there first
        got = None
        if (table.limit(most + 1).agg(F.sum(F.octet_length("keyword"))).first()[0] or 0) <= most_bytes:
            got = table.limit(most + 1).collect()
        rows = None if got is None or len(got) > most else [(r[0], r[1]) for r in got]
    else:
        table = None
        rows = [(t, k.lower()) for t, k in dictionary_rows(dictionary)]
        if len(rows) > most or sum(len(k.encode()) for _, k in rows) > most_bytes:
            table, rows = df.sparkSession.createDataFrame(rows, "tag string, keyword string"), None
    if rows is None and df.isStreaming:
        raise ValueError(f"a stream's dictionary may have {most} entries and {most_bytes} bytes")
    return rows, table


def _tag_map(rows) -> Column:
    by_kw: dict[str, list[str]] = {}
    for t, k in rows:
        by_kw.setdefault(k, [])
        if t not in by_kw[k]:
            by_kw[k].append(t)
    keys = sorted(by_kw)
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                             F.array(*[F.array(*[F.lit(t) for t in by_kw[k]]) for k in keys]))


def _join_path(df: DataFrame, c: str, items: Column, table: DataFrame, out: str) -> DataFrame:
    """Explode ``items`` per text, keep those in the (tag, keyword) table, collect the tags per
    text. Rows are dealt out by their text once, and each distinct text is searched where it
    is: no hit is shuffled where the table is broadcast, which its bytes, summed first, decide.
    Of a larger table the entries that most texts have are broadcast; only the items not
    among them, which are few in any text, are shuffled to the others."""
    h1, h2 = F.xxhash64(F.col(c)), F.xxhash64(F.lit(1), F.col(c))
    rows = dealt(df.withColumns({"_h1": h1, "_h2": h2}), c, "_h1", "_h2")
    texts = rows.groupBy("_h1", "_h2").agg(F.any_value(c).alias(c))
    # explode_outer: a plain explode has the items made twice, once for an inferred filter
    ex = texts.select("_h1", "_h2", F.explode_outer(F.array_distinct(items)).alias("term"))
    tb = table.select(F.col("keyword").alias("term"), "tag").distinct()
    size = table.agg(F.sum(F.octet_length("keyword") + F.octet_length("tag") + F.lit(64))).first()[0] or 0
    rare = None
    if size > MAX_BROADCAST_BYTES:
        # repeated texts count each time: only the order of the entries hangs on it
        found = df.select(F.explode_outer(F.array_distinct(items)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        tb = materialize(tb.join(found, "term"), "keywords")
        tb, rare = by_frequency(tb, F.floor(F.log2("n") * 8), MAX_BROADCAST_BYTES // 2)
    tags = lambda x: x.groupBy("_h1", "_h2").agg(F.collect_set("tag").alias("_tags"))
    out_df = rows.join(tags(ex.join(F.broadcast(tb), "term")), ["_h1", "_h2"], "left")
    empty = F.array().cast("array<string>")
    if rare is not None:
        left = ex.where(F.col("term").isNotNull()).join(F.broadcast(tb.select("term").distinct()), "term", "left_anti")
        more = tags(left.join(rare, "term")).withColumnRenamed("_tags", "_more")
        out_df = out_df.join(more, ["_h1", "_h2"], "left").withColumn("_tags", F.array_union(F.coalesce("_tags", empty), F.coalesce("_more", empty))).drop("_more")
    return (out_df.withColumn(out, F.when(F.col(c).isNotNull(), F.array_sort(F.coalesce("_tags", empty))))
            .drop("_h1", "_h2", "_tags"))


def tags_of_words(word_array: Column, rows) -> Column:
    """Sorted distinct tags of the words that are dictionary keywords. The
    membership test is a hash-set lookup (InSet); only hits read the map."""
    m = _tag_map(rows)
    keys = sorted({k for _, k in rows})
    hit = F.filter(word_array, lambda w: w.isin(keys))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(hit, lambda w: F.try_element_at(m, w)))))


def extract_tokens(df: DataFrame, c: str, dictionary, out: str = "tokens",
                   id_col: str | None = None, cleaned: bool = True,
                   stopwords: Sequence[str] | None = None) -> DataFrame:
    """T5: for each word of the text (already cleaned when ``cleaned``, else
    cleaned here): the tags of the dictionary entries equal to it. A
    dictionary {symbol: words} tags with the symbol; a plain list of words
    tags with the word itself. Result: sorted distinct array. ``id_col`` is
    accepted for older callers; the result does not depend on ids."""
    wa = (F.filter(F.split(F.col(c), " "), lambda w: w != "") if cleaned
          else clean_words(F.col(c), stopwords) if stopwords is not None else clean_words(F.col(c)))
    rows, table = _as_rows(dictionary, df)
    if rows is not None:
        return df.withColumn(out, tags_of_words(wa, rows))
    return _join_path(df, c, wa, table, out)


def keyword_parts(k: str) -> list[str] | None:
    """[word, separator, word, ..] of a keyword, None if it does not begin and end with a word
    (then it never stands between word bounds)."""
    inside = lambda c: c == "_" or unicodedata.category(c)[0] in "LN"
    parts = ["".join(g) for _, g in itertools.groupby(k, inside)]
    return parts if k and inside(k[0]) and inside(k[-1]) else None


def _among(x: str, values) -> str:
    """SQL: is ``x`` one of the values? Written as text: one call whatever their number."""
    quoted = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in sorted(values))
    return f"({x} IN ({quoted}))" if quoted else "false"


def trie_search(df: DataFrame, c: str, keywords) -> DataFrame:
    """``df`` with ``_found``: the keywords that stand in the text between word bounds, repeats
    included (see the module's head for the walk)."""
    paths = [p for k in sorted(set(keywords)) if (p := keyword_parts(k))]
    whole = {"".join(p) for p in paths}
    firsts = {p[0] for p in paths}
    inner = {"".join(p[:n]) for p in paths for n in range(3, len(p) + 1, 2)}    # states after two words or more
    low = F.lower(F.col(c))
    words = F.regexp_extract_all(low, F.lit(f"[{WORD_CLASS}]+"), 0)
    if not inner:
        return df.withColumn("_cut", words).withColumn("_found", F.expr(f"filter(_cut, x -> {_among('x', firsts)})")).drop("_cut")
    # separators[i + 1] stands between words i and i + 1; array(..) and transform hold a value
    # that is used several times
    quoted = f"`{c}`"
    walk = f"""transform(array(_cut), w -> transform(
        array(filter(sequence(0, size(w)), i -> {_among('get(w, i)', firsts)})),
        starts -> if(size(starts) = 0, cast(array() as array<string>), transform(
            array(split(lower({quoted}), r'[{WORD_CLASS}]+', -1)),
            separators -> flatten(transform(starts, i -> aggregate(
                sequence(1, {max(len(p) // 2 for p in paths)}),
                named_struct('p', get(w, i), 'found', filter(array(get(w, i)), x -> {_among('x', whole & firsts)})),
                (state, k) -> if(state.p is null, state, transform(
                    array(concat(state.p, get(separators, i + k), get(w, i + k))),
                    n -> named_struct('p', if({_among('n', inner)}, n, null),
                                      'found', if({_among('n', whole & inner)}, concat(state.found, array(n)), state.found)))[0]),
                state -> state.found))))[0]))[0])[0]"""
    return df.withColumn("_cut", words).withColumn("_found", F.expr(walk)).drop("_cut")


def find_keywords(df: DataFrame, c: str, keywords, out: str = "words_found",
                  one: str = "word_found", id_col: str | None = None) -> DataFrame:
    """Every keyword that occurs in the raw text as whole words (word
    bounds on both sides, case ignored, separators inside a keyword must
    match exactly), however many words it has. ``out`` = sorted array of the
    keywords found, ``one`` = the first of them (null when none). ``id_col`` is
    accepted for older callers; the result does not depend on ids."""
    rows, table = _as_rows(keywords, df)
    if rows is not None:
        found = trie_search(df, c, {k for _, k in rows})
        out_df = found.withColumn(out, F.when(F.col(c).isNotNull(), F.array_sort(F.array_distinct("_found")))).drop("_found")
    else:
        t = table.select("keyword").distinct().withColumn("tag", F.col("keyword"))
        # words of the longest keyword: one row reaches the driver
        n_max = t.agg(F.max(F.regexp_count("keyword", F.lit(f"[{WORD_CLASS}]+")))).first()[0] or 1
        out_df = _join_path(df, c, word_ngrams(F.col(c), n_max), t, out)
    return out_df.withColumn(one, F.try_element_at(F.col(out), F.lit(1)))


def kw_filter(df: DataFrame, c: str, keywords) -> DataFrame:
    """rows whose text has at least one keyword as whole words.

    The search result is produced through a one-row ``inline`` (a Generate):
    a filter on a generated column is not pushed below it, so the search runs
    once per row instead of once for the filter and once for the output."""
    found = find_keywords(df, c, keywords)
    cols = [x for x in found.columns if x not in ("words_found", "word_found")]
    g = found.select(*cols, F.inline(F.array(F.struct(F.col("words_found").alias("words_found"),
                                                      F.col("word_found").alias("word_found")))))
    return g.filter(F.size("words_found") > 0)


def lexicon_score(word_array: Column, lexicon: Mapping[str, float]) -> Column:
    """H2: sum of the lexicon weights of the words (0.0 when none)."""
    keys = sorted(lexicon)
    m = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                          F.array(*[F.lit(float(lexicon[k])) for k in keys]))
    weights = F.transform(F.filter(word_array, lambda w: w.isin(keys)),
                          lambda w: F.try_element_at(m, w))
    return F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)


def sign_label(score: Column) -> Column:
    """1 / -1 by the sign of the score, null at 0 (no opinion)."""
    return F.when(score > 0, F.lit(1)).when(score < 0, F.lit(-1))
