"""Quality rules by cross-document line frequency, DataFrame functions only.

Per document: word counts, symbols, repeated lines and repeated 3-word windows (the base
rules). Across documents: every line is normalised and hashed, its distinct documents are
counted per host, lines in too many documents of a host are removed, and a document that
loses too much of its words is rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, WORD

_BLANKS = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of a text (null: none), as an array."""
    flat = F.translate(F.coalesce(text, F.lit("")), _BLANKS, " " * len(_BLANKS))
    return F.array_remove(F.split(flat, " "), "")


def lines(text: Column) -> Column:
    """\\n-split lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(WORD)))


def normalised(line: Column) -> Column:
    """Lower case, blanks collapsed and trimmed, digit runs as 0."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), SPACE + "+", " ")), "[0-9]+", "0")


def base_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumns({"__w": words(text), "__l": lines(text)})
    d = d.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "__h": F.when(F.size("__w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("__w") - 3),
            lambda i: F.struct(F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)).alias("h"), i.alias("p")))),
    }).drop("__l", "__w")
    d = d.withColumn("__s", F.sort_array("__h")).drop("__h")
    s = F.col("__s")
    same = lambda x, j: F.coalesce(x.h == F.get(s, j).h, F.lit(False))
    twin = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
    d = d.withColumn("__p", F.sort_array(F.transform(twin, lambda x: x.p))).drop("__s")
    p = F.col("__p")
    gaps = F.transform(p, lambda x, i: F.coalesce(F.least(F.get(p, i + 1) - x, F.lit(3)), F.lit(3)))
    return d.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x),
                                                     F.lit(0).cast("long"))).drop("__p")


def line_table(docs: DataFrame, key: list[str], text_col: str, host_col: str) -> DataFrame:
    """One row per document and line: key..., host, position, hash of the normalised line, words."""
    d = docs.select(*[F.col(k) for k in key], F.col(host_col).alias("__host"),
                    F.posexplode(lines(F.col(text_col))).alias("__at", "__line"))
    return d.select(*key, "__host", "__at", F.xxhash64(normalised(F.col("__line"))).alias("__lh"),
                    F.size(words(F.col("__line"))).alias("__lw"))


def judge(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_docs: int = 20, max_share: float = 0.02, min_left: float = 0.3, min_words: int = 50,
          max_repeat_pct: int = 50) -> DataFrame:
    """``key_col`` plus the base counts, base_failed, n_line_words_removed and kept, one row per
    row of ``docs``.

    base_failed: n_words < ``min_words`` or 100 * n_repeat_words > ``max_repeat_pct`` * n_words.
    A line is removed where at least ``min_docs`` documents of its host hold it and they are
    more than ``max_share`` of the host's documents. kept: not base_failed, and more than
    ``min_left`` of the words are left. Null text: no words, so rejected; null host is a host of
    its own; null keys are ordinary rows. Rows equal in key, host and text are one document and
    get the same verdict; rows that share a key only are separate documents. Lines are read
    whole; an empty table gives no rows. Other columns are ignored, whatever their names."""
    d = docs.select(F.col(key_col).alias("__k"), F.col(text_col).alias("__t"), F.col(host_col).alias("__host"))
    d = d.withColumn("__id", F.xxhash64("__k", "__host", "__t"))
    found = line_table(d, ["__id"], "__t", "__host")
    # one shuffle by (host, line, document) makes lines distinct in a document (the set undoes repeated rows)
    at = F.collect_set(F.struct("__at", "__lw"))
    per_doc = found.groupBy("__host", "__lh", "__id").agg(
        F.aggregate(at, F.lit(0), lambda a, x: a + x["__lw"]).alias("__lw"))
    hosts = d.groupBy("__host").agg(F.count_distinct("__id").alias("__docs"))
    counts = per_doc.groupBy("__host", "__lh").agg(F.count("*").alias("__n")).where(F.col("__n") >= min_docs)
    common = (counts.join(hosts.withColumnRenamed("__host", "__h2"), F.col("__host").eqNullSafe(F.col("__h2")))
              .where(F.col("__n") > max_share * F.col("__docs")).select("__host", "__lh"))
    common = common.select(F.col("__host").alias("__h2"), F.col("__lh").alias("__lh2"))
    lost = (per_doc.join(common, (F.col("__lh") == F.col("__lh2")) & F.col("__host").eqNullSafe(F.col("__h2")))
            .groupBy("__id").agg(F.sum("__lw").alias("__lost")))
    base = base_features(d, "__t").drop("__t")
    out = base.join(lost, "__id", "left")
    lost_words = F.coalesce(F.col("__lost"), F.lit(0)).cast("long")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    kept = ~failed & ((F.col("n_words") - lost_words) > min_left * F.col("n_words"))
    return out.select(F.col("__k").alias(key_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), lost_words.alias("n_line_words_removed"), kept.alias("kept"))
