"""Mixing sources to target weights, exactly and repeatably.

Every document gets a hash-random key; within each source the documents are sorted by it
(range buckets of the key, so a hot source spreads over many tasks), prefix sums of the
token counts are taken bucket by bucket, and the source is cut at its exact budget. A
budget above the source's size repeats whole epochs first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, WORD, named_back, set_aside, store

WEIGHTS = (5.0, 2.0, 1.0)


def size_of(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(rank: Column, weights) -> Column:
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """``sources(source, source_size, ...)`` plus weight and target.

    Weights repeat over the sources by code point, null last. Targets share ``share`` of all
    sizes by weight, stop at ``max_epochs`` times the source's size, and the excess is reshared
    by weight until none is above: target = min(cap, level * weight) for the one level that
    fits, found by a running sum over the sources in order of cap / weight. Works on the table
    of sources only (one row each)."""
    everywhere = Window.partitionBy(F.lit(0))
    s = sources.withColumn("weight", _cycle(F.row_number().over(
        everywhere.orderBy(F.col("source").asc_nulls_last())), weights))
    s = s.withColumns({"__cap": F.col("source_size") * F.lit(float(max_epochs)),
                       "__all": F.sum("source_size").over(everywhere) * F.lit(float(share))})
    order = everywhere.orderBy(F.col("__cap") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("__cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("__level", (F.col("__all") - full) / open_weight)
    fits = F.when(F.col("__level") * F.col("weight") <= F.col("__cap"), F.col("__level"))
    s = s.withColumn("__level", F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("__cap"), F.coalesce(F.col("__level") * F.col("weight"), F.col("__cap")))
    return s.withColumn("target", target).drop("__cap", "__all", "__level")


def plan_cuts(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, max_epochs: int = 3,
              rows_per_bucket: int = 20_000) -> DataFrame:
    """One row per source: source, source_size, target, epochs (whole passes), and the cut
    (cut_key, cut_id) with cut_words: documents that sort before it are taken once more, the
    one at it gives ``cut_words`` more words.

    ``sizes`` has source, key (long, hash-random), id, size; rows equal in (key, id) are one
    unit of the order."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__docs"))
    s = targets(per_source, weights, share, max_epochs)
    budget = F.round("target").cast("long")
    s = s.withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0).cast("long")),
        "__rest": F.when(F.col("source_size") > 0, F.pmod(budget, F.col("source_size"))).otherwise(F.lit(0).cast("long")),
        "__buckets": F.ceil(F.col("__docs") / F.lit(rows_per_bucket)).cast("long"),
    })
    plan = s.select(F.col("source").alias("__src"), "source_size", "target", "epochs", "__rest", "__buckets")
    same = F.col("source").eqNullSafe(F.col("__src"))
    # the key's place in its range decides the bucket: equal shares of a source, in key order
    place = (F.shiftrightunsigned("key", 1).cast("double") / F.lit(float(1 << 63)))
    ranked = sizes.withColumn("__order", F.shiftrightunsigned("key", 1))
    in_bucket = ranked.join(plan, same).withColumn("__bucket", F.least(F.floor(place * F.col("__buckets")), F.col("__buckets") - 1))
    units = in_bucket.groupBy("__src", "__bucket", "__order", "key", "id").agg(
        F.sum("size").alias("__unit"), F.count("*").alias("__rows"), F.first("__rest").alias("__rest"))
    sums = in_bucket.groupBy("__src", "__bucket").agg(F.sum("size").alias("__sum"), F.first("__rest").alias("__rest"))
    before = F.coalesce(F.sum("__sum").over(Window.partitionBy("__src").orderBy("__bucket")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    cut_bucket = (sums.withColumn("__before", before)
                  .where((F.col("__before") <= F.col("__rest")) & (F.col("__rest") < F.col("__before") + F.col("__sum")))
                  .select(F.col("__src").alias("__src2"), F.col("__bucket").alias("__bucket2"), "__before"))
    inside = units.join(cut_bucket, F.col("__src").eqNullSafe(F.col("__src2")) & (F.col("__bucket") == F.col("__bucket2")))
    run = F.col("__before") + F.coalesce(F.sum("__unit").over(
        Window.partitionBy("__src", "__bucket").orderBy("__order", "key", F.col("id").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    cut = (inside.withColumn("__run", run)
           .where((F.col("__run") <= F.col("__rest")) & (F.col("__rest") < F.col("__run") + F.col("__unit")))
           .select(F.col("__src").alias("__src3"), F.col("__order").alias("__cut_order"), F.col("key").alias("__cut_key"),
                   F.col("id").alias("__cut_id"), F.expr("(__rest - __run) div __rows").alias("__cut_words")))
    return plan.join(cut, F.col("__src").eqNullSafe(F.col("__src3")), "left").drop("__src3", "__rest", "__buckets")


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              seed: int = 7, weights=WEIGHTS, share: float = 1.0, max_epochs: int = 3,
              rows_per_bucket: int = 20_000) -> DataFrame:
    """``docs`` plus size, source_size, target, taken (long: words the mix takes, repeats counted).

    Null text has size 0 and is never taken; null source is a source of its own, the last; null
    ids are ordinary. Rows equal in id, text and source sort as one unit and share its cut.
    ``taken`` = epochs * size, plus size before the source's cut, plus the cut's words at it, so
    a source's taken words equal its rounded target (less a word per copy where identical rows
    meet at the cut). An empty table gives no rows. Columns of these four names are replaced."""
    added = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in added]
    d = docs.select(*[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(kept)],
                    F.col(f"`{source_col}`").alias("source"), F.col(f"`{id_col}`").alias("id"), size_of(F.col(f"`{text_col}`")).alias("size"),
                    F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(seed)).alias("key"))
    sizes = store(d.select("source", "key", "id", "size"), "sizes")
    cuts = store(plan_cuts(sizes, weights, share, max_epochs, rows_per_bucket), "cuts")
    if not kept:
        raise ValueError("docs needs its columns")
    d = d.join(cuts, F.col("source").eqNullSafe(F.col("__src")))
    order, low = F.shiftrightunsigned("key", 1), F.col("__cut_order")
    same_id = F.col("id").eqNullSafe(F.col("__cut_id"))
    at = (F.col("key") == F.col("__cut_key")) & same_id
    id_before = (F.col("id") < F.col("__cut_id")) | (F.col("id").isNull() & F.col("__cut_id").isNotNull())
    ahead = (order < low) | ((order == low) & (F.col("key") < F.col("__cut_key"))) | ((F.col("key") == F.col("__cut_key")) & id_before)
    more = F.when(at, F.least(F.col("__cut_words"), F.col("size"))).when(ahead, F.col("size")).otherwise(F.lit(0).cast("long"))
    taken = F.col("epochs") * F.col("size") + F.coalesce(more, F.lit(0).cast("long"))
    return d.select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(kept)], "size", "source_size", "target", taken.alias("taken"))


def cut_text(text: Column, n_words: Column) -> Column:
    """The text through its ``n_words``-th word, blanks as they stand."""
    pieces = F.split(text, f"(?<={WORD[:-1]})(?={SPACE})")
    return F.when(n_words <= 0, F.lit("")).otherwise(F.array_join(F.slice(pieces, F.lit(1), n_words.cast("int")), ""))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as it takes them, the document at a source's
    cut shortened to the words taken; documents of which no word is taken are absent. All other
    columns pass through, whatever their names."""
    names = [options.get(f"{c}_col", d) for c, d in (("id", "doc_id"), ("source", "source"), ("text", "text"))]
    given, (docs, (id_col, source_col, text_col)) = docs, set_aside(docs, *names)
    m = mix_sizes(docs, **{**options, "id_col": id_col, "source_col": source_col, "text_col": text_col})
    whole = F.col("taken").cast("long")
    times = F.when(F.col("size") > 0, F.ceil(whole / F.col("size"))).otherwise(F.lit(0)).cast("int")
    m = m.withColumn("__times", times).where(F.col("__times") > 0)
    m = m.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    rest = F.col("taken") - (F.col("__copy") - 1) * F.col("size")
    text = F.when(rest >= F.col("size"), F.col(text_col)).otherwise(cut_text(F.col(text_col), rest))
    return named_back(m.withColumn(text_col, text), given)
