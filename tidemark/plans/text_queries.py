"""Registered text queries over DOC (documents, labels) and THR (conversations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import bindings as B
from .bindings import sql_words, with_ctes
from .registry import register
from ..constants import (TEST_KEYWORDS, TEST_GENERAL, TEST_LEXICON, TEST_SEARCH_KEYWORDS,
                         TEST_SOURCES)
from ..functions.arrays import generalise_tokens, union_tokens
from ..functions.conditional import pick_better
from ..functions.text import clean_text, concat_text, words
from ..operators.evaluate import class_counts, class_report
from ..operators.joins import unique_parent
from ..operators.keywords import (dictionary_rows, extract_tokens, find_keywords, kw_filter,
                                  lexicon_score, sign_label, tags_of_words)
from ..operators.rollup import explode_tokens, label_pivot
from ..operators.textml import labelled_corpus, tfidf

KW_ROWS = dictionary_rows(TEST_KEYWORDS) + dictionary_rows(TEST_GENERAL)


def _sql_str_list(vals):
    return "[" + ", ".join("'" + v + "'" for v in vals) + "]"


def _sql_tag_case(w: str) -> str:
    return "CASE " + w + " " + " ".join(f"WHEN '{k}' THEN '{t}'" for t, k in KW_ROWS) + " END"


def sql_tokens(words_sql: str) -> str:
    return (f"list_sort(list_distinct(list_filter(list_transform({words_sql}, lambda w: {_sql_tag_case('w')}), "
            "lambda t: t IS NOT NULL)))")


def sql_lex(words_sql: str) -> str:
    case = "CASE w " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TEST_LEXICON.items()) + " ELSE 0.0 END"
    return f"coalesce(list_sum(list_transform({words_sql}, lambda w: {case})), 0.0)"


GEN_SQL = _sql_str_list(sorted(TEST_GENERAL))


def sql_generalise(tok_sql: str) -> str:
    return (f"list_sort(list_distinct(list_filter(list_transform({tok_sql}, lambda t: "
            f"CASE WHEN list_contains({GEN_SQL}, t) THEN 'general' ELSE t END), lambda t: t IS NOT NULL AND t <> '')))")


def _docs(spark, sf):
    return B.read(spark, sf, "documents")


def _docs_text(spark, sf):
    """(doc_id, text) spread over the cores for the regex-heavy text work."""
    from ..sources.readers import spread
    return spread(_docs(spark, sf).select("doc_id", "text"))


# --------------------------------------------------------------- scans/filters
@register("scan_pruned", "SELECT doc_id, lang, source FROM documents")
def q_scan_pruned(spark, sf):
    return _docs(spark, sf).select("doc_id", "lang", "source")


@register("filter_isin", f"SELECT doc_id, source FROM documents WHERE source IN "
          f"({', '.join(repr(s) for s in TEST_SOURCES)})")
def q_filter_isin(spark, sf):
    return _docs(spark, sf).filter(F.col("source").isin(TEST_SOURCES)).select("doc_id", "source")


# --------------------------------------------------------------- T1-T7
@register("clean_text", f"SELECT doc_id, {B.sql_clean('text')} AS clean FROM documents")
def q_clean_text(spark, sf):
    return _docs_text(spark, sf).select("doc_id", clean_text("text").alias("clean"))


@register("extract_tokens", f"SELECT doc_id, array_to_string({sql_tokens(sql_words('text'))}, ',') AS tokens "
          "FROM documents")
def q_extract_tokens(spark, sf):
    d = _docs_text(spark, sf).select("doc_id", clean_text("text").alias("clean"))
    out = extract_tokens(d, "clean", KW_ROWS_DICT, "tokens")
    return out.select("doc_id", F.array_join("tokens", ",").alias("tokens"))


KW_ROWS_DICT = {**TEST_KEYWORDS, **{w: [w] for w in TEST_GENERAL}}


@register("generalise_tokens", f"SELECT doc_id, array_to_string("
          f"{sql_generalise(sql_tokens(sql_words('text')))}, ',') AS tokens FROM documents")
def q_generalise(spark, sf):
    d = _docs_text(spark, sf).select("doc_id", words("text").alias("w"))
    tok = tags_of_words(F.col("w"), KW_ROWS)
    return d.select("doc_id", F.array_join(generalise_tokens(tok, TEST_GENERAL), ",").alias("tokens"))


KW_SEARCH_SQL = _sql_str_list(sorted(set(TEST_SEARCH_KEYWORDS)))
PIECES_SQL = r"""(SELECT doc_id, CASE WHEN len(pc) > 0 AND regexp_matches(pc[1], '^[^\p{L}\p{N}_]')
    THEN pc[2:] ELSE pc END AS pc
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS pc FROM documents))"""
# n-grams by position: piece i (odd = word start) joined with the next 2, 4, 6 pieces
KW_FOUND_SQL = f"""WITH p AS (SELECT doc_id, unnest(pc) AS piece, unnest(range(1, len(pc) + 1)) AS i FROM {PIECES_SQL}),
  g AS (SELECT doc_id, i, piece AS g1,
      piece || lead(piece, 1) OVER w || lead(piece, 2) OVER w AS g2,
      piece || lead(piece, 1) OVER w || lead(piece, 2) OVER w || lead(piece, 3) OVER w || lead(piece, 4) OVER w AS g3,
      piece || lead(piece, 1) OVER w || lead(piece, 2) OVER w || lead(piece, 3) OVER w || lead(piece, 4) OVER w
        || lead(piece, 5) OVER w || lead(piece, 6) OVER w AS g4
      FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
  hits AS (SELECT doc_id, gram FROM (SELECT doc_id, i, unnest([g1, g2, g3, g4]) AS gram FROM g)
           WHERE i % 2 = 1 AND list_contains({KW_SEARCH_SQL}, gram)),
  f AS (SELECT doc_id, list_sort(list(DISTINCT gram)) AS f FROM hits GROUP BY doc_id)
  SELECT d.doc_id, coalesce(array_to_string(f.f, ','), '') AS words_found, f.f[1] AS word_found
  FROM documents d LEFT JOIN f USING (doc_id) WHERE d.text IS NOT NULL"""


@register("kw_filter", f"SELECT * FROM ({KW_FOUND_SQL}) WHERE words_found <> ''")
def q_kw_filter(spark, sf):
    out = kw_filter(_docs_text(spark, sf), "text", TEST_SEARCH_KEYWORDS)
    return out.select("doc_id", F.array_join("words_found", ",").alias("words_found"), "word_found")


@register("find_keywords", KW_FOUND_SQL)
def q_find_keywords(spark, sf):
    out = find_keywords(_docs_text(spark, sf), "text", TEST_SEARCH_KEYWORDS)
    return out.select("doc_id", F.array_join("words_found", ",").alias("words_found"), "word_found")


@register("lexicon_score", f"""SELECT doc_id, s AS score, CASE WHEN s > 0 THEN 1 WHEN s < 0 THEN -1 END AS label
    FROM (SELECT doc_id, {sql_lex(sql_words('text'))} AS s FROM documents)""")
def q_lexicon(spark, sf):
    d = _docs_text(spark, sf).select("doc_id", lexicon_score(words("text"), TEST_LEXICON).alias("score"))
    return d.withColumn("label", sign_label(F.col("score")))


TFIDF_SQL = r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
  nd AS (SELECT count(DISTINCT doc_id) AS n FROM documents),
  dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  w AS (SELECT tf.doc_id, tf.term, tf.tf, dfq.df, tf.tf * (ln((1.0 + nd.n) / (1.0 + dfq.df)) + 1.0) AS raw
        FROM tf JOIN dfq USING (term), nd)
  SELECT doc_id, term, tf, df, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w"""


@register("tfidf", TFIDF_SQL)
def q_tfidf(spark, sf):
    out = tfidf(_docs_text(spark, sf), "doc_id", "text")
    return out.withColumn("tfidf", F.round("tfidf", 6))


# --------------------------------------------------------------- labels
@register("class_counts", """SELECT 'quality' AS label_name, quality AS value, count(*) AS n FROM labels GROUP BY 2
    UNION ALL SELECT 'toxic', toxic, count(*) FROM labels GROUP BY 2""")
def q_class_counts(spark, sf):
    lb = B.read(spark, sf, "labels")
    q = class_counts(lb, "quality").select(F.lit("quality").alias("label_name"),
                                            F.col("quality").alias("value"), "n")
    t = class_counts(lb, "toxic").select(F.lit("toxic").alias("label_name"), F.col("toxic").alias("value"), "n")
    return q.unionByName(t)


B.add_cte("doc_pred", f"""SELECT l.doc_id, l.quality AS label,
    CASE WHEN {sql_lex(sql_words('d.text'))} >= 0 THEN 1 ELSE 0 END AS prediction
    FROM labels l JOIN documents d USING (doc_id)""")


B.add_cte("cr_k", "SELECT * FROM (VALUES (0), (1)) v(c)")
B.add_cte("cr_per", """SELECT CAST(k.c AS VARCHAR) AS class,
    count(*) FILTER (WHERE label = k.c AND prediction = k.c) AS tp,
    count(*) FILTER (WHERE label <> k.c AND prediction = k.c) AS fp,
    count(*) FILTER (WHERE label = k.c AND prediction <> k.c) AS fn, count(*) AS total
    FROM cr_k k, doc_pred GROUP BY k.c""", ["cr_k", "doc_pred"])
B.add_cte("cr_f", """SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM (
    SELECT class, tp, total, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall, tp + fn AS support FROM cr_per)""", ["cr_per"])


@register("class_report", with_ctes(["cr_f"], """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
    round(f1, 6) AS f1, support FROM cr_f
  UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / max(total), 6), CAST(sum(support) AS BIGINT) FROM cr_f
  UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM cr_f
  UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
    round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM cr_f"""))
def q_class_report(spark, sf):
    d = _docs_text(spark, sf)
    lb = B.read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    p = lb.join(d, "doc_id").select(
        "doc_id", "label",
        F.when(lexicon_score(words("text"), TEST_LEXICON) >= 0, 1).otherwise(0).alias("prediction"))
    r = class_report(p, "label", "prediction", (0, 1))
    return r.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("long").alias("support"))


@register("union_labelled", """SELECT doc_id, 'positive_source' AS origin, 1 AS label FROM labels JOIN documents USING (doc_id)
    WHERE quality = 1 AND text IS NOT NULL
    UNION ALL SELECT doc_id, 'negative_source', 0 FROM labels JOIN documents USING (doc_id)
    WHERE toxic = 1 AND text IS NOT NULL""")
def q_union_labelled(spark, sf):
    lb = B.read(spark, sf, "labels")
    d = _docs(spark, sf).select("doc_id", "text")
    pos = lb.filter("quality = 1").join(d, "doc_id").select("doc_id", "text")
    neg = lb.filter("toxic = 1").join(d, "doc_id").select("doc_id", "text")
    return labelled_corpus(pos, neg).select("doc_id", "origin", "label")


# --------------------------------------------------------------- THR
def thr_items(spark, sf) -> DataFrame:
    """THR rows, cleaned and labelled: tokens (test dictionary), lexicon score,
    label = its sign."""
    t = B.thr(spark, sf)
    w = words("text")
    return t.select("*", F.array_join(w, " ").alias("clean"), tags_of_words(w, KW_ROWS).alias("tokens"),
                    lexicon_score(w, TEST_LEXICON).alias("lex")).withColumn("label", sign_label(F.col("lex")))


B.add_cte("thr_items", f"""SELECT *, array_to_string({sql_words('text')}, ' ') AS clean,
    {sql_tokens(sql_words('text'))} AS tokens, {sql_lex(sql_words('text'))} AS lex,
    CASE WHEN {sql_lex(sql_words('text'))} > 0 THEN 1 WHEN {sql_lex(sql_words('text'))} < 0 THEN -1 END AS label
    FROM thr""", ["thr"])
B.add_cte("thr_join", """SELECT c.submission_id, c.turn, c.ts, c.label, c.tokens AS c_tokens, s.tokens AS s_tokens
    FROM (SELECT * FROM thr_items WHERE turn > 0) c
    LEFT JOIN (SELECT * FROM thr_items WHERE turn = 0) s ON c.submission_id = s.submission_id""", ["thr_items"])
B.add_cte("thr_union", """SELECT submission_id, turn, ts, label,
    list_sort(list_filter(list_distinct(list_concat(coalesce(c_tokens, []), coalesce(s_tokens, []))),
    lambda x: x IS NOT NULL AND x <> '')) AS tokens FROM thr_join""", ["thr_join"])


def _thread_join(spark, sf):
    it = thr_items(spark, sf)
    comments = it.filter("turn > 0").select("submission_id", "turn", "ts", "label", F.col("tokens").alias("c_tokens"))
    # only what the child needs of its parent goes through the shuffle
    subs = unique_parent(it.filter("turn = 0").select("submission_id", "turn", "tokens"), "submission_id", ["turn"]).select(
        "submission_id", F.col("tokens").alias("s_tokens"))
    return comments.join(subs, "submission_id", "left")


def _thread_union(spark, sf):
    j = _thread_join(spark, sf)
    return j.select("submission_id", "turn", "ts", "label", union_tokens("c_tokens", "s_tokens").alias("tokens"))


@register("thread_join", with_ctes(["thr_join"], """SELECT submission_id, turn, array_to_string(c_tokens, ',') AS c_tokens,
    array_to_string(s_tokens, ',') AS s_tokens FROM thr_join"""))
def q_thread_join(spark, sf):
    j = _thread_join(spark, sf)
    return j.select("submission_id", "turn", F.array_join("c_tokens", ",").alias("c_tokens"),
                    F.array_join("s_tokens", ",").alias("s_tokens"))


@register("union_tokens", with_ctes(["thr_union"], """SELECT submission_id, turn,
    array_to_string(tokens, ',') AS tokens FROM thr_union"""))
def q_union_tokens(spark, sf):
    u = _thread_union(spark, sf)
    return u.select("submission_id", "turn", F.array_join("tokens", ",").alias("tokens"))


@register("explode_tokens", with_ctes(["thr_union"], """SELECT submission_id, turn, token FROM
    (SELECT submission_id, turn, unnest({0}) AS token FROM thr_union)""".format(
    sql_generalise("tokens"))))
def q_explode_tokens(spark, sf):
    u = _thread_union(spark, sf).withColumn("tokens", generalise_tokens("tokens", TEST_GENERAL))
    return explode_tokens(u, "tokens", "token").select("submission_id", "turn", "token")


@register("thread_sentiment", with_ctes(["thr_union"], """SELECT ts, token,
    count(*) FILTER (WHERE label = -1) AS count_negative, count(*) FILTER (WHERE label = 1) AS count_positive,
    count(*) AS count_total FROM (SELECT ts, label, unnest({0}) AS token FROM thr_union)
    WHERE label IN (-1, 1) GROUP BY ts, token""".format(sql_generalise("tokens"))))
def q_thread_sentiment(spark, sf):
    return thread_sentiment(spark, sf)


def thread_sentiment(spark, sf) -> DataFrame:
    """E9 = J3 + R1 + T7 + R2 + A1: hourly label counts per token over threads."""
    u = _thread_union(spark, sf).withColumn("tokens", generalise_tokens("tokens", TEST_GENERAL))
    return label_pivot(explode_tokens(u, "tokens", "token"), "ts", "token", "label")


@register("filter_moderation", with_ctes(["thr"], """SELECT submission_id, turn FROM thr
    WHERE distinguished IS DISTINCT FROM 'moderator'
      AND text NOT IN ('deleted', 'removed', '[deleted]', '[removed]')"""))
def q_filter_moderation(spark, sf):
    t = B.thr(spark, sf)
    keep = (~F.col("distinguished").eqNullSafe("moderator")
            & ~F.col("text").isin("deleted", "removed", "[deleted]", "[removed]"))
    return t.filter(keep).select("submission_id", "turn")


@register("concat_text", with_ctes(["thr"], """SELECT s.submission_id,
    concat_ws(' ', coalesce(s.text, ''), coalesce(c.text, '')) AS full_text
    FROM (SELECT * FROM thr WHERE turn = 0) s LEFT JOIN (SELECT * FROM thr WHERE turn = 1) c
    ON s.submission_id = c.submission_id"""))
def q_concat_text(spark, sf):
    t = B.thr(spark, sf)
    s = t.filter("turn = 0").select("submission_id", F.col("text").alias("title"))
    c = t.filter("turn = 1").select("submission_id", F.col("text").alias("description"))
    return s.join(c, "submission_id", "left").select(
        "submission_id", concat_text("title", "description").alias("full_text"))


B.add_cte("pick_src", f"""SELECT submission_id,
    CASE WHEN lt > 0 THEN 1 WHEN lt < 0 THEN -1 END AS text_label,
    abs(lt) / CAST(greatest(len({sql_words('text')}), 1) AS DOUBLE) AS text_score,
    CASE WHEN lh > 0 THEN 1 WHEN lh < 0 THEN -1 END AS title_label,
    abs(lh) / CAST(greatest(len({sql_words("split_part(text, chr(10), 1)")}), 1) AS DOUBLE) AS title_score
    FROM (SELECT *, {sql_lex(sql_words('text'))} AS lt,
                 {sql_lex(sql_words("split_part(text, chr(10), 1)"))} AS lh FROM thr WHERE turn = 0)""", ["thr"])


@register("pick_better", with_ctes(["pick_src"], """SELECT submission_id,
    CASE WHEN text_score IS NULL THEN title_label WHEN title_score IS NULL THEN text_label
         WHEN text_score >= title_score THEN text_label ELSE title_label END AS label,
    CASE WHEN text_score IS NULL THEN title_score WHEN title_score IS NULL THEN text_score
         WHEN text_score >= title_score THEN text_score ELSE title_score END AS score
    FROM pick_src"""))
def q_pick_better(spark, sf):
    t = B.thr(spark, sf).filter("turn = 0")
    title = F.split(F.col("text"), "\n").getItem(0)
    wt, wh = words("text"), words(title)
    lt, lh = lexicon_score(wt, TEST_LEXICON), lexicon_score(wh, TEST_LEXICON)
    s = t.select("submission_id",
                 sign_label(lt).alias("tl"), (F.abs(lt) / F.greatest(F.size(wt), F.lit(1)).cast("double")).alias("ts_"),
                 sign_label(lh).alias("hl"), (F.abs(lh) / F.greatest(F.size(wh), F.lit(1)).cast("double")).alias("hs"))
    best = pick_better("tl", "ts_", "hl", "hs")
    return s.select("submission_id", best["label"].alias("label"), best["score"].alias("score"))


# --------------------------------------------------------------- large dictionary
def benchmark_dictionary(spark, sf) -> DataFrame:
    """A dictionary built from data by a rule: the distinct words of seven or
    more characters in the ``benchmark`` texts (1,608 at sf0.1)."""
    bm = B.read(spark, sf, "benchmark")
    w = bm.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), 0)).alias("keyword"))
    return w.filter(F.length("keyword") >= 7).distinct().select(F.col("keyword").alias("tag"), "keyword")


KW_DICT_SQL = r"""WITH dict AS (SELECT DISTINCT w AS keyword FROM (
      SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM benchmark) WHERE length(w) >= 7),
  hits AS (SELECT doc_id, w FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w
           FROM documents) WHERE w IN (SELECT keyword FROM dict)),
  f AS (SELECT doc_id, list_sort(list(DISTINCT w)) AS f FROM hits GROUP BY doc_id)
  SELECT doc_id, array_to_string(f, ',') AS words_found, f[1] AS word_found FROM f"""


@register("kw_filter_dict", KW_DICT_SQL)
def q_kw_filter_dict(spark, sf):
    """F6/T6 with a dictionary of data-derived size (size-checked: a plan
    constant up to MAX_LITERAL_ENTRIES, else the join path)."""
    docs = _docs_text(spark, sf)
    out = kw_filter(docs, "text", benchmark_dictionary(spark, sf))
    return out.select("doc_id", F.array_join("words_found", ",").alias("words_found"), "word_found")


@register("kw_filter_long", r"""WITH dict AS (SELECT DISTINCT regexp_extract(lower(text), '^[\p{L}\p{N}_]+([^\p{L}\p{N}_]+[\p{L}\p{N}_]+){4}') AS keyword
    FROM benchmark), f AS (SELECT doc_id, list_sort(list(keyword)) AS f FROM documents JOIN dict ON keyword <> '' AND
    regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])' || regexp_escape(keyword) || '($|[^\p{L}\p{N}_])') GROUP BY doc_id)
    SELECT doc_id, array_to_string(f, '|') AS words_found, f[1] AS word_found FROM f""")
def q_kw_filter_long(spark, sf):
    """T6 with keywords of five words (the opening words of the benchmark texts)."""
    five = F.regexp_extract(F.lower("text"), r"^[\p{L}\p{N}_]+([^\p{L}\p{N}_]+[\p{L}\p{N}_]+){4}", 0).alias("keyword")
    words_5 = B.read(spark, sf, "benchmark").select(five).filter("keyword <> ''").distinct()
    out = kw_filter(_docs_text(spark, sf), "text", words_5.withColumn("tag", F.col("keyword")))
    return out.select("doc_id", F.array_join("words_found", "|").alias("words_found"), "word_found")


@register("kw_dict_large", r"""WITH dict AS (SELECT DISTINCT w FROM (
      SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM conversations) WHERE length(w) >= 3),
  d AS (SELECT doc_id % 50 AS id, row_number() OVER () AS r, text FROM documents),
  hits AS (SELECT DISTINCT r, w FROM (SELECT r, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM d)
           WHERE w IN (SELECT w FROM dict)),
  f AS (SELECT r, list_sort(list(w)) AS f FROM hits GROUP BY r)
  SELECT id, md5(text) AS text_md5, coalesce(array_to_string(f, ','), '') AS words_found FROM d LEFT JOIN f USING (r)""")
def q_kw_dict_large(spark, sf):
    """T6 with a dictionary too large for the plan (every longer word of the conversations) over rows
    that share ids: a row's keywords come from its own text."""
    w = B.read(spark, sf, "conversations").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), 0)).alias("keyword"))
    table = w.filter(F.length("keyword") >= 3).distinct().withColumn("tag", F.col("keyword"))
    docs = B.read(spark, sf, "documents").select((F.col("doc_id") % 50).alias("id"), "text")
    out = find_keywords(docs, "text", table)
    return out.select("id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.array_join("words_found", ",").alias("words_found"))


# --------------------------------------------------------------- news path
B.add_cte("articles", f"""SELECT DISTINCT ts, token, clean_text, label FROM (
    SELECT ts, unnest({sql_tokens("string_split(clean_text, ' ')")}) AS token, clean_text,
      CASE WHEN {sql_lex("list_filter(string_split(clean_text, ' '), lambda x: x <> '')")} > 0 THEN 1
           WHEN {sql_lex("list_filter(string_split(clean_text, ' '), lambda x: x <> '')")} < 0 THEN -1 END AS label
    FROM (SELECT ts, {B.sql_clean("concat_ws(' ', coalesce(split_part(text, chr(10), 1), ''), "
                                  "coalesce(substr(text, length(split_part(text, chr(10), 1)) + 2), ''))")} AS clean_text
          FROM thr WHERE turn = 0))""", ["thr"])


@register("news_daily", with_ctes(["articles"], """SELECT CAST(ts AS DATE) AS date, upper(token) AS token,
    count(*) FILTER (WHERE label = 1) AS count_positive, count(*) FILTER (WHERE label = -1) AS count_negative,
    count(*) FILTER (WHERE label IN (-1, 1)) AS total_count,
    round(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / CAST(count(*) FILTER (WHERE label IN (-1, 1)) AS DOUBLE) * 100.0, 6)
      AS percentage_positive
    FROM articles WHERE label IN (-1, 1) GROUP BY 1, 2"""))
def q_news_daily(spark, sf):
    """A4 fed by the news path: first line = title, the rest = description."""
    from .composed import label_articles
    from ..operators.rollup import sentiment_daily
    t = B.thr(spark, sf).filter("turn = 0")
    first = F.split(F.col("text"), "\n").getItem(0)
    rest = F.substring(F.col("text"), F.length(first) + 2, 1 << 30)
    arts = label_articles(t.select("ts", first.alias("title"), rest.alias("description")), "ts",
                          "title", "description", KW_ROWS_DICT, lexicon=TEST_LEXICON)
    out = sentiment_daily(arts, "ts", "token", "label")
    return out.withColumn("percentage_positive", F.round("percentage_positive", 6))
