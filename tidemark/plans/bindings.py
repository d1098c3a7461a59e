"""§2.0 bindings: how each operator's inputs are built from the driver tables.

Each binding is a Spark function ``(spark, sf_dir) -> DataFrame`` and, next to
it, the same construction as a DuckDB CTE so oracle SQL can reuse it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import TEST_KEYWORDS, TEST_GENERAL, TEST_LEXICON, STOPWORDS_EN
from ..functions.dates import floor_hour
from ..session import configure, stored

N_TOKENS = 8
VOL_LO, VOL_HI = 225_000.0, 50_000_000.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _token_of_user() -> F.Column:
    return F.concat(F.lit("T"), (F.col("user_id") % N_TOKENS).cast("string"))


# ---------------------------------------------------------------- base --------
def events_base(spark, sf_dir) -> DataFrame:
    """The one pass over the raw events every market-side binding derives from:
    per (token, hour, label) the exact sum of values in cents and the count.
    A hot token costs one partial row per task (map-side aggregation)."""
    ev = read(spark, sf_dir, "events")
    return (ev.select(_token_of_user().alias("token"), floor_hour("ts").alias("ts"),
                      _label().alias("label"),
                      F.round(F.col("value") * F.lit(100.0)).cast("long").alias("_c"))
            .groupBy("token", "ts", "label")
            .agg(F.sum("_c").alias("cents"), F.count(F.lit(1)).alias("n")))


def _label() -> F.Column:
    return (F.when(F.col("event_type").isin("purchase", "signup"), F.lit(1))
            .when(F.col("event_type") == "error", F.lit(-1)))


def micro_mean(cents: str, n: str) -> F.Column:
    """cents / n / 100 rounded half-up to 6 places, in exact integer arithmetic
    (same value on any engine and plan), returned as a double."""
    return F.expr(f"CAST(((2 * {cents} * 10000 + {n}) div (2 * {n})) AS DOUBLE) / 1000000.0")


# ---------------------------------------------------------------- MKT ---------
def mkt(spark, sf_dir, base: DataFrame | None = None) -> DataFrame:
    """Hourly market series per token: price (mean value), volume (sum), n."""
    b = base if base is not None else events_base(spark, sf_dir)
    g = b.groupBy("token", "ts").agg(F.sum("cents").alias("_c"), F.sum("n").alias("n"))
    return g.select("token", "ts", micro_mean("_c", "n").alias("price"),
                    (F.col("_c").cast("double") / F.lit(100.0)).alias("volume"), "n")


def _events(sf_dir) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/events.parquet"]


def base_table(spark, sf_dir) -> DataFrame:
    """The events rollup as a stored table: the only pass over raw events."""
    return stored(spark, "events_base", sf_dir, lambda: events_base(spark, sf_dir), _events(sf_dir))


def mkt_table(spark, sf_dir) -> DataFrame:
    """MKT as a stored table (built from the stored rollup; see session.stored)."""
    return stored(spark, "mkt", sf_dir, lambda: mkt(spark, sf_dir, base_table(spark, sf_dir)), _events(sf_dir))


# ---------------------------------------------------------------- DAY ---------
def day(spark, sf_dir, base: DataFrame | None = None) -> DataFrame:
    """Daily series per token: d, metric (mean value), n_day."""
    b = base if base is not None else events_base(spark, sf_dir)
    g = (b.groupBy("token", F.to_date("ts").alias("d"))
         .agg(F.sum("cents").alias("_c"), F.sum("n").alias("n_day")))
    return g.select("token", "d", micro_mean("_c", "n_day").alias("metric"), "n_day")


def day_table(spark, sf_dir) -> DataFrame:
    """DAY as a stored table."""
    return stored(spark, "day", sf_dir, lambda: day(spark, sf_dir, base_table(spark, sf_dir)), _events(sf_dir))


def sent_counts(base: DataFrame) -> DataFrame:
    """Labelled counts per (ts, token, label) from the base rollup."""
    return base.filter(F.col("label").isNotNull()).select("ts", "token", "label", "n")


def day_metric_long(spark, sf_dir) -> DataFrame:
    """S9 analogue: one (d, token, metric, value) row per landed metric value;
    each event type plays one metric file per coin."""
    ev = read(spark, sf_dir, "events")
    return (ev.select(_token_of_user().alias("token"), F.to_date("ts").alias("d"),
                      F.col("event_type").alias("metric"), "value")
            .groupBy("d", "token", "metric").agg(F.round(F.avg("value"), 6).alias("value")))


# ---------------------------------------------------------------- SENT --------
def sent(spark, sf_dir) -> DataFrame:
    """Labelled items: purchase/signup = 1, error = -1, view/click unlabelled."""
    ev = read(spark, sf_dir, "events")
    return ev.select("event_id", _token_of_user().alias("token"),
                     F.date_trunc("hour", "ts").alias("ts"), F.col("ts").alias("event_ts"),
                     _label().alias("label"))


# ---------------------------------------------------------------- THR ---------
def thr(spark, sf_dir) -> DataFrame:
    """Threads: conv_id = submission, turn 0 its text, turns > 0 comments."""
    from ..sources.readers import spread
    cv = spread(read(spark, sf_dir, "conversations"))
    dist = (F.when(F.col("role") == "system", F.lit("moderator"))
            .when(F.col("role") == "assistant", F.lit("special")))
    ts = (F.to_timestamp(F.lit("2024-01-01 00:00:00"))
          + F.make_dt_interval(F.lit(0), (F.col("conv_id") % 24).cast("int")))
    return cv.select(F.col("conv_id").alias("submission_id"), "turn", "role", "text",
                     dist.alias("distinguished"), ts.alias("ts"))


# ---------------------------------------------------------------- VOL ---------
def vol(spark, sf_dir) -> DataFrame:
    """Daily volume per supplier (plays a coin's daily volume)."""
    li = read(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_suppkey").alias("supplier"), F.to_date("l_shipdate").alias("d"))
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("volume")))


# ---------------------------------------------------------------- PRED --------
def pred(spark, sf_dir) -> DataFrame:
    """Two naive models over MKT in long form (token, ts, model, prediction, actual):
    A = previous hour's price, B = mean of the 24 previous prices."""
    from ..operators.series import lags, rolling_mean
    m = mkt_table(spark, sf_dir).select("token", "ts", "price")
    a = lags(m, "token", "ts", "price", [1], prefix="_a")
    b = rolling_mean(a, "token", "ts", ["price"], 24, include_current=False, suffix="_b", scale=6)
    wide = b.select("token", "ts", F.col("price").alias("actual"),
                    F.col("_a1").alias("model_a"), F.col("price_b").alias("model_b"))
    return wide.select("token", "ts", "actual", F.expr(
        "stack(2, 'model_a', model_a, 'model_b', model_b) AS (model, prediction)"))


# ============================================================ SQL twins =======
def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


STOP_SQL = _sql_list(sorted(set(STOPWORDS_EN)))
# Same pattern strings as constants.py, for DuckDB's RE2.
SYM_RE = r"[^\p{L}\p{N}_\p{Z}\s\x0b\x1c-\x1f\x{85}]"
SPLIT_RE = r"[\p{Z}\s\x0b\x1c-\x1f\x{85}]+"


def sql_words(text: str) -> str:
    """DuckDB twin of functions.text.words."""
    return (f"list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace({text}, "
            rf"'http\S+', '', 'g'), '{SYM_RE}', '', 'g')), '{SPLIT_RE}'), "
            f"lambda w: w <> '' AND NOT list_contains({STOP_SQL}, w))")


def sql_clean(text: str) -> str:
    return f"array_to_string({sql_words(text)}, ' ')"


KW_SQL_ROWS = ", ".join(
    [f"('{s}', '{w}')" for s, ws in TEST_KEYWORDS.items() for w in ws]
    + [f"('{w}', '{w}')" for w in TEST_GENERAL])
LEX_SQL_ROWS = ", ".join(f"('{w}', {v})" for w, v in TEST_LEXICON.items())

CTES = {
    "mkt": ("""SELECT token, ts, CAST((2 * c * 10000 + n) // (2 * n) AS DOUBLE) / 1000000.0 AS price,
        CAST(c AS DOUBLE) / 100.0 AS volume, n FROM (
        SELECT 'T' || CAST(user_id % 8 AS VARCHAR) AS token, date_trunc('hour', ts) AS ts,
        CAST(sum(CAST(round(value * 100.0) AS BIGINT)) AS BIGINT) AS c, count(*) AS n
        FROM events GROUP BY 1, 2)""", []),
    "day": ("""SELECT token, d, CAST((2 * c * 10000 + n_day) // (2 * n_day) AS DOUBLE) / 1000000.0 AS metric,
        n_day FROM (SELECT 'T' || CAST(user_id % 8 AS VARCHAR) AS token, CAST(ts AS DATE) AS d,
        CAST(sum(CAST(round(value * 100.0) AS BIGINT)) AS BIGINT) AS c, count(*) AS n_day
        FROM events GROUP BY 1, 2)""", []),
    "metric_long": ("""SELECT CAST(ts AS DATE) AS d, 'T' || CAST(user_id % 8 AS VARCHAR) AS token,
        event_type AS metric, round(avg(value), 6) AS value FROM events GROUP BY 1, 2, 3""", []),
    "sent": ("""SELECT event_id, 'T' || CAST(user_id % 8 AS VARCHAR) AS token,
        date_trunc('hour', ts) AS ts, ts AS event_ts,
        CASE WHEN event_type IN ('purchase', 'signup') THEN 1 WHEN event_type = 'error' THEN -1 END AS label
        FROM events""", []),
    "thr": ("""SELECT conv_id AS submission_id, turn, role, text,
        CASE WHEN role = 'system' THEN 'moderator' WHEN role = 'assistant' THEN 'special' END AS distinguished,
        TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(conv_id % 24 AS INTEGER)) AS ts
        FROM conversations""", []),
    "vol": ("""SELECT l_suppkey AS supplier, CAST(l_shipdate AS DATE) AS d,
        round(sum(l_extendedprice), 2) AS volume FROM lineitem GROUP BY 1, 2""", []),
    "kw": (f"SELECT * FROM (VALUES {KW_SQL_ROWS}) AS t(tag, keyword)", []),
    "lex": (f"SELECT * FROM (VALUES {LEX_SQL_ROWS}) AS t(word, weight)", []),
    "pred_wide": ("""SELECT token, ts, price AS actual,
        lag(price, 1) OVER w AS model_a,
        CASE WHEN count(price) OVER w24 >= 24 THEN
          CAST(sum(CAST(round(price * 1000000.0) AS BIGINT)) OVER w24 AS DOUBLE)
          / CAST(count(price) OVER w24 AS DOUBLE) / 1000000.0 END AS model_b
        FROM mkt WINDOW w AS (PARTITION BY token ORDER BY ts),
        w24 AS (PARTITION BY token ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""", ["mkt"]),
    "pred": ("""SELECT token, ts, actual, 'model_a' AS model, model_a AS prediction FROM pred_wide
        UNION ALL SELECT token, ts, actual, 'model_b' AS model, model_b AS prediction FROM pred_wide""",
             ["pred_wide"]),
}


def with_ctes(names, body: str) -> str:
    """``WITH`` clause holding the named CTEs (and what they depend on) + body."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)
    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


def add_cte(name: str, sql: str, deps=()) -> None:
    CTES[name] = (sql, list(deps))
