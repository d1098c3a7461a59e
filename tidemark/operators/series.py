"""Per-key time-series windows (W1-W12, L3) that stay bounded under skew.

A plain ``Window.partitionBy(token)`` sends every row of a token to one task; a
token may hold a third of all rows. Instead each key's series is cut into
*segments* of about ``seg_rows`` consecutive rows:

1. each key's time range is cut into coarse buckets, as many as its row count
   asks for (``BUCKETS_PER_SEGMENT`` to a segment), and rows are counted per
   bucket: a table of about rows / 1,000 rows, whatever the data's time grain;
2. a running sum over that small table gives each bucket's first row position,
   and buckets are grouped into segments by that position;
3. rows whose positions fall in the ``halo`` rows before a segment are copied
   into it as read-only context;
4. one shuffle on (key, segment) and the window runs per segment.

Row frames of up to ``halo`` rows back then see exactly the rows a whole-series
window would see. Unbounded frames (forward/backward fill, interpolation) use
a second small table of per-segment last/first known values that is carried
across segments by a window over that small table.

Rows with a null key form a series of their own; rows with a null time stand
before all others of their key. Rows of a key within one bucket stay together:
a burst of BUCKETS_PER_SEGMENT times the key's average rate fills a segment by
itself.

With the default segment size, every test series is one segment and the plan
is a single exchange on (key, segment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SEG_ROWS = 1 << 16          # rows per segment
BUCKETS_PER_SEGMENT = 64    # time buckets counted per segment of a key
RUN_STEPS = 1024            # grid steps one row is expanded to at most

_H = ["_b", "_start", "_seg", "_tseg", "_halo", "_pos"]


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _order_cols(ts: str, order: Sequence[str]) -> list[Column]:
    return [F.col(ts)] + [F.col(o) for o in order]


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _with_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on ``on`` where null equals null; ``right`` adds its other columns."""
    r = right.withColumnsRenamed({k: f"_on_{i}" for i, k in enumerate(on)})
    cond = None
    for i, k in enumerate(on):
        eq = F.col(k).eqNullSafe(F.col(f"_on_{i}"))
        cond = eq if cond is None else cond & eq
    return left.join(r, cond, "left").drop(*[f"_on_{i}" for i in range(len(on))])


def segmented(df: DataFrame, key, ts: str, order: Sequence[str] = (), halo: int = 0,
              seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None):
    """Return ``(rows, spec)``: ``rows`` has every input row once as an own row
    (``_halo`` false) plus copies as context rows of later segments; ``spec`` is
    the window partitioned by (key, segment) and ordered by (ts, order...).
    Also adds ``_pos``, the 0-based row position of the row within its key.

    (ts, order...) must be a total order within a key, so that a recomputed
    task (e.g. after an executor is lost) numbers rows the same way. The input
    is read in two small passes (range and count per key, rows per bucket) and
    a row pass: give it a stored table when it is expensive to recompute. A
    fixed ``bucket_seconds`` replaces the first pass."""
    keys = _keys(key)
    m = _micros(ts)
    if bucket_seconds is None:
        ranges = df.groupBy(*keys).agg(F.min(m).alias("_lo"), F.max(m).alias("_hi"), F.count(F.lit(1)).alias("_n"))
        buckets = F.ceil(F.col("_n") / F.lit(seg_rows)) * F.lit(BUCKETS_PER_SEGMENT)
        one = F.col("_n") <= seg_rows                     # a key of one segment is one bucket
        ranges = ranges.withColumn("_width", F.when(one, F.lit(1 << 62)).otherwise(
            F.floor((F.col("_hi") - F.col("_lo")) / buckets) + 1)).drop("_hi", "_n")
        b = _with_keys(df, ranges, keys).withColumn(
            "_b", F.expr("(unix_micros(cast(`%s` as timestamp)) - _lo) div _width" % ts)).drop("_lo", "_width")
    else:
        b = df.withColumn("_b", F.floor(m / F.lit(int(bucket_seconds) * 1_000_000)).cast("long"))
    counts = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    counts = (counts
              .withColumn("_start", F.sum("_cnt").over(wk) - F.col("_cnt"))
              .withColumn("_seg", F.floor(F.col("_start") / F.lit(seg_rows)).cast("long")))
    # last segment this bucket's rows must reach as context
    reach = F.floor((F.col("_start") + F.col("_cnt") + F.lit(halo - 1)) / F.lit(seg_rows)).cast("long")
    targets = (F.sequence(F.col("_seg"), F.greatest(F.col("_seg"), reach)) if halo > 0
               else F.array(F.col("_seg")))
    counts = counts.select(*keys, "_b", "_start", "_seg", targets.alias("_targets"))
    rows = (_with_keys(b, counts, keys + ["_b"])
            .withColumn("_tseg", F.explode("_targets"))
            .withColumn("_halo", F.col("_tseg") != F.col("_seg"))
            .drop("_targets"))
    spec = Window.partitionBy(*keys, "_tseg").orderBy(*_order_cols(ts, order))
    whole = Window.partitionBy(*keys, "_tseg")
    rows = rows.withColumn(
        "_pos", F.min("_start").over(whole) + F.row_number().over(spec) - F.lit(1))
    return rows, spec


def own_rows(rows: DataFrame) -> DataFrame:
    """Drop the context copies and helper columns."""
    return rows.filter(~F.col("_halo")).drop(*[c for c in _H if c in rows.columns])


def with_position(df: DataFrame, key, ts: str, order: Sequence[str] = (), out: str = "pos",
                  seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """0-based row number within key by (ts, order...), computed without a
    whole-key window."""
    rows, _ = segmented(df, key, ts, order, 0, seg_rows, bucket_seconds)
    return own_rows(rows.withColumn(out, F.col("_pos")))


# --------------------------------------------------------------- row frames ---

def lag_array(df: DataFrame, key, ts: str, c: str, k: int, order: Sequence[str] = (),
              out: str = "lags", seg_rows: int = SEG_ROWS,
              bucket_seconds: int | None = None) -> DataFrame:
    """``out`` = [lag 1, lag 2, .., lag k] of ``c`` as one array, null until k
    earlier non-null values exist (a null inside the k rows also gives null,
    like a row with a missing lag). One array window instead of k lag columns."""
    rows, spec = segmented(df, key, ts, order, k, seg_rows, bucket_seconds)
    frame = spec.rowsBetween(-k, -1)
    lst = F.collect_list(F.col(c)).over(frame)
    n_rows = F.count(F.lit(1)).over(frame)
    rows = rows.withColumn(out, F.when((F.size(lst) == k) & (n_rows == k), F.reverse(lst)))
    return own_rows(rows)


def lags(df: DataFrame, key, ts: str, c: str, ks: Sequence[int], order: Sequence[str] = (),
         prefix: str | None = None, seg_rows: int = SEG_ROWS,
         bucket_seconds: int | None = None) -> DataFrame:
    """Single lag columns ``{prefix}{k}`` (few lags; use :func:`lag_array` for many)."""
    prefix = prefix or f"{c}_lag"
    rows, spec = segmented(df, key, ts, order, max(ks), seg_rows, bucket_seconds)
    for k in ks:
        rows = rows.withColumn(f"{prefix}{k}", F.lag(F.col(c), k).over(spec))
    return own_rows(rows)


def leads(df: DataFrame, key, ts: str, c: str, ks: Sequence[int], prefix: str | None = None,
          seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """Values ``k`` rows ahead (``{prefix}{k}``): a lag in reversed time, so it
    runs on the same bounded segments (the halo is taken from later rows)."""
    prefix = prefix or f"{c}_lead"
    rts = "_rts"
    rev = df.withColumn(rts, F.timestamp_micros(-F.unix_micros(F.col(ts).cast("timestamp"))))
    out = lags(rev, key, rts, c, ks, prefix=prefix, seg_rows=seg_rows, bucket_seconds=bucket_seconds)
    return out.drop(rts)


def rolling_mean(df: DataFrame, key, ts: str, cols: Sequence[str] | str, n: int,
                 min_rows: int | None = None, include_current: bool = True,
                 suffix: str | None = None, order: Sequence[str] = (),
                 seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None,
                 scale: int | None = None) -> DataFrame:
    """Mean of the last ``n`` rows (this row included unless
    ``include_current`` is false); null unless the frame has at least
    ``min_rows`` (default ``n``) non-null values.

    With ``scale`` (values known to have at most that many decimals) the sum
    is taken exactly over integers ``round(x * 10^scale)``, so the mean does
    not depend on summation order (stable across plans and engines)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    min_rows = n if min_rows is None else min_rows
    suffix = suffix or f"_ma{n}"
    halo = n if not include_current else n - 1
    rows, spec = segmented(df, key, ts, order, halo, seg_rows, bucket_seconds)
    frame = spec.rowsBetween(-(n - 1), 0) if include_current else spec.rowsBetween(-n, -1)
    for c in cols:
        cnt = F.count(F.col(c)).over(frame)
        if scale is None:
            mean = F.avg(F.col(c)).over(frame)
        else:
            units = F.round(F.col(c) * F.lit(10.0 ** scale)).cast("long")
            mean = F.try_divide(F.sum(units).over(frame).cast("double"), cnt.cast("double")) / F.lit(10.0 ** scale)
        rows = rows.withColumn(c + suffix, F.when(cnt >= min_rows, mean))
    return own_rows(rows)


def rolling_diff(df: DataFrame, key, ts: str, c: str, n: int = 7, order: Sequence[str] = (),
                 seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """W3 + A16: ``{c}_ma{n}`` = rolling mean of n rows (this one included),
    warm-up rows filled with the key's mean of ``c``; ``{c}_diff`` = first
    difference, 0 on the first row."""
    rows, spec = segmented(df, key, ts, order, n - 1, seg_rows, bucket_seconds)
    frame = spec.rowsBetween(-(n - 1), 0)
    ma = F.when(F.count(F.col(c)).over(frame) >= n, F.avg(F.col(c)).over(frame))
    rows = rows.withColumn(c + f"_ma{n}", ma).withColumn(
        c + "_diff", F.coalesce(F.col(c) - F.lag(F.col(c), 1).over(spec), F.lit(0.0)))
    out = own_rows(rows)
    keys = _keys(key)
    means = out.groupBy(*keys).agg(F.avg(c).alias("_fill"))
    return (_with_keys(out, means, keys)
            .withColumn(c + f"_ma{n}", F.coalesce(F.col(c + f"_ma{n}"), F.col("_fill")))
            .drop("_fill"))


def gaps(df: DataFrame, key, ts: str, step_seconds: int = 3600, order: Sequence[str] = (),
         seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """Rows whose distance to the previous row of the key exceeds one step.
    Returns key, ``prev_ts``, ``ts``, ``gap_seconds``."""
    keys = _keys(key)
    rows, spec = segmented(df.select(*keys, ts, *order), key, ts, order, 1, seg_rows, bucket_seconds)
    prev = F.lag(F.col(ts), 1).over(spec)
    secs = F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(prev.cast("timestamp"))
    rows = rows.withColumn("prev_ts", prev).withColumn("gap_seconds", secs)
    return own_rows(rows).filter(F.col("gap_seconds") > step_seconds).select(
        *keys, "prev_ts", ts, "gap_seconds")


def sequences(df: DataFrame, key, ts: str, cols: Sequence[str], target: str, length,
              order: Sequence[str] = (), seg_rows: int = SEG_ROWS,
              bucket_seconds: int | None = None, lengths: DataFrame | None = None,
              max_length: int | None = None) -> DataFrame:
    """``x`` = the feature rows i-L..i-1 (array of arrays), ``y`` = ``target``
    at row i; rows with fewer than L earlier rows are dropped. ``length`` is an
    int, or a column name holding L per key (joined from ``lengths`` when
    given); then ``max_length`` bounds the frame, each row keeps its last L, and keys
    that ``lengths`` does not name take ``max_length``."""
    keys = _keys(key)
    if lengths is not None:
        # one row per key; AQE broadcasts it when its runtime size is small
        df = _with_keys(df, lengths, keys)
        if max_length is not None:
            df = df.withColumn(length, F.coalesce(F.col(length), F.lit(max_length)))
    if isinstance(length, int):
        lmax, lcol = length, F.lit(length)
    else:
        if max_length is None:
            raise ValueError("max_length is needed with a per-key length column")
        lmax, lcol = max_length, F.col(length)
    rows, spec = segmented(df, key, ts, order, lmax, seg_rows, bucket_seconds)
    frame = spec.rowsBetween(-lmax, -1)
    feats = F.array(*[F.col(c).cast("double") for c in cols])
    lst = F.collect_list(feats).over(frame)
    rows = rows.withColumn("_all", lst).withColumn("_n", F.count(F.lit(1)).over(frame))
    rows = rows.filter(F.col("_n") >= lcol).withColumn(
        "x", F.slice(F.col("_all"), F.size("_all") - lcol + 1, lcol)).withColumn(
        "y", F.col(target).cast("double"))
    return own_rows(rows).drop("_all", "_n")


# ----------------------------------------------------------- unbounded frames ---

def known_neighbours(df: DataFrame, key, ts: str, vals: dict, order: Sequence[str] = (),
                     want=("prev", "next"), seg_rows: int = SEG_ROWS,
                     bucket_seconds: int | None = None) -> DataFrame:
    """For each ``name -> expr`` (null = unknown) add ``{name}_prev`` (the last
    known value at or before the row) and/or ``{name}_next`` (the first known
    value at or after the row), across the whole series of the key, plus
    ``_pos``. Works per segment, then carries across segments through a small
    per-segment table."""
    keys = _keys(key)
    rows, spec = segmented(df, key, ts, order, 0, seg_rows, bucket_seconds)
    upto = spec.rowsBetween(Window.unboundedPreceding, 0)
    # the next known value is the last one in descending order: a running frame, so
    # each row is visited once (a frame to the end would be read anew for every row)
    after = Window.partitionBy(*keys, "_tseg").orderBy(F.col("_pos").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    for n, e in vals.items():
        rows = rows.withColumn(f"_v_{n}", e)
        if "prev" in want:
            rows = rows.withColumn(f"{n}_prev", F.last(f"_v_{n}", True).over(upto))
        if "next" in want:
            rows = rows.withColumn(f"{n}_next", F.last(f"_v_{n}", True).over(after))
    # per-segment last / first known value -> carried over neighbouring segments
    aggs = []
    for n in vals:
        known_pos = F.when(F.col(f"_v_{n}").isNotNull(), F.col("_pos"))
        if "prev" in want:
            aggs.append(F.max_by(f"_v_{n}", known_pos).alias(f"_sl_{n}"))
        if "next" in want:
            aggs.append(F.min_by(f"_v_{n}", known_pos).alias(f"_sf_{n}"))
    segt = rows.groupBy(*keys, "_tseg").agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy("_tseg")
    back = Window.partitionBy(*keys).orderBy(F.col("_tseg").desc())
    sel = [*keys, "_tseg"]
    for n in vals:
        if "prev" in want:
            sel.append(F.last(f"_sl_{n}", True).over(
                ws.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_cp_{n}"))
        if "next" in want:
            sel.append(F.last(f"_sf_{n}", True).over(
                back.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_cn_{n}"))
    segt = segt.select(*sel)
    rows = _with_keys(rows, segt, keys + ["_tseg"])
    for n in vals:
        if "prev" in want:
            rows = rows.withColumn(f"{n}_prev", F.coalesce(f"{n}_prev", f"_cp_{n}")).drop(f"_cp_{n}")
        if "next" in want:
            rows = rows.withColumn(f"{n}_next", F.coalesce(f"{n}_next", f"_cn_{n}")).drop(f"_cn_{n}")
        rows = rows.drop(f"_v_{n}")
    return rows.filter(~F.col("_halo")).drop("_b", "_start", "_seg", "_tseg", "_halo")


def ffill(df: DataFrame, key, ts: str, cols: Sequence[str] | str, order: Sequence[str] = (),
          seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """Each null takes the last known value of the key before it."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = known_neighbours(df, key, ts, {c: F.col(c) for c in cols}, order, ("prev",),
                           seg_rows, bucket_seconds)
    for c in cols:
        out = out.withColumn(c, F.col(f"{c}_prev")).drop(f"{c}_prev")
    return out.drop("_pos")


def bfill(df: DataFrame, key, ts: str, cols: Sequence[str] | str, order: Sequence[str] = (),
          seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """Each null takes the next known value of the key after it."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = known_neighbours(df, key, ts, {c: F.col(c) for c in cols}, order, ("next",),
                           seg_rows, bucket_seconds)
    for c in cols:
        out = out.withColumn(c, F.col(f"{c}_next")).drop(f"{c}_next")
    return out.drop("_pos")


def fill_modes(df: DataFrame, key, ts: str, c: str, outs: dict[str, str], order: Sequence[str] = (),
               seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """W5 in several modes at once: ``outs`` maps a new column to its mode (see
    :func:`fill_both`); the known neighbours are found in one pass."""
    return _fill(df, key, ts, {c: outs}, order, seg_rows, bucket_seconds)


def fill_both(df: DataFrame, key, ts: str, cols: Sequence[str] | str, mode: str = "bfill_ffill",
              order: Sequence[str] = (), seg_rows: int = SEG_ROWS,
              bucket_seconds: int | None = None) -> DataFrame:
    """Fill nulls from both sides, in time order.

    ``bfill_ffill`` (what the reference does): next known value, else previous.
    ``nearest``: the closer of previous and next known value by row distance,
    a tie goes to the previous one; at the edges the only side there is."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return _fill(df, key, ts, {c: {c: mode} for c in cols}, order, seg_rows, bucket_seconds)


def _fill(df, key, ts, wanted: dict[str, dict[str, str]], order, seg_rows, bucket_seconds):
    vals = {}
    for c, outs in wanted.items():
        vals[c] = F.col(c)
        if "nearest" in outs.values():
            vals[f"_p_{c}"] = F.when(F.col(c).isNotNull(), F.col("_pos"))
    out = known_neighbours(df, key, ts, vals, order, ("prev", "next"), seg_rows, bucket_seconds)
    filled = {}
    for c, outs in wanted.items():
        p, n = F.col(f"{c}_prev"), F.col(f"{c}_next")
        for name, mode in outs.items():
            if mode == "nearest":
                near_prev = (F.col("_pos") - F.col(f"_p_{c}_prev")) <= (F.col(f"_p_{c}_next") - F.col("_pos"))
                pick = F.when(p.isNull(), n).when(n.isNull(), p).when(near_prev, p).otherwise(n)
                filled[name] = F.coalesce(F.col(c), pick)
            else:
                filled[name] = F.coalesce(F.col(c), n, p)
    out = out.withColumns(filled)
    return out.drop("_pos", *[f"{v}_{side}" for v in vals for side in ("prev", "next")])


def interpolate(df: DataFrame, key, ts: str, cols: Sequence[str] | str, order: Sequence[str] = (),
                seg_rows: int = SEG_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """Linear interpolation in time between the previous and next known
    values; leading nulls stay null, trailing nulls take the last known value."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    secs = F.unix_micros(F.col(ts).cast("timestamp"))
    vals = {c: F.when(F.col(c).isNotNull(), F.struct(secs.alias("t"), F.col(c).alias("v")))
            for c in cols}
    out = known_neighbours(df, key, ts, vals, order, ("prev", "next"), seg_rows, bucket_seconds)
    for c in cols:
        p, n = F.col(f"{c}_prev"), F.col(f"{c}_next")
        frac = (secs - p["t"]).cast("double") / (n["t"] - p["t"]).cast("double")
        line = F.when(n["t"] == p["t"], p["v"]).otherwise(p["v"] + (n["v"] - p["v"]) * frac)
        val = (F.when(F.col(c).isNotNull(), F.col(c))
               .when(p.isNull(), F.lit(None))
               .when(n.isNull(), p["v"])
               .otherwise(line))
        out = out.withColumn(c, val).drop(f"{c}_prev", f"{c}_next")
    return out.drop("_pos")


# --------------------------------------------------------------- grids, top-n ---

def hourly_grid(bounds: DataFrame, key, start: str = "start", end: str = "end",
                ts: str = "ts", step: str = "1 hour") -> DataFrame:
    """One row per key and step from ``start`` to ``end`` inclusive. Days
    are generated first and spread over tasks, then hours within each day, so a
    long range is never produced by one task."""
    keys = _keys(key)
    days = (bounds.select(*keys, start, end, F.explode(F.sequence(
        F.date_trunc("day", F.col(start)), F.col(end), F.expr("INTERVAL 1 DAY"))).alias("_day"))
        .repartition(*keys, "_day"))
    lo = F.greatest(F.col("_day"), F.col(start))
    hi = F.least(F.col("_day") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND"), F.col(end))
    return (days.filter(lo <= hi)
            .select(*keys, F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {step}"))).alias(ts)))


def resample_hourly(df: DataFrame, key, ts: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Hourly grid from the first to the last stamp of each key, values only
    where a row exists (others null)."""
    keys = _keys(key)
    cols = [c for c in df.columns if c not in keys + [ts]] if cols is None else list(cols)
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    grid = hourly_grid(bounds, keys, "_lo", "_hi", ts)
    src = df.select(*keys, F.col(ts).cast(grid.schema[ts].dataType).alias(ts), *cols)
    return grid.join(src, keys + [ts], "left")


def upsample_interpolate(df: DataFrame, key, ts: str, c: str, step: str = "1 hour") -> DataFrame:
    """W6 + W7 in one pass for one column: the hourly grid from each key's first
    to last row, with ``c`` interpolated linearly in time between known values,
    null before the first known value and equal to the last known value after
    it. Each known point emits its own hours up to the next known point (a
    lead on bounded segments), so no grid is joined and no fill is run."""
    keys = _keys(key)
    tcol = F.col(ts).cast("timestamp")
    d = df.select(*keys, tcol.alias(ts), F.col(c))
    bounds = d.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    one = F.expr(f"INTERVAL {step}")
    # as on the general path (:func:`resample_hourly`), a point between two stamps of the key's
    # grid has no row there: it is left out, and known points are at least a step apart
    width = F.unix_micros(F.timestamp_micros(F.lit(0).cast("long")) + one)
    known = _with_keys(d, bounds.select(*keys, "_lo"), keys).filter(
        F.col(c).isNotNull() & (F.pmod(F.unix_micros(F.col(ts)) - F.unix_micros("_lo"), width) == 0)).drop("_lo")
    first_known = known.groupBy(*keys).agg(F.min(ts).alias("_k0"))
    bounds = _with_keys(bounds, first_known, keys)
    known = known.withColumn("_pt", F.struct(F.unix_micros(F.col(ts)).alias("t"), F.col(c).alias("v")))
    nxt = _with_keys(leads(known, key, ts, "_pt", [1], prefix="_n"), bounds.select(*keys, "_hi"), keys)
    last_hour = F.when(F.col("_n1").isNull(), F.col("_hi")).otherwise(
        F.timestamp_micros(F.col("_n1")["t"]) - one)
    # a long gap is cut into runs of RUN_STEPS steps first, and each run into its steps, so no
    # row ever holds a gap as one array
    run = F.expr(f"INTERVAL {step}") * F.lit(RUN_STEPS)
    runs = nxt.select(*keys, F.col(ts).alias("_t0"), "_pt", "_n1", last_hour.alias("_end"),
                      F.explode(F.sequence(F.col(ts), last_hour, run)).alias("_r0"))
    seg = runs.select(*keys, "_t0", "_pt", "_n1", F.explode(F.sequence(
        F.col("_r0"), F.least(F.col("_end"), F.col("_r0") + run - one), one)).alias(ts))
    frac = ((F.unix_micros(F.col(ts)) - F.col("_pt")["t"]).cast("double")
            / (F.col("_n1")["t"] - F.col("_pt")["t"]).cast("double"))
    val = (F.when(F.col(ts) == F.col("_t0"), F.col("_pt")["v"])
           .when(F.col("_n1").isNull(), F.col("_pt")["v"])
           .otherwise(F.col("_pt")["v"] + (F.col("_n1")["v"] - F.col("_pt")["v"]) * frac))
    body = seg.select(*keys, ts, val.alias(c))
    lead_end = F.coalesce(F.col("_k0") - one, F.col("_hi"))
    leading = (bounds.filter(F.col("_k0").isNull() | (F.col("_k0") > F.col("_lo")))
               .select(*keys, lead_end.alias("_end"), F.explode(F.sequence(F.col("_lo"), lead_end, run)).alias("_r0"))
               .select(*keys, F.explode(F.sequence(F.col("_r0"), F.least(F.col("_end"), F.col("_r0") + run - one), one)).alias(ts))
               .withColumn(c, F.lit(None).cast(df.schema[c].dataType)))
    return body.unionByName(leading)


def last_n(df: DataFrame, key, ts: str, n: int, order: Sequence[str] = ()) -> DataFrame:
    """L3: the last ``n`` rows of each key. ``row_number <= n`` lets Spark plan a
    WindowGroupLimit, which keeps only n rows per key in each map task before
    the shuffle, so a hot key sends n rows per task, not its whole series."""
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(*[F.col(ts).desc()] + [F.col(o).desc() for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def future_from_last(df: DataFrame, key, ts: str, n: int, step: str = "1 hour",
                     order: Sequence[str] = ()) -> DataFrame:
    """the last ``n`` rows of each key moved ``n`` steps ahead, as stand-in
    feature rows for the next ``n`` steps of the grid (row i of the tail gives
    step i). Built on L3's bounded top-n."""
    tail = last_n(df, key, ts, n, order)
    return tail.withColumn(ts, F.col(ts) + F.expr(f"INTERVAL {step}") * F.lit(n))


# ----------------------------------------------------------------- scaling ---

def minmax_scale(df: DataFrame, key, cols: Sequence[str] | str, suffix: str = "_scaled",
                 keep_params: bool = True) -> DataFrame:
    """W12 + A15: (x - min) / (max - min) per key; a constant column maps to 0.
    Min/max come from one grouped aggregate (partial aggregation, skew-safe)."""
    keys = _keys(key)
    cols = [cols] if isinstance(cols, str) else list(cols)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    params = df.groupBy(*keys).agg(*aggs)
    out = _with_keys(df, params, keys)
    for c in cols:
        rng = F.col(f"{c}_max") - F.col(f"{c}_min")
        out = out.withColumn(c + suffix, F.when(rng == 0, F.lit(0.0)).otherwise(
            (F.col(c) - F.col(f"{c}_min")) / rng))
        if not keep_params:
            out = out.drop(f"{c}_min", f"{c}_max")
    return out


def inverse_minmax(c, lo, hi) -> Column:
    """W12 inverse: x * (max - min) + min."""
    def col(x):
        return F.col(x) if isinstance(x, str) else x
    return col(c) * (col(hi) - col(lo)) + col(lo)
