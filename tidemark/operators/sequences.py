"""W9 by reference: training sequences without copying each row L times.

A key's series is stored as blocks: the values of ``seg_rows`` consecutive rows and of the
``max_length`` rows before them, once. A sequence is a pair (block, place of its target row); its
L rows are the places before it. :func:`sequence_rows` looks single rows of sequences up,
:func:`read_sequences` hands whole ones to a function, a batch at a time, as views of the block.
So the stored bytes are (1 + max_length / seg_rows) times the input's, whatever L is."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .series import _keys, _with_keys, segmented

#: Own rows of a block.
BLOCK_ROWS = 4096


def sequence_blocks(df: DataFrame, key, ts: str, cols: Sequence[str], target: str, max_length: int, order: Sequence[str] = (),
                    seg_rows: int = BLOCK_ROWS, bucket_seconds: int | None = None) -> DataFrame:
    """(key..., segment, first_pos, n_context, ts, x, y): arrays over a block's rows in series
    order, ``first_pos`` the position of the first within its key, the first ``n_context`` of
    them context of the block. ``x`` holds the ``cols`` of a row, ``y`` its ``target``; nulls
    stay. Null keys are a series of their own; no rows: no blocks. (ts, order...) must be a
    total order within a key."""
    keys = _keys(key)
    rows, _ = segmented(df, key, ts, order, max_length, seg_rows, bucket_seconds)
    item = F.struct("_pos", "_halo", F.col(ts).alias("t"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"),
                    F.col(target).cast("double").alias("y"))
    blocks = rows.groupBy(*keys, F.col("_tseg").alias("segment")).agg(F.sort_array(F.collect_list(item)).alias("_r"))
    out = blocks.select(*keys, "segment", F.get("_r", 0)["_pos"].alias("first_pos"), F.size(F.filter("_r", lambda r: r["_halo"])).alias("n_context"),
                        F.col("_r.t").alias("ts"), F.col("_r.x").alias("x"), F.col("_r.y").alias("y"))
    return out.where(F.col("n_context") < F.size("ts"))


def with_lengths(blocks: DataFrame, key, lengths: DataFrame, length: str, default: int) -> DataFrame:
    """``blocks`` with each key's L from ``lengths`` (one row per key), ``default`` for others."""
    return _with_keys(blocks, lengths, _keys(key)).withColumn(length, F.coalesce(F.col(length), F.lit(default)))


def _targets(length: Column) -> Column:
    """Places of the target rows: a block's own rows with at least L rows of the key before them."""
    low = F.greatest(F.col("n_context").cast("long"), length - F.col("first_pos"))
    return F.when(low < F.size("ts"), F.sequence(low, (F.size("ts") - 1).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def sequence_rows(blocks: DataFrame, key, length: int | str, places: dict[str, int]) -> DataFrame:
    """(key..., ts, y, name...): one row per sequence, with the feature rows at the given places
    of it (0 the oldest, -1 the newest), looked up in the block. ``length`` is a number or a
    column, at most the blocks' ``max_length``."""
    n = (F.lit(length) if isinstance(length, int) else F.col(length)).cast("long")
    row = lambda at, p: F.get("x", (at - n + p if p >= 0 else at + p).cast("int"))
    found = F.transform(_targets(n), lambda at: F.struct(F.get("ts", at.cast("int")).alias("ts"), F.get("y", at.cast("int")).alias("y"),
                                                         *[row(at, p).alias(name) for name, p in places.items()]))
    return blocks.select(*_keys(key), *([length] if isinstance(length, str) else []), F.inline(found))


def read_sequences(blocks: DataFrame, key, length: int | str, fn: Callable, schema: str, batch_rows: int = 1024) -> DataFrame:
    """``fn(about, x, y)`` on at most ``batch_rows`` sequences of one block at a time: ``about`` is
    a pandas table of key... and ts, ``x`` an array (sequences, L, features), a view of the block
    that must not be written to, ``y`` the targets (null: NaN). It returns a pandas table of
    ``schema``; the results are the rows of the output."""
    keys = _keys(key)

    def run(parts):
        import numpy as np
        import pandas as pd
        for part in parts:
            for r in part.to_dict("records"):
                n = int(r["_n"])
                x, y = np.stack(r["x"]).astype(float), np.asarray(r["y"], float)
                low = max(int(r["n_context"]), n - int(r["first_pos"]))
                if low >= len(y):
                    continue
                views = np.lib.stride_tricks.sliding_window_view(x, n, axis=0).transpose(0, 2, 1)
                for at in range(low, len(y), batch_rows):
                    to = min(len(y), at + batch_rows)
                    about = pd.DataFrame({**{k: [r[k]] * (to - at) for k in keys}, "ts": list(r["ts"][at:to])})
                    yield fn(about, views[at - n: to - n], y[at:to])

    n = F.lit(length) if isinstance(length, int) else F.col(length)
    return blocks.select(*keys, n.alias("_n"), "first_pos", "n_context", "ts", "x", "y").mapInPandas(run, schema)
