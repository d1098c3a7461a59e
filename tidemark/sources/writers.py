"""Writers (K1-K5). Outputs are rerun-safe: partition overwrite instead of
blind appends, and appends that skip rows already stored."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..operators.joins import unique_by


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                header: bool = True) -> None:
    """K1/K5: write as Parquet (default), CSV (with header) or JSON lines."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)


def write_by_token(df: DataFrame, path: str, key: str = "token", fmt: str = "parquet") -> None:
    """K2: one directory per token; the combined table is the same path read
    back. Rows are rebalanced by token, so small tokens share a task and a hot
    one is split over several tasks and files."""
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).format(fmt).save(path)


def write_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """K4: rerun-safe store: only the partitions present in ``df`` are replaced
    (dynamic partition overwrite), so a rerun does not duplicate rows."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def _stored(spark, path: str, fmt: str) -> DataFrame | None:
    """The table at ``path``, None if nothing is stored there yet; any other error is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new(df: DataFrame, path: str, id_cols: Sequence[str] | str, fmt: str = "parquet") -> int:
    """K3 (+X2 in batch): append only rows whose id is not stored yet (and
    each id once: the row that sorts first; null ids count as one id). Returns
    the number of stored rows before the append."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    stored = _stored(df.sparkSession, path, fmt)
    new = unique_by(df, ids, [])
    n_before = 0
    if stored is not None:
        n_before = stored.count()
        old = stored.select(*[F.col(c).alias(f"_old_{i}") for i, c in enumerate(ids)])
        same = [F.col(c).eqNullSafe(F.col(f"_old_{i}")) for i, c in enumerate(ids)]
        new = new.join(old, reduce(and_, same), "left_anti")
    new.select(*df.columns).write.mode("append").format(fmt).save(path)
    return n_before


def write_predictions(df: DataFrame, path: str, model: str | None = None,
                      keys: Sequence[str] = ("model", "token")) -> None:
    """K4 + P6 + U1: predictions of any model into one table partitioned by
    model and token; rerunning a model replaces only its partitions."""
    if model is not None:
        df = df.withColumn("model", F.lit(model))
    write_partitions(df, path, list(keys))
