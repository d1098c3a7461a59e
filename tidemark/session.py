"""Session builder and cluster-safe helpers (checkpoint dir, lineage cuts)."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every plan in this package assumes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (UTC, AQE, skew joins)."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep what is there
            pass
    return spark


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "tidemark") -> SparkSession:
    """Local/test session. On a cluster, use the session the platform hands you
    and call :func:`configure` on it instead."""
    master = master or os.environ.get("TIDEMARK_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform (a shared file system path) and is
    only read here. A private temp folder is set only when it is unset, which is
    the local-test case.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext          # absent on Spark Connect sessions
    except Exception:
        sc = None
    if not d and sc is not None:
        cd = sc._jsc.sc().getCheckpointDir()
        d = cd.get() if cd.isDefined() else None
    if not d:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (every executor and the "
                               "driver must reach it); a machine-local folder does not survive on a cluster")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
    return d


_TABLES: list[str] = []   # tables this process has written under the checkpoint folder


def _write(df: DataFrame, folder: str, name: str) -> str:
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/{folder}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _TABLES.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint folder
    and reading it back. Survives executor loss (the table is on shared storage).
    The schema is known, so no job has to look it up in the files."""
    return df.sparkSession.read.schema(df.schema).parquet(_write(df, "tables", name))


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` gave and nothing reads any more, before
    :func:`release` would at the end of the process."""
    for df in tables:
        folders = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in df.inputFiles()}
        with _STORED_LOCK:
            gone = [p for p in _TABLES if p.rsplit("/", 1)[-1] in folders]
            for path in gone:
                _TABLES.remove(path)
        for path in gone:
            _delete(path)


def _delete(path: str) -> bool:
    from pyarrow import fs
    try:
        where, inner = fs.FileSystem.from_uri(path)
        where.delete_dir(inner)
        return True
    except (OSError, ValueError):  # gone already, or a store that pyarrow cannot reach
        return False


def release() -> int:
    """Delete every table this process has written with :func:`materialize` and
    :func:`stored`; returns how many went. Runs by itself when the process ends;
    call it earlier where results that read them are done with."""
    n = 0
    with _STORED_LOCK:
        _STORED.clear()
        while _TABLES:
            n += _delete(_TABLES.pop())
    return n


atexit.register(release)

_STORED: dict[tuple, str] = {}
_STORED_LOCK = threading.RLock()  # builders may call stored() again


def input_state(spark: SparkSession, paths) -> str:
    """What the files under ``paths`` look like now (names, sizes, times), as one
    short text. Local paths are listed here; others by one Spark job that reads
    listings only and returns one row."""
    local = [p.removeprefix("file://") for p in paths]
    if all(p.startswith("/") and os.path.exists(p) for p in local):
        found = []
        for p in local:
            files = [p] if os.path.isfile(p) else [os.path.join(d, f) for d, _, names in os.walk(p) for f in names]
            found += [(f, os.stat(f).st_size, os.stat(f).st_mtime_ns) for f in files]
        return str(hash(tuple(sorted(found))))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    row = files.agg(F.count("*"), F.sum("length"), F.max("modificationTime"),
                    F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return str(tuple(row))


def stored(spark: SparkSession, name: str, source: str, build, inputs=()) -> DataFrame:
    """A derived table written once to the shared checkpoint folder and read back
    by every later caller (keyed by name, source location and the present state
    of the ``inputs`` files: a table whose inputs have changed is built anew).

    Series operators read their input several times (small count passes and the
    row pass); reading a stored hourly table again is cheap, recomputing it from
    raw data is not. Also a recovery point if executors are lost."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:
        app = spark.conf.get("spark.app.id", "") or id(spark)
    k = (name, source, app, input_state(spark, inputs) if inputs else "")
    with _STORED_LOCK:
        path = _STORED.get(k)
        if path is None:
            path = _STORED[k] = _write(build(), "stored", name)
    return spark.read.parquet(path)
