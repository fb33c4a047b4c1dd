"""Session set-up and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def get_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "implicit_rank",
    extra: dict | None = None,
) -> SparkSession:
    """Session for local runs and tests; on a cluster use spark-submit's.

    AQE is on so that joins whose small side is measured at run time
    become broadcast joins, shuffle partitions are coalesced and skewed
    join partitions are split.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("IR_DRIVER_MEMORY", "8g"))
        # remove checkpoint files once their DataFrames are garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only if unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is
    read from the session. Only a local-mode session (tests) without that
    setting gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for the cluster"
        )
    folder = tempfile.mkdtemp(prefix="ir-ckpt-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (models, tables)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def large(df):
    """``df`` as a join side that is never broadcast, for tables with a row per user or item.

    The planner judges a written table by the size of its compressed files, a
    fraction of what a broadcast of its rows takes on the driver; with several
    runs at once that adds up.
    """
    return df.hint("merge")


def materialize(df, name: str, partition_by=()):
    """Write ``df`` as parquet to the shared folder and read it back.

    Unlike a row checkpoint the table keeps column pruning, filter pushdown and
    statistics; ``partition_by`` adds folder pruning. A join on it shuffles a
    plain scan, so the planner can split a hot key's rows over tasks.
    """
    folder = shared_folder(df.sparkSession, name)
    if _written.get() is not None:
        _written.get().append(folder)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(folder)
    table = df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)
    table.folder = folder
    return table


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)  # folders of the open ``scratch``


@contextmanager
def scratch(spark: SparkSession):
    """Deletes at its end the tables that ``materialize`` wrote inside it, in this thread.

    For a run whose results are written elsewhere. The driver then collects
    garbage, upon which Spark removes the shuffle files of the run: without it
    they stay until the driver's heap happens to fill.
    """
    token = _written.set([])
    try:
        yield
    finally:
        for folder in _written.get():
            _delete(spark, folder)
        _written.reset(token)
        collect_garbage(spark)


def collect_garbage(spark: SparkSession) -> None:
    """Lets the driver collect garbage, upon which Spark removes the shuffle files and cached blocks of plans that are gone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def collecting(spark: SparkSession, every: float = 20.0):
    """Collects garbage every so many seconds, for one long call whose own shuffles become superfluous on the way."""
    done, collect = threading.Event(), spark.sparkContext._jvm.System.gc

    def run():
        while not done.wait(every):
            collect()

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()


def discard(*tables) -> None:
    """Delete tables of ``materialize`` that no later plan reads; None is passed over."""
    for table in tables:
        if table is not None:
            _delete(table.sparkSession, table.folder)


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder in whatever store it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _rows(spark: SparkSession, path: str) -> list[str]:
    """Folders of published rows under ``path``, oldest first."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n for n in names if n.startswith("metadata-") and fs.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[1]))


def publish(spark: SparkSession, path: str, meta: str, mode: str = "overwrite") -> None:
    """Make ``meta`` (JSON that names the parts' folder) what ``published`` reads.

    A new row is written beside the last; it counts once it is complete, so a
    save that dies on the way leaves the earlier one in force. ``mode`` "error"
    refuses a path that has a row already.
    """
    old = _rows(spark, path)
    if old and mode in ("error", "errorifexists"):
        raise FileExistsError(f"a model is saved under {path}")
    number = int(old[-1].split("-")[1]) + 1 if old else 0
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.parquet(f"{path}/metadata-{number:09d}")


def published(spark: SparkSession, path: str) -> dict:
    """The last published row under ``path``."""
    import json

    rows = _rows(spark, path)
    if not rows:
        raise FileNotFoundError(f"no model is saved under {path}")
    return json.loads(spark.read.parquet(f"{path}/{rows[-1]}").first()[0])


def remove_old(spark: SparkSession, path: str) -> int:
    """Delete the saves under ``path`` that are no longer published; returns how many parts went.

    For when no job reads or writes an earlier save.
    """
    path = path.rstrip("/")
    keep, rows = published(spark, path)["part"], _rows(spark, path)
    fs, where = _folder(spark, path)
    parts = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("save-")]
    gone = [p for p in parts if p.getName() != keep]
    for old in [_folder(spark, f"{path}/{n}")[1] for n in rows[:-1]] + gone:
        fs.delete(old, True)
    return len(gone)
