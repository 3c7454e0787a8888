"""Session helpers: shared scratch location and a local session for tests and benches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    When a local session has none (tests), one is created and set; on a
    cluster that is an error, so no code falls back to a machine's own folder.
    All folders of an application lie under one, named by its id, which the
    driver's file system client deletes when the application ends.
    """
    if scopes := _scopes.get():
        return "/".join([scopes[-1], *parts, uuid.uuid4().hex])
    root = spark.conf.get(CHECKPOINT_KEY, None) or ensure_checkpoint_dir(spark)
    return "/".join([_application_dir(spark, root.rstrip("/")), *parts, uuid.uuid4().hex])


_scopes: ContextVar[tuple[str, ...]] = ContextVar("tessera_scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Within it, shared folders are made below one, which is removed at the
    end, after a failure too. Results have to be written elsewhere by then."""
    path = shared_dir(spark, "scratch")
    token = _scopes.set((*_scopes.get(), path))
    try:
        yield path
    finally:
        _scopes.reset(token)
        remove_dir(spark, path)


_to_delete: set[str] = set()


def _application_dir(spark: SparkSession, root: str) -> str:
    """The application's own folder; made, and marked for deletion at its end,
    on first use. (A killed driver leaves it behind under its id.)"""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no file system client here
        return root
    path = f"{root}/tessera-{sc.applicationId}"
    if path not in _to_delete:
        hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(hadoop)
        fs.deleteOnExit(hadoop)
        _to_delete.add(path)
    return path


def saved(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read back: its lineage ends
    at files that a lost executor doesn't take along."""
    out = shared_dir(df.sparkSession, *parts)
    df.write.parquet(out)
    return df.sparkSession.read.parquet(out)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``DataFrame.checkpoint()`` at the shared ``spark.checkpoint.dir``
    (created only when the session has none, as in local tests)."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not root:
        if not spark.conf.get("spark.master", sc.master).startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, root)
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder, through whatever file system holds it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def local_session(cpus: int | str = "*", app: str = "tessera", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench (the library itself takes any session)."""
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             # no per-call stack capture while building plans (debug aid only)
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
             # Let the JIT compile generated methods over 8000 bytes of bytecode:
             # a fused parse pipeline can pass that, and would then run in the
             # bytecode interpreter (on a cluster: spark.executor.extraJavaOptions).
             .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
