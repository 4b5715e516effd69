"""SparkSession settings and the shared scratch location.

The library never creates its own session inside an operator. ``build_session`` is for tests,
the bench and command-line jobs; on a cluster the caller brings a session whose
``spark.checkpoint.dir`` points at shared storage.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _default_heap() -> str:
    """Local mode runs everything in the driver JVM: give it about 60% of physical memory,
    at most 16 GB, so the heap never outgrows a small machine."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "docflow") -> SparkSession:
    """Session for local runs: ANSI on (the 4.x default), UTC, AQE with skew handling, no UI. The
    number of shuffle partitions is the submitted one unless given here."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # streaming state (one row per document for the ledger) lives on local disk, not the heap
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DOCFLOW_DRIVER_MEMORY", _default_heap()))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_PKG_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package (pandas UDFs and ``mapInPandas`` functions refer to
    it by module). On a cluster ship it with ``--py-files``; where workers share the driver's
    file system (local mode) the package folder is put on their PYTHONPATH, so runs work from
    any working directory. Call before building queries: UDFs take the environment when applied."""
    try:
        env = spark.sparkContext.environment
    except Exception:  # noqa: BLE001 - Spark Connect: the server's workers need the package installed
        return
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _PKG_ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_PKG_ROOT, *parts])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    ``spark.checkpoint.dir`` is read from the session first; a cluster sets it to shared
    storage. Only when it is unset and the session runs in one local process (tests) is a private
    directory created and set; elsewhere executors could not share it, so that is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return conf_dir
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="docflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def cores(spark: SparkSession) -> int:
    """Tasks that the session runs at a time."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_go(spark: SparkSession):
    """The shuffle files of what is written in the block go once it is written: nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for an intermediate table under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/docflow-scratch/{uuid.uuid4().hex}/{name}"
