"""Session helpers.

The library never invents storage locations on a cluster: ``checkpoint_dir``
reads ``spark.checkpoint.dir`` from the session and only falls back to a fresh
scratch folder when the setting is absent (local tests and benches).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_PKG_DIR = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()
_ship_lock = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in the Python workers of this context.

    Task closures refer to functions of this package, so executors must be able
    to import it. The package is zipped on the driver once per SparkContext and
    handed to ``addPyFile`` (what ``spark-submit --py-files`` does); Spark's
    file server distributes it to every executor.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    with _ship_lock:
        if key in _shipped:
            return
        folder = tempfile.mkdtemp(prefix="tessera-pkg-")
        path = os.path.join(folder, "tessera.zip")
        root = os.path.dirname(_PKG_DIR)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
            for dirpath, _, files in os.walk(_PKG_DIR):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        zf.write(full, os.path.relpath(full, root))
        sc.addPyFile(path)
        _shipped.add(key)


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "tessera") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    partitions = partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one; otherwise (local
    runs only) creates a new scratch folder and registers it with the context.
    """
    sc = spark.sparkContext
    path = sc.getConf().get(_CKPT_KEY, None)
    current = sc.getCheckpointDir()
    if current is None:
        if not path:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError(f"set {_CKPT_KEY} to a folder that all executors share (master {sc.master})")
            path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
        sc.setCheckpointDir(path)
        current = sc.getCheckpointDir()
    return current


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh location below the checkpoint folder for a written table."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more, in whatever store it lies."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)
