"""Session helpers: the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a shared file system or object
    store). Only a local-mode session without it gets a fresh folder under the
    machine's temp directory, as in tests.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jdir.get() if jdir.isDefined() else None
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="prefspark-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/prefspark/{name}-{uuid.uuid4().hex}"


def local_session(app: str = "prefspark", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (local mode)."""
    spark = (
        SparkSession.builder.master("local[8]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def ship_code(spark: SparkSession) -> None:
    """Make ``prefspark`` importable in Python workers of this session.

    An installed package needs nothing. A source checkout is zipped once into
    the shared folder (local file systems only; on a cluster, install the
    package on the executors) and added with ``addPyFile``.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_prefspark_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    if "site-packages" in pkg or "dist-packages" in pkg:
        sc._prefspark_shipped = True
        return
    base = shared_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    if "://" in local:
        sc._prefspark_shipped = True
        return
    target = os.path.join(local, "prefspark-code", uuid.uuid4().hex, "prefspark.zip")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with zipfile.ZipFile(target, "w") as z:
        for d, _, files in os.walk(pkg):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    sc._prefspark_shipped = True
