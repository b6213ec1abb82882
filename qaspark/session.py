"""Session helpers: building a local session for tests and benches, and the
shared scratch folder every job that writes intermediate data uses.

On a cluster the session is built by the caller; the library only reads
``spark.checkpoint.dir`` from it. A local folder is set only when that
setting is missing (tests, benches on one machine)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "qaspark") -> SparkSession:
    """A ``local[cores]`` session with the settings the operators assume:
    UTC session time zone (N8), AQE on, Spark UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QASPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if the
    session names none (local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="qaspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder, for
    sinks, stream checkpoints and materialised intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``qaspark`` importable in Python workers (what ``--py-files``
    does): zip the package once per application and ``addPyFile`` it. Needed
    by the pandas paths (``mapInPandas``, ``applyInPandasWithState``), whose
    functions live in this package."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    folder = local if "://" not in base and os.path.isdir(local) else tempfile.mkdtemp(prefix="qaspark-pkg-")
    target = os.path.join(folder, f"qaspark-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
