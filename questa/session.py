"""Session helpers: building a local session for tests/bench and locating the
shared folder used to cut lineage (checkpoints, written intermediate tables)."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "questa", extra_conf: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    SparkContext).  Only a *local* session without one gets a private folder
    under the system temp dir; on a cluster a machine-local folder would not
    survive executor loss, so we refuse instead of guessing.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="questa-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) so intermediate results survive executor loss")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/questa-{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and read it from
    there: for inputs that several passes scan (fits, splits, tests), so
    an expensive lineage is computed once and a lost executor re-reads the
    written copy instead of recomputing it.

    An eager checkpoint runs a counting job and then a writing job; ``df``
    is persisted for that moment so the second job reads the first one's
    result instead of recomputing the lineage."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers (once per context):
    a zip of its sources is handed to the executors, whatever folder they run
    in."""
    with _SHIPPING:  # analyses may start from several driver threads
        _ship(spark)


_SHIPPING = threading.Lock()


def _ship(spark: SparkSession) -> None:
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_questa_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="questa-src-"), "questa.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("questa", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._questa_shipped = True
