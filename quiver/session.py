"""Session construction and cluster-shared locations.

Operators never create sessions; callers pass one in. This module is only the
convenience used by tests, the bench and the entry point.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, partitions: int | None = None,
                  app_name: str = "quiver") -> SparkSession:
    """A session tuned for the window-heavy plans of this package.

    AQE stays on so shuffle partitions coalesce and skewed sort-merge joins are
    split at run time; the UI stays off (no server is opened).
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    # local runs: one shuffle partition per core; on a cluster set
    # QUIVER_SHUFFLE_PARTITIONS to the raw-aggregation size (AQE coalesces
    # the small window stages that follow down to the advisory size)
    partitions = partitions or int(os.environ.get("QUIVER_SHUFFLE_PARTITIONS", cpus))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUIVER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return tune(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; without it tables would land on single machines, so that fails.
    Only in local mode (tests) is a scratch folder created when it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="quiver-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the plans of this package rely on.

    Constraint propagation is switched off: with dozens of forward-filled
    columns re-aliased under their own names (the 37-column processed table)
    the optimizer's constraint sets grow exponentially and planning stalls.
    Arrow batches hold at most 2,000 rows: rows can be whole texts, and each
    batch is held off-heap by the JVM and again by the Python worker.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def materialize(df, name: str = "shared"):
    """Write a DataFrame that feeds several branches of one plan as a Parquet
    table under the cluster's shared checkpoint folder and read it back.

    Without it every branch re-scans and re-aggregates the raw tables (Spark
    reuses an exchange only for identical sub-plans). The plan is computed
    once (``DataFrame.checkpoint`` without a cache computes it twice), the
    lineage is cut, and lost executors re-read the files instead of
    recomputing. Used on small aggregated tables (bars, returns, samples).
    """
    import uuid

    spark = df.sparkSession
    path = shared_path(spark, f"quiver-tables/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quiver`` importable in every Python worker of this application.

    The package is zipped once per SparkContext and added with ``addPyFile``
    (what ``--py-files`` does at submit time), so grouped pandas functions
    defined here resolve on executors whatever their working directory.
    """
    import os
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quiver-pkg-"), "quiver.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
