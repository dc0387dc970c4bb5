"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job in the library relies on.  Time-zone UTC makes ISO ``...Z``
# strings and DuckDB's naive timestamps line up; AQE coalesces small shuffles and
# splits skewed join partitions at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only what the optimizer (file stats) or AQE (runtime stats) has
    # measured under this bound; everything else goes sort-merge / shuffle-hash.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "sluice",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; locally
    pass e.g. ``"local[8]"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is.  Only when nothing is configured and the master is
    local — tests — do we fall back to a fresh folder under the system temp dir;
    with any other master a missing folder is an error, since executors and
    driver do not share local disks.  Under Spark Connect (no SparkContext on the
    client) the server's setting applies.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect client
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        configured = local_scratch(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_scratch(master: str) -> str:
    """A fresh local folder for a ``local[...]`` master; an error for any other."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
    return tempfile.mkdtemp(prefix="sluice-ckpt-")


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python once per application, so that
    functions run there need no installation."""
    sc = spark.sparkContext
    if getattr(sc, "_sluice_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="sluice-py-"), "sluice-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._sluice_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for intermediate tables, stream checkpoints and snapshot copies so that
    nothing lands on a machine-local temp folder on a cluster.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Marks a written scratch folder for removal when the driver's JVM ends."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
