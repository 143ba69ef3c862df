"""Session construction and shared-scratch locations."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Defaults for a session we build ourselves (tests, bench). A session handed
# to us by a cluster keeps its own settings.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MB splits; at 100 TB that is ~800k scan tasks, sized for executor memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # wide typed loads (40+ casts in one projection) generate methods above
    # HotSpot's 8,000-bytecode JIT limit; let the JIT compile them anyway
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "fernhill", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, local_folder: str = "/tmp/fernhill-checkpoints") -> str:
    """Return the shared checkpoint folder named by the cluster.

    A cluster names it in ``spark.checkpoint.dir``. Where it is unset, a session
    whose master is local (one machine, as in tests) gets ``local_folder``; any
    other session fails, since its executors would not share such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", sc.master or ""):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    sc.setCheckpointDir(configured or local_folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for intermediate tables.

    Never a machine-local temp folder: on a cluster every executor must see it.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fernhill/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fernhill`` importable in executor Python workers (the workbook and
    archive readers run there), whatever the working directory: the package is
    zipped once per process next to its sources and handed to ``addPyFile`` --
    what ``spark-submit --py-files`` does on a cluster."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    candidates = [os.path.join(os.path.dirname(pkg), "build")]
    ckpt = ensure_checkpoint_dir(spark)
    if ckpt.startswith("file:"):
        candidates.append(ckpt[len("file:"):])
    for out_dir in candidates:
        try:
            os.makedirs(out_dir, exist_ok=True)
            zpath = os.path.join(out_dir, f"fernhill-{os.getpid()}.zip")
            with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
                for dirpath, _, files in os.walk(pkg):
                    for f in files:
                        if f.endswith(".py"):
                            full = os.path.join(dirpath, f)
                            z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        except OSError:
            continue
        sc.addPyFile(zpath)
        break
    # otherwise the package must already be installed on the executors
    _SHIPPED.add(sc.applicationId)
