"""Session construction and shared scratch locations.

Scale notes (these are the settings the operators are designed around):

* AQE on: partitions are coalesced after each shuffle, sort-merge joins are
  turned into broadcast joins only when the *measured* size of a side is under
  ``spark.sql.autoBroadcastJoinThreshold`` (a checked bound), and skewed
  sort-merge join partitions are split (``skewJoin``).
* ``spark.sql.shuffle.partitions`` is a parameter: ~cores locally, and on a
  large cluster sized so one shuffle partition is ~128-256 MB.
* Session time zone is pinned to UTC so timestamp text and week buckets do
  not depend on the machine.

Scratch data (snapshots, stream checkpoints, lineage cuts) always lives under
the folder the cluster names in ``spark.checkpoint.dir``. Where that setting is
empty, a local master gets a private folder, removed at exit; a cluster is refused,
since its executors would not see it.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", driver_memory: str = "8g") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS") or "8"
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.split("[")[0] == "local":  # one machine: a private folder, gone at exit
        own = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir for ``name``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"
