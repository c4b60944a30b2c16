"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The plans rely on these: naive UTC time, and run-time re-planning of joins and skewed partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "barspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: str | None = None


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder.

    Executors on any node must see what another one wrote, so the folder named by
    ``spark.checkpoint.dir`` is used. Only where it is unset (tests, one machine)
    is a local folder made, once per process, and removed when the process ends; a cluster without the
    setting is an error, because its machines would not see each other's files.
    """
    global _local_root
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share (the master is {master})")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="barspan-")
            atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
