"""Spark session and shared-storage helpers.

Everything in the package takes a ``SparkSession`` or a ``DataFrame``; this
module only builds a session for scripts and tests and resolves the shared
checkpoint folder.  On a cluster the folder comes from ``spark.checkpoint.dir``
(set by whoever runs the cluster); only when it is unset (local tests) do we
pick one under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # last duplicate key wins, as in the reference's JSON decoder
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "ndflow", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Settings the operators rely on (runtime-settable ones only)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys",
              "spark.sql.adaptive.enabled"):
        try:
            spark.conf.set(k, DEFAULT_CONF[k])
        except Exception:  # pragma: no cover - some confs are static on some deployments
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (the cluster's shared folder).  Only where
    that is unset and Spark runs on this machine alone (``local``, as in tests)
    a temporary folder is used; on a cluster it would not be shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - sessions without a SparkContext (Spark Connect)
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="ndflow-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ndflow`` importable in Python workers (the ``mapInPandas``
    functions live in the package): zip it once per application into the
    shared folder and ``addPyFile`` it, as ``--py-files`` would."""
    import shutil
    import uuid

    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - Spark Connect: ship with --py-files / addArtifacts instead
        return
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = scratch_path(spark, f"pyfiles-{uuid.uuid4().hex[:12]}")
    if "://" in base and not base.startswith("file:"):
        staging = tempfile.mkdtemp(prefix="ndflow-pyfiles-")  # on the driver; Spark's file server ships it
    else:
        staging = base.replace("file:", "", 1)
        os.makedirs(staging, exist_ok=True)
    zpath = shutil.make_archive(os.path.join(staging, "ndflow"), "zip", root_dir=root, base_dir="ndflow")
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
