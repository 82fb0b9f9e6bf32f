"""Session helpers: a UTC session, and the shared folder for scratch output.

Every timestamp rule in this package assumes ``spark.sql.session.timeZone=UTC``, a
repeated key of a JSON message means its last value, and INT64 NANOS timestamps are
read as BIGINT and converted here; ``REQUIRED_CONF`` holds these three settings.
Scratch output (lineage cuts, per-call output folders in checks) lives under the
folder the cluster names in ``spark.checkpoint.dir``; only a local session with no
such setting gets a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}
DEFAULT_CONF = {
    **REQUIRED_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "tradelake", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings that all rules here rely on."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir`` (or a directory already set on the context).
    A local session without one gets a temporary folder; a cluster session without
    one is an error, since a machine-local folder is invisible to other executors.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tradelake-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root (never reused between calls)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
