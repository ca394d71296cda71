"""Session profile and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "rolescope", conf: dict[str, str] | None = None,
                master: str | None = None) -> SparkSession:
    """The active session if there is one, else a new one with this project's defaults.

    A session the caller already made keeps its own master and memory; only the time zone is
    pinned, because timestamps in the source tables are wall-clock values.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return pin_utc(active)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Fix the session zone so that text and timestamps convert the same way everywhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``.

    Executors on other hosts must see what is written there, so a machine-local folder is used
    only when the setting is missing *and* the whole session runs on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="rolescope-")
