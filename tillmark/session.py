"""Session defaults and the shared folder that jobs write intermediate data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the library is tested under. They are defaults for ``get_spark`` only: every function takes the caller's
#: session and changes none of its settings.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_spark(app_name: str = "tillmark", conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or fetch) a session with the defaults above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is made, but only in local mode: on a cluster such a folder would exist on
    one machine only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tillmark-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/tillmark/{label}-{uuid.uuid4().hex}"
