"""Session helpers: building one, and finding the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "adstream",
    master: str | None = None,
    options: dict[str, str] | None = None,
    packages: list[str] | None = None,
) -> SparkSession:
    """Start (or join) a session; every setting is the caller's.

    Connectors that are not on the classpath are named in ``packages``; a
    lakehouse format brings its extension and catalog through ``options``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if packages:
        builder = builder.config("spark.jars.packages", ",".join(packages))
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def has_checkpoint_dir(spark: SparkSession) -> bool:
    """True if ``DataFrame.checkpoint`` can be used in this session.

    The folder is the one the cluster configured. Only a local session without
    one, as in tests, gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return True
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
        return True
    if context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="adstream-"))
        return True
    return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    if not has_checkpoint_dir(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
