"""Session factory for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "glossaria") -> SparkSession:
    """A local session with the settings the engine is written for.

    ``spark.checkpoint.dir`` is set to a folder under /tmp only if the caller's environment names
    none: on a cluster it is the cluster that names the shared folder.
    """
    shared = os.environ.get("GLOSSARIA_SHARED_DIR", "/tmp/glossaria-shared")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("GLOSSARIA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .getOrCreate()
    )
