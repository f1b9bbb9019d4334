"""Session for local runs, and the shared scratch folder of whatever session is in use."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


_ONE_MACHINE = re.compile(r"local(\[.*\])?")


def local_session(cpus: int | str = "*", app: str = "sparktape") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's `spark.checkpoint.dir`.

    Where that setting is absent, a master on this machine gets a temporary folder; any
    other one, also one that cannot be read, must name a folder that all machines share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _ONE_MACHINE.fullmatch(spark.conf.get("spark.master", None) or ""):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sparktape-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
