"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Spark 4 only accepts a short charset list unless this is on. ``windows-31j`` is
# the name that maps every character of Japanese Windows CSV files correctly.
JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"
JAPANESE = "windows-31j"


def build_session(app: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE on, UTC time and the web page off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # HTML rows are wide: small Arrow batches keep Python workers flat.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        JAVA_CHARSETS: "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_japanese(spark: SparkSession) -> None:
    """Switch on the JVM charset names; needed before any windows-31j read or write."""
    if spark.conf.get(JAVA_CHARSETS, "false") != "true":
        spark.conf.set(JAVA_CHARSETS, "true")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder path for a written table.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only where that is unset and the master is this
    machine alone (a test) is a local temporary folder used; on a cluster the setting is needed, since tasks on other machines
    would write to folders of their own. Folders are kept: a result may still read them. Jobs remove the shared
    folder's contents when they are done with their results.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    """One temporary folder of this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="feedloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
