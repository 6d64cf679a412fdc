"""Session defaults and the shared folder used for checkpoints and landed files."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from importlib import metadata

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "filingspark", **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` uses ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so a missing setting
    is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="filingspark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application.

    Nothing is sent where the package is installed.
    """
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    try:
        metadata.distribution("filingspark")
        return
    except metadata.PackageNotFoundError:
        pass
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="filingspark-code-"), "filingspark.zip")  # on the driver
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)


def _removed_at_exit(context, folder: str) -> None:
    """Make ``folder``, to be removed with all that is in it when the driver ends."""
    jvm = getattr(context, "_jvm", None)
    if jvm is None:  # no driver of Spark in this process
        return
    place = jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, removed when the driver ends."""
    folder = f"{shared_dir(spark)}/filingspark/{name}-{uuid.uuid4().hex}"
    _removed_at_exit(spark.sparkContext, folder)
    return f"{folder}/rows"


def checkpoint(df):
    """Cut the lineage of ``df`` through reliable storage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
