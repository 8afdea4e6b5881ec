"""Sessions, and the package on the workers' path."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent


def session(name: str = "wellfield", **conf: str) -> SparkSession:
    """A session with the settings that the operators expect; the master comes from the environment or `conf`."""
    builder = SparkSession.builder.appName(name)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.executorEnv.OMP_NUM_THREADS": "1"}
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package. A local master's workers see what the driver sees, where its path or folder
    has the package; any other cluster gets it sent, once an application."""
    paths = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(":") if p}
    context = spark.sparkContext
    seen = str(ROOT) in paths or (Path.cwd() / "wellfield").exists()
    if (seen and re.fullmatch(r"local(\[[^\]]*\])?", context.master)) or getattr(context, "_wellfield_shipped", False):
        return
    context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/wellfield", "zip", ROOT, "wellfield"))
    context._wellfield_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Only on a local master, where one
    machine does all, an unset one becomes a temporary folder; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="wellfield-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
