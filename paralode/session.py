"""Session helpers: a local session for tests and lineage cuts on shared storage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "paralode", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PARALODE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir as the cluster names it; where it is unset, a local folder in local mode and an error elsewhere."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not (context.master.startswith("local[") or context.master == "local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="paralode-checkpoint-"))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for Python workers that do not have it on their path already."""
    root = Path(__file__).resolve().parent
    context = spark.sparkContext
    on_path = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(root.parent) in on_path or context.applicationId in _SHIPPED:
        return
    bundle = Path(tempfile.mkdtemp(prefix="paralode-code-")) / "paralode.zip"
    with zipfile.ZipFile(bundle, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _SHIPPED.add(context.applicationId)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
