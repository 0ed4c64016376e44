"""Session defaults and the shared scratch folder that multi-pass operators write to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "tallyloom", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench share."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Parquet files are several times smaller than their rows; without this a fact table
        # can pass for small enough to broadcast.
        "spark.sql.sources.fileCompressionFactor": "4.0",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine, as in tests, which goes when the program
    ends; on a cluster an unset folder is an error, because a lost executor would take its machine-local files along.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, _local_scratch[app], ignore_errors=True)
    return _local_scratch[app]


def _application_folder(spark: SparkSession) -> str:
    return os.path.join(scratch_root(spark), "tallyloom", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the scratch folder."""
    return os.path.join(_application_folder(spark), f"{label}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application parked; frames that read it are of no use afterwards."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def park(df: DataFrame, label: str = "parked") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    This cuts the lineage: later passes read stored rows, so a column that depends on
    partition placement keeps its value when a task is retried or an executor is lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
