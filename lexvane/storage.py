"""Cutting lineage with tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

# Temporary folders of local sessions without the setting, by application.
_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session without the setting gets a temporary folder of its
    own; on a cluster the setting is needed, since executors share no disk.
    """
    folder = spark.conf.get(SETTING, "") or ""
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    application = spark.conf.get("spark.app.id", "")
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="lexvane-")
    return _own_folders[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A path not used before inside the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once as Parquet and read back.

    Later jobs start from the files: nothing upstream is computed again, also
    after executors are lost, and they read only the columns they need.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few large pieces to all cores.

    For a table read from storage whose files do not split into enough pieces
    for the cores (one file, one row group) before costly work on its texts.
    A table of many pieces is left as it is, so large inputs are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
