"""Shared storage for intermediate results, and small helpers on it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a ``local[...]`` session, where the driver is the only executor, gets a
    temporary folder when the setting is absent; a cluster without it is an error.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="ledgerloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; its lineage ends there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name in shared storage that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` begins with it."""
    name = f"_{name}"
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    return name
