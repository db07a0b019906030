"""Session helpers: table loading and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session on one machine's threads that has no such setting gets one, in a
    folder that goes when the process ends; elsewhere a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_root()


@cache
def _own_root() -> str:
    root = tempfile.mkdtemp(prefix="tableloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table written once to the shared folder and read back.

    For an intermediate result that several passes read; unlike a cache it
    survives the loss of executors.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
