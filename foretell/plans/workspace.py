"""Where written tables go: the folder the session names for shared data."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


_own: dict = {}  # folder of each one-process session that names none, as in tests


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, else the warehouse folder, which a cluster shares.

    A session of one process (master ``local`` or ``local[n]``) without a setting gets a
    folder of its own.
    """
    found = spark.conf.get(SETTING, None)
    if not found and re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="foretell-")
        found = _own[app]
    return (found or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never one that is in use."""
    return f"{shared_dir(spark)}/foretell/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Cuts the lineage: what follows never computes ``df`` again, and a lost executor loses
    none of it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
