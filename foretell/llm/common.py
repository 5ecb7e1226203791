"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import foretell
from foretell.plans.workspace import stored  # noqa: F401 - the operators take it from here

#: characters that separate words, as in the contracts: space and U+0009 to U+000D
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


_sent: dict = {}  # the folder with the archive of each application; goes when the driver ends


def send_package(spark) -> None:
    """Hands this package to Spark once per application, which brings it to every Python worker."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    top = Path(foretell.__file__).parent
    _sent[app] = tempfile.TemporaryDirectory()  # read by the driver alone, which serves the file
    archive = f"{_sent[app].name}/foretell.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(archive)


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInPandas`` with this package at hand in the workers."""
    send_package(df.sparkSession)
    return df.mapInPandas(function, schema)


def load(spark, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def running_start(df: DataFrame, group: str, bucket: str, order: list, weight: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over the rows that stand before, within ``group``.

    Rows stand in the order of ``bucket``, then ``order``.  ``group`` and ``bucket`` must not
    be null.  Only a (group, bucket) is ever sorted in one task; the buckets of a group are
    chained by their sums, of which there are as many as buckets, so a group of any size is
    split as finely as its buckets are.
    """
    sums = df.groupBy(group, bucket).agg(F.sum(weight).alias("_sum"))
    chain = Window.partitionBy(group).orderBy(bucket)
    before = sums.select(group, bucket, (F.sum("_sum").over(chain) - F.col("_sum")).alias("_before"))
    within = Window.partitionBy(group, bucket).orderBy(*order)
    return (
        df.withColumn("_upto", F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(before, [group, bucket])
        .withColumn(name, F.col("_before") + F.col("_upto") - F.col(weight))
        .drop("_before", "_upto")
    )
