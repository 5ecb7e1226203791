"""CSV with line breaks inside quotes, read in many tasks.

Lines are read in splits.  What a line does to the reader depends on whether it begins inside quotes:
it leaves the state as it is, turns it, or sets it.  Such steps combine, so the state before a line is
that of the last line that set it, turned as often as lines have turned it since; the same over
the splits of a file gives the state before each split.  A line that begins and ends outside quotes is a
record; only lines that do not are put together, by their file and the number of their record.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell.plans.workspace import stored


def _patterns(sep: str, quote: str) -> tuple:
    """``(whole, closing)``: a line of whole fields; and the rest of one that begins inside quotes, up to whole fields."""
    s, q = re.escape(sep), re.escape(quote)
    quoted = f"{q}(?:[^{q}]|{q}{q})*+{q}[^{s}]*+"
    field = f"(?:{quoted}|[^{q}{s}][^{s}]*+)?+"
    whole = f"(?s)^{field}(?:{s}{field})*+$"
    closing = f"(?s)^(?:[^{q}]|{q}{q})*+{q}(?!{q})[^{s}]*+(?:{s}{field})*+$"
    return whole, closing


def _step(line: Column, sep: str, quote: str) -> tuple:
    """``(open after outside, open after inside)``: whether the line ends inside quotes, by how it begins."""
    whole, closing = _patterns(sep, quote)
    return ~line.rlike(whole), ~line.rlike(closing)


def _scanned(rows: DataFrame, group: list, order: Column, before: Column) -> DataFrame:
    """Adds ``_open``: the state before each row, from its ``set`` (null if it sets none), ``turns`` and the state before all."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("turns").over(upto), F.lit(0))
    rows = rows.withColumn("_turned", turned + F.when(F.col("set").isNull(), F.col("turns")).otherwise(0))
    last = F.last(F.when(F.col("set").isNotNull(), F.struct("set", "_turned")), ignorenulls=True).over(upto)
    state = F.coalesce(last["set"].cast("int"), before) + turned - F.coalesce(last["_turned"], F.lit(0))
    return rows.withColumn("_open", F.pmod(state, F.lit(2)).cast("int")).drop("_turned")


def read_records(spark: SparkSession, path: str, columns: list, sep: str, quote: str, settings: dict) -> DataFrame:
    """The records of CSV files as columns of strings; the first record of each file is its header."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"))
    after_out, after_in = _step(F.regexp_replace("value", r"\r$", ""), sep, quote)
    lines = lines.withColumns({"_a": after_out.cast("int"), "_b": after_in.cast("int")}).withColumns({
        "set": F.when(F.col("_a") == F.col("_b"), F.col("_a")),
        "turns": F.when((F.col("_a") == 1) & (F.col("_b") == 0), 1).otherwise(0)}).drop("_a", "_b")
    own = ["file", "split"]
    # what a split does: what its last setting line sets, turned as often as lines behind that turn it
    lines = _scanned(lines, own, F.col("place"), F.lit(0)).withColumnRenamed("_open", "from0")
    lines = lines.withColumn("fixed", F.max(F.col("set").isNotNull().cast("int")).over(
        Window.partitionBy(*own).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)) == 1)
    # a line that begins in the state ``s`` ends in: what it sets, or ``s`` turned
    end = F.coalesce(F.col("set"), F.pmod(F.col("from0") + F.col("turns"), F.lit(2)))
    splits = lines.groupBy(*own).agg(
        F.max_by(end, "place").alias("end0"), (F.max(F.col("set").isNotNull().cast("int")) == 1).alias("sets"))
    splits = splits.select(*own, F.when(F.col("sets"), F.col("end0")).alias("set"), F.when(~F.col("sets"), F.col("end0")).otherwise(0).alias("turns"))
    splits = _scanned(splits, ["file"], F.col("split"), F.lit(0)).select(*own, F.col("_open").alias("enters"))
    lines = lines.join(splits, own).withColumn(
        "begins", F.when(F.coalesce("fixed", F.lit(False)), F.col("from0")).otherwise(F.pmod(F.col("from0") + F.col("enters"), F.lit(2))))
    lines = lines.withColumn("ends", F.coalesce(F.col("set"), F.pmod(F.col("begins") + F.col("turns"), F.lit(2))))
    lines = stored(lines.select(*own, "place", "value", "begins", "ends"), "csv-lines")  # it is used four times below
    # records are counted by the lines that begin them
    starts = lines.groupBy(*own).agg(F.sum(1 - F.col("begins")).alias("n"))
    before = starts.select(*own, (F.sum("n").over(Window.partitionBy("file").orderBy("split")) - F.col("n")).alias("before"))
    upto = Window.partitionBy(*own).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_n", F.sum(1 - F.col("begins")).over(upto)).join(before, own).withColumn("record", F.col("_n") + F.col("before"))
    single = lines.where("begins = 0 AND ends = 0").select("file", "record", "value")
    parts = lines.where("begins = 1 OR ends = 1").groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("split", "place", "value"))).alias("l"))
    # as in Spark's reader, a file whose first line ends in CR LF has LF in its values
    ends = lines.groupBy("file").agg(F.min_by(F.col("value").endswith("\r"), F.struct("split", "place")).alias("crlf"))
    whole = F.array_join(F.transform("l", lambda x: x["value"]), "\n")
    joined = parts.join(ends, "file").select("file", "record", F.when(F.col("crlf"), F.replace(whole, F.lit("\r\n"), F.lit("\n"))).otherwise(whole).alias("value"))
    records = single.unionByName(joined).withColumn("value", F.regexp_replace("value", r"\r$", ""))
    kept = records.where((F.col("record") > 1) & (F.trim("value") != ""))
    kind = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))])
    parsed = kept.select(F.from_csv("value", kind.simpleString()[len("struct<"):-1].replace(":", " "), settings).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)])
