"""Reading and writing files by format."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell.sources.records import read_records

FORMATS = ("csv", "json", "ndjson", "parquet")  # fixed values
COMMA_NUMBER = r"^\s*[+-]?\d+(,\d+)?\s*$"


def detect_format(path: str, fmt: str | None = None) -> str:
    """Format from the first suffix of the file name (``x.csv.gz`` is csv) unless given."""
    if fmt is None:
        suffixes = PurePosixPath(path).suffixes
        fmt = suffixes[0][1:] if suffixes else ""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r} of {path!r}, expected one of {FORMATS}")
    return fmt


def table_name(path: str) -> str:
    """File name without its suffixes."""
    return PurePosixPath(path).name.split(".")[0]


def read_csv(spark: SparkSession, path: str, delimiter: str = ",", decimal: str = ".", multi_line: bool = True,
             **options) -> DataFrame:
    """CSV with a header, all columns as strings; surplus trailing fields are dropped.

    ``multi_line`` allows line breaks inside quotes; such files are read in many tasks too (see
    ``records``), unless other options are given, which go to Spark's own reader and win: it
    makes a file one task then.  ``decimal=','`` turns the columns whose values are all
    comma decimals into numbers (one aggregation).
    """
    settings = {"header": True, "sep": delimiter, "quote": '"', "escape": '"', "multiLine": multi_line,
                "mode": "PERMISSIVE", "enforceSchema": True, **options}
    df = spark.read.options(**settings).csv(path)
    if multi_line and not options and len(delimiter) == 1 and df.columns:
        df = read_records(spark, path, df.columns, delimiter, '"', {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return _comma_decimals(df) if decimal == "," else df


def _comma_decimals(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counted = df.agg(
        *[F.struct(F.count(c).alias("filled"), F.count_if(F.col(c).rlike(COMMA_NUMBER)).alias("numbers"),
                   F.count_if(F.col(c).contains(",")).alias("commas")).alias(c) for c in texts]
    ).first()
    numeric = [c for c in texts if counted[c]["commas"] and counted[c]["filled"] == counted[c]["numbers"]]
    return df.withColumns({c: F.regexp_replace(c, ",", ".").cast("double") for c in numeric}) if numeric else df


def read_json(spark: SparkSession, path: str, **options) -> DataFrame:
    """A JSON array of records per file."""
    return spark.read.options(**{"multiLine": True, **options}).json(path)


def read_ndjson(spark: SparkSession, path: str, **options) -> DataFrame:
    """One JSON object per line, plain or compressed."""
    return spark.read.options(**options).json(path)


def read_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def read_sql(spark: SparkSession, url: str, query: str, partition: tuple | None = None, **options) -> DataFrame:
    """Result of a query on an external database over JDBC.

    ``partition = (column, lower, upper, count)`` reads in that many parallel ranges.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition is None:
        reader = reader.option("query", query)
    else:
        column, lower, upper, count = partition
        reader = (
            reader.option("dbtable", f"({query}) q").option("partitionColumn", column)
            .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", count)
        )
    return reader.options(**options).load()


READERS = {"csv": read_csv, "json": read_json, "ndjson": read_ndjson, "parquet": read_parquet}


def read(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    return READERS[detect_format(path, fmt)](spark, path, **options)


def write_ndjson(df: DataFrame, path: str, gzip: bool = False, mode: str = "error") -> None:
    """One JSON object per line, nulls written out."""
    settings = {"ignoreNullFields": "false", "compression": "gzip" if gzip else "none"}
    df.write.mode(mode).options(**settings).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "error", **options) -> None:
    df.write.mode(mode).options(**{"header": True, "quote": '"', "escape": '"', **options}).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error", **options) -> None:
    df.write.mode(mode).options(**options).parquet(path)


def write(df: DataFrame, path: str, fmt: str, mode: str = "error", **options) -> None:
    if fmt == "csv":
        write_csv(df, path, mode, **options)
    elif fmt == "parquet":
        write_parquet(df, path, mode, **options)
    elif fmt == "ndjson":
        write_ndjson(df, path, mode=mode, **options)
    else:
        raise ValueError(f"cannot write {fmt!r}; records go out as ndjson")
