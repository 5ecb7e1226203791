"""Incremental ingest of NDJSON files as a stream.

Every micro-batch writes the rows that fit and those that do not to folders of its own, and then one
record to the log beside the table.  The record publishes both at once: readers take the folders
that the log names, so they see a batch wholly or not at all.  A batch that fails before its record
is written is repeated by the stream and replaces its folders; one that failed after it is left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.errors import AnalysisException

from foretell import schema as S
from foretell.operators.conform import as_schema, cast

CORRUPT = "_corrupt_record"
BATCH = "batch_id"
#: a record covers the batches ``first`` to ``last``; ``rows`` and ``rejected`` name their folders, and how many rows they hold
LOG = "first long, last long, rows string, rejected string, n_rows long, n_rejected long"


def _checked(raw: DataFrame, table: S.Table) -> DataFrame:
    """Every column cast leniently, with the names of the columns that do not fit."""
    casts = {n: cast(raw, n, c.type, lenient=True) for n, c in table.columns.items()}
    wrong = [
        F.when((F.col(n).isNotNull() & casts[n].isNull()) | (F.col(n).isNull() & F.lit(not c.nullable)), F.lit(n))
        for n, c in table.columns.items()
    ]
    malformed = F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT))
    return raw.select(
        F.struct(*[casts[n].alias(n) for n in table.columns]).alias("row"),
        F.struct(*table.columns, CORRUPT).alias("raw"),
        F.array_compact(F.array(malformed, *wrong)).alias("errors"),
    )


def _write(rows: DataFrame, path: str) -> int:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).count()  # from the footers


def _publish(spark: SparkSession, table: str, record: tuple) -> None:
    """One record; the file of it appears when it is complete."""
    spark.createDataFrame([record], LOG).coalesce(1).write.mode("append").json(_log_path(table))


def _log_path(table: str) -> str:
    return table.rstrip("/") + ".log"


def log(spark: SparkSession, table: str) -> list:
    """The records in force, by batch: of those that cover a batch the one that covers most."""
    try:
        records = spark.read.schema(LOG).json(_log_path(table)).collect()  # a record a batch, fewer after compaction
    except AnalysisException:
        return []  # nothing was published yet
    out: list = []
    for r in sorted(records, key=lambda r: (r["first"], -r["last"], r["rows"])):
        if not out or r["first"] > out[-1]["last"]:
            out.append(r)
    return out


def ingest_stream(spark: SparkSession, source: str, schema, table: str, rejected: str, checkpoint: str,
                  trigger: dict | None = None, max_files: int | None = None) -> StreamingQuery:
    """Loads new NDJSON files under ``source`` into ``table``, conformed to ``schema``.

    Rows that do not fit go to ``rejected`` as they came, with the columns at fault.  A batch that is
    repeated after a failure is not loaded twice.
    """
    columns = as_schema(schema)
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in [*columns.columns, CORRUPT]])
    reader = spark.readStream.schema(as_text).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    checked = _checked(reader.json(source), columns)

    def load(batch: DataFrame, batch_id: int) -> None:
        if any(r["first"] <= batch_id <= r["last"] for r in log(batch.sparkSession, table)):
            return
        batch.persist()
        fits = F.size("errors") == 0
        folders = [f"{path}/{BATCH}={batch_id}" for path in (table, rejected)]
        counts = [_write(batch.where(fits).select("row.*"), folders[0]), _write(batch.where(~fits).select("raw.*", "errors"), folders[1])]
        _publish(batch.sparkSession, table, (batch_id, batch_id, *folders, *counts))
        batch.unpersist()

    return (
        checked.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _read(spark: SparkSession, folders: list, kind: T.StructType) -> DataFrame:
    return spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)


def loaded(spark: SparkSession, table: str, schema) -> DataFrame:
    """The rows a stream has published so far; a later batch does not change what this frame reads."""
    columns = as_schema(schema)
    kind = T.StructType([T.StructField(n, S.SPARK_TYPES[c.type]) for n, c in columns.columns.items()])
    return S.attach(_read(spark, [r["rows"] for r in log(spark, table)], kind), columns)


def rejects(spark: SparkSession, table: str, schema) -> DataFrame:
    """The rows that did not fit, of the same batches, with the columns at fault."""
    names = [*as_schema(schema).columns, CORRUPT]
    kind = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("errors", T.ArrayType(T.StringType()))])
    return _read(spark, [r["rejected"] for r in log(spark, table)], kind)


def compact_stream(spark: SparkSession, table: str, schema, rejected: str) -> int:
    """Puts the small files of all published batches into few; returns the number of batches.

    The new folders are published by one record that covers these batches; what reads the old ones
    meanwhile still finds them.
    """
    records = log(spark, table)
    if len(records) < 2:
        return 0
    first, last = records[0]["first"], records[-1]["last"]
    folders = [f"{path.rstrip('/')}.compact/{first}-{last}" for path in (table, rejected)]
    counts = [_write(loaded(spark, table, schema).hint("rebalance"), folders[0]), _write(rejects(spark, table, schema).hint("rebalance"), folders[1])]
    _publish(spark, table, (first, last, *folders, *counts))
    return last - first + 1


def progress(query: StreamingQuery) -> list:
    """Rows and rows per second of the recent micro-batches."""
    return [
        {"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"]}
        for p in query.recentProgress
    ]
