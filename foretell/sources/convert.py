"""Convert a file: read, apply functions, infer or take a schema, conform, write."""

from __future__ import annotations

from pyspark.sql import SparkSession

from foretell import schema as S
from foretell.operators.conform import apply_functions, as_schema, conform
from foretell.operators.infer import infer_schema
from foretell.sources import files


def convert(spark: SparkSession, src: str, dst: str, in_format: str | None = None, out_format: str | None = None,
            schema=None, functions=(), mode: str = "error", read_options: dict | None = None,
            write_options: dict | None = None) -> S.Table:
    """Always writes ``dst`` and returns the schema it conforms to."""
    source = files.read(spark, src, in_format, **(read_options or {}))
    df = apply_functions(source, functions)
    table = as_schema(schema) if schema is not None else infer_schema(df)
    files.write(conform(df, table), dst, files.detect_format(dst, out_format), mode, **(write_options or {}))
    return table
