"""Bringing a DataFrame to a table schema: casts, null rules and user functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell import schema as S

DATETIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
FRACTIONS = (T.FloatType, T.DoubleType)


def as_schema(schema) -> S.Table:
    if isinstance(schema, S.Table):
        return schema
    if isinstance(schema, dict):
        return S.Table.from_json(schema)
    raise S.SchemaError("a table schema is a Table or its JSON form")


def is_null(df: DataFrame, name: str) -> Column:
    """Null or, in a floating point column, NaN."""
    c = F.col(name)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[name].dataType, FRACTIONS) else c.isNull()


def cast(df: DataFrame, name: str, target: str, lenient: bool = False) -> Column:
    """The column as ``target``; a malformed value fails, or gives null if ``lenient``."""
    source = df.schema[name].dataType
    c = F.when(~is_null(df, name), F.col(name))
    to = (lambda x, t: x.try_cast(t)) if lenient else (lambda x, t: x.cast(t))
    if target == S.INT and isinstance(source, T.StringType):
        return to(to(c, "double"), "int")  # '345.33' is 345
    return to(c, S.SPARK_TYPES[target].simpleString())


def conform(df: DataFrame, schema, check: bool = True) -> DataFrame:
    """Shared columns cast to the types of ``schema``; other columns stay as they are.

    With ``check``, a null in a non-nullable column raises an error naming the column
    while the rows are computed, without a pass of its own.
    """
    columns = as_schema(schema).columns
    casts = {}
    for name in df.columns:
        if name not in columns:
            continue
        value = cast(df, name, columns[name].type)
        if check and not columns[name].nullable:
            failure = F.raise_error(F.lit(f"column `{name}` is null but the schema says it is not nullable"))
            value = F.when(is_null(df, name), failure.cast(S.SPARK_TYPES[columns[name].type])).otherwise(value)
        casts[name] = value
    return S.attach(df.withColumns(casts), as_schema(schema))


def null_counts(df: DataFrame, schema) -> DataFrame:
    """``(column, nulls)`` of the non-nullable columns; one aggregation over all of them."""
    strict = [n for n, c in as_schema(schema).columns.items() if not c.nullable and n in df.columns]
    counts = df.agg(*[F.count_if(is_null(df, n)).alias(f"n{i}") for i, n in enumerate(strict)]) if strict else df.agg(F.count("*"))
    rows = [F.struct(F.lit(n).alias("column"), F.col(f"n{i}").alias("nulls")) for i, n in enumerate(strict)]
    return counts.select(F.inline(F.array(*rows).cast("array<struct<column:string,nulls:bigint>>")))


def check_not_null(df: DataFrame, schema) -> None:
    """Raises if a non-nullable column holds a null."""
    bad = [r["column"] for r in null_counts(df, schema).where("nulls > 0").collect()]
    if bad:
        raise ValueError(f"columns {bad} hold nulls but the schema says they are not nullable")


def schema_diff(df: DataFrame, schema) -> dict:
    """Columns that only the data or only the schema has; needs no job."""
    columns = as_schema(schema).columns
    return {
        "only_in_data": [n for n in df.columns if n not in columns],
        "only_in_schema": [n for n in columns if n not in df.columns],
    }


def datetimes_to_string(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, DATETIMES)]
    return df.withColumns({n: F.col(n).cast("string") for n in names}) if names else df


def apply_functions(df: DataFrame, functions: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Date and time columns become strings, then the user's functions run in order."""
    df = datetimes_to_string(df)
    for f in functions:
        df = df.transform(f)
    return df
