"""Rows and queries as sets of features, the evidence of the predictive operators.

A Boolean, Int, Decimal or String field gives one feature ``field=value``; a Text field
gives ``field:token`` for each distinct token; null gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.analyzers import analyze
from foretell.functions.predicates import column_name, proposition

EMPTY = "array<string>"


def field_features(path: str, value: Column, a: S.Analyzer | None) -> Column:
    """Features of one field, named after its ``path``."""
    if a is not None:
        found = F.transform(F.array_distinct(analyze(value, a)), lambda t: F.concat(F.lit(path + ":"), t))
    else:
        found = F.array(F.concat(F.lit(path + "="), value.cast("string")))
    return F.when(value.isNotNull(), found).otherwise(F.array().cast(EMPTY))


def row_features(df: DataFrame, fields: list, like: DataFrame | None = None, sources: dict | None = None) -> Column:
    """All features of a row over ``fields``.

    ``sources`` names the column of ``df`` that stands for a field, and ``like`` is the
    table whose types and analyzers apply then.
    """
    like = df if like is None else like
    parts = []
    for path in fields:
        name = column_name(path)
        value = F.col(name if sources is None else column_name(sources[path]))
        parts.append(field_features(path, value.cast(like.schema[name].dataType), S.analyzer_of(like, name)))
    return F.concat(*parts) if parts else F.array().cast(EMPTY)


def classes(df: DataFrame, path: str) -> Column:
    """The answers a row votes for: its value, or each distinct token of a Text field."""
    name = column_name(path)
    a = S.analyzer_of(df, name)
    return F.array_distinct(analyze(name, a)) if a else F.array(F.col(name).cast("string"))


@dataclass
class Evidence:
    """Evidence of one query: its features and, per row, which of them the row has."""

    names: list
    matched: Column


def query_evidence(df: DataFrame, where: dict | None) -> Evidence:
    """Evidence of a ``where`` against the columns of ``df``.

    Plain values become features (text by its tokens); any other proposition is one
    feature that a row has when the condition holds.  Only the query's own text is
    analysed here, on a one-row relation that Spark evaluates without a job.
    """
    plain, names, parts = {}, [], []
    for path, value in (where or {}).items():
        if path != "$exists" and value is None:
            continue
        if path == "$exists" or isinstance(value, dict):
            text = value.get("$match") if isinstance(value, dict) and set(value) == {"$match"} else None
            if text is not None and S.analyzer_of(df, column_name(path)):
                plain[path] = text
                continue
            label = f"{path}:{value}"
            names.append(label)
            parts.append(F.when(proposition(df, path, value), F.array(F.lit(label))).otherwise(F.array().cast(EMPTY)))
        else:
            plain[path] = value
    if plain:
        literals = [
            field_features(path, F.lit(value).cast(df.schema[column_name(path)].dataType),
                           S.analyzer_of(df, column_name(path)))
            for path, value in plain.items()
        ]
        row = df.sparkSession.sql("SELECT 1 AS one").select(F.concat(*literals).alias("f")).first()
        wanted = list(row["f"])
        names = wanted + names
        if wanted:
            literal = F.array(*[F.lit(w) for w in wanted])
            parts.insert(0, F.array_intersect(row_features(df, list(plain)), literal))
    return Evidence(names, F.concat(*parts) if parts else F.array().cast(EMPTY))
