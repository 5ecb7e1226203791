"""Search: filter, project, order, page; and hits without null fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.functions.predicates import column_name, condition, paths
from foretell.operators.index import deep_page
from foretell.operators.links import bind

DEEP = 10_000  # rows before a page that a plain top-n may carry along


def filter_rows(df: DataFrame, where: dict | None, tables: dict | None = None) -> DataFrame:
    """Rows that satisfy every proposition of ``where``."""
    bound = bind(df, paths(where), tables)
    return bound.where(condition(bound, where)) if where else bound


def select(df: DataFrame, fields: list, tables: dict | None = None) -> DataFrame:
    """Plain fields and linked fields (``link.field`` arrives as ``link__field``)."""
    return bind(df, fields, tables).select(*[column_name(f) for f in fields])


def _order_keys(order_by) -> list:
    """``(Column, falling)`` of order keys ``"f"``, ``{"$asc": "f"}``, ``{"$desc": "f"}``; other Columns as they are."""
    if order_by is None:
        return []
    keys = order_by if isinstance(order_by, (list, tuple)) else [order_by]
    out = []
    for k in keys:
        if isinstance(k, Column):
            out.append((k, None))
        elif isinstance(k, dict):
            (how, name), = k.items()
            out.append((F.col(column_name(name)), how == "$desc"))
        else:
            out.append((F.col(column_name(k)), False))
    return out


def _order_paths(order_by) -> list:
    keys = order_by if isinstance(order_by, (list, tuple)) else [order_by]
    names = [next(iter(k.values())) if isinstance(k, dict) else k for k in keys]
    return [n for n in names if isinstance(n, str)]


def page(df: DataFrame, order_by=None, offset: int = 0, limit: int | None = 10) -> DataFrame:
    """One page in the given order, which should end in a unique key.

    A page behind ``DEEP`` rows is found by counting ranges of the key (at once, in a few passes).
    """
    keys = _order_keys(order_by)
    if offset > DEEP and keys and all(falling is not None for _, falling in keys):
        return deep_page(df, [k for k, _ in keys], [falling for _, falling in keys], offset, limit)
    ordered = df.orderBy(*[k if falling is None else k.desc() if falling else k.asc() for k, falling in keys]) if keys else df
    if offset:
        ordered = ordered.offset(offset)
    return ordered if limit is None else ordered.limit(limit)


def search(df: DataFrame, where=None, select_fields=None, order_by=None, offset=0, limit=10,
           tables=None) -> DataFrame:
    """Filter, order, page and project in one plan; the filter reaches the scan."""
    needed = paths(where) + list(select_fields or []) + _order_paths(order_by)
    bound = bind(df, needed, tables)
    kept = bound.where(condition(bound, where)) if where else bound
    hits = page(kept, order_by, offset, limit)
    fields = [column_name(f) for f in select_fields] if select_fields else df.columns
    return hits.select(*fields)


def total(df: DataFrame, where=None, tables=None) -> DataFrame:
    """Number of rows a search finds, whatever its page."""
    return filter_rows(df, where, tables).agg(F.count("*").alias("total"))


def table_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("size"))


def top(df: DataFrame) -> DataFrame:
    """The best hit of ranked results (of each query, if there are several)."""
    return df.where(F.col("rank") == 1)


def to_hits(df: DataFrame, name: str = "hit") -> DataFrame:
    """Rows as JSON objects; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"}).alias(name))
