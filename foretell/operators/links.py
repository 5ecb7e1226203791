"""Following links: a link column brings in the fields of the row it points to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.predicates import INDEX, column_name


def with_link(df: DataFrame, link_column: str, tables: dict, fields: list | None = None) -> DataFrame:
    """Left join of the linked table; its fields arrive as ``<link column>__<field>``.

    The join is a plain equi-join on the linked key, so Spark broadcasts the linked table
    only when its own size check allows it and otherwise shuffles, splitting hot keys.
    """
    link = S.link_of(df, link_column)
    if link is None:
        raise ValueError(f"column {link_column!r} has no link")
    if link.table not in tables:
        raise ValueError(f"linked table {link.table!r} is not known")
    linked = tables[link.table]
    if link.column not in linked.columns:
        raise ValueError(f"linked table {link.table!r} has no column {link.column!r}")
    wanted = sorted(linked.columns) if fields is None else list(fields)
    missing = [f for f in wanted if f not in linked.columns]
    if missing:
        raise ValueError(f"linked table {link.table!r} has no columns {missing}")
    key = f"_{link_column}_key"
    side = linked.select(F.col(link.column).alias(key), *[F.col(f).alias(f"{link_column}__{f}") for f in wanted])
    return df.join(side, df[link_column] == side[key], "left").drop(key)


def bind(df: DataFrame, paths: list, tables: dict | None) -> DataFrame:
    """``df`` with a column for every path: plain fields are checked, linked fields joined."""
    linked: dict = {}
    for path in dict.fromkeys(paths):
        if path == "$index":
            if INDEX not in df.columns:
                raise ValueError("$index needs a row order: number the rows with with_index first")
            continue
        head, _, field = path.partition(".")
        if field and column_name(path) in df.columns:
            continue
        if head not in df.columns:
            raise ValueError(f"no column {head!r}, there are {df.columns}")
        if field:
            linked.setdefault(head, []).append(field)
    for link_column, fields in linked.items():
        df = with_link(df, link_column, tables or {}, fields)
    return df


def expand_links(df: DataFrame, tables: dict) -> DataFrame:
    """Own columns sorted by name, then all columns of every linked table, one hop."""
    own = sorted(df.columns)
    links = [name for name in own if S.link_of(df, name)]
    for name in links:
        df = with_link(df, name, tables)
    added = [f"{name}__{f}" for name in links for f in sorted(tables[S.link_of(df, name).table].columns)]
    return df.select(*own, *added)
