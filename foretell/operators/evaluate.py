"""Evaluate predictions on held-out rows; example queries from the first row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.features import classes
from foretell.functions.predicates import INDEX, column_name, condition, paths
from foretell.operators.batch import predict_batch
from foretell.operators.index import with_index
from foretell.operators.links import bind
from foretell.operators.predict import predict
from foretell.plans.workspace import stored

EVERY_TENTH = {"$index": {"$mod": [10, 0]}}  # fixed value: rows held out by quick_evaluate


def paths_of_get(where: dict) -> list:
    return [v["$get"] for v in where.values() if isinstance(v, dict) and set(v) == {"$get"}]


def with_fold(df: DataFrame, fold: Callable[[DataFrame], Column], needed: list, order_by: list | None = None, tables: dict | None = None,
              asked: list = ()) -> DataFrame:
    """The rows with ``_fold``: the fold that holds a row out, null if none does; written once.

    ``needed`` are the fields to keep, ``asked`` those that ``fold`` looks at; linked fields keep all columns.
    """
    if "$index" in asked and INDEX not in df.columns:
        if not order_by:
            raise ValueError("$index needs the row order: give order_by, ending in a unique key")
        df = with_index(df, order_by)
    bound = bind(df, list(asked), tables)
    marked = fold(bound)
    if not any("." in f for f in needed):
        kept = bound.select(*dict.fromkeys([c for c in needed if c in bound.columns]), marked.alias("_fold"))
    else:
        kept = bound.withColumn("_fold", marked)
    return stored(kept, "folds")


def split(df: DataFrame, test: dict, order_by: list | None = None, tables: dict | None = None):
    """``(train, test)``; a row whose test condition is null trains."""
    if "$index" in paths(test) and INDEX not in df.columns:
        if not order_by:
            raise ValueError("$index needs the row order: give order_by, ending in a unique key")
        df = with_index(df, order_by)
    bound = bind(df, paths(test), tables)
    held_out = F.coalesce(condition(bound, test), F.lit(False))
    return bound.where(~held_out), bound.where(held_out)


def _hits(marked: DataFrame, where: dict, target: str, tables: dict | None) -> DataFrame:
    """``(fold, hits, test_samples)`` of the held-out rows with a target.

    What a fold trains on is counted as all rows less its own, for all folds together.  Rows of a fold
    with the same evidence and answer are asked once and counted, so no key is needed.
    """
    held_out = bind(marked.where("_fold IS NOT NULL"), [target], tables)
    sources = {}
    for i, (path, value) in enumerate(where.items()):
        if isinstance(value, dict) and set(value) == {"$get"}:
            sources[path] = value["$get"]
        elif isinstance(value, dict):
            raise ValueError(f"evaluate takes values or $get as evidence, not {value!r}")
        elif value is not None:
            held_out = held_out.withColumn(f"_const{i}", F.lit(value))
            sources[path] = f"_const{i}"
    asked = bind(held_out.where(F.col(column_name(target)).isNotNull()), list(sources.values()), tables)
    same = list(dict.fromkeys([*map(column_name, sources.values()), column_name(target), "_fold"]))
    metadata = {c: asked.schema[c].metadata for c in same}
    asked = asked.groupBy(*same).agg(F.count("*").alias("_times"))
    asked = stored(asked.withColumn("_case", F.sha2(F.to_json(F.struct(*same)), 256)), "cases")
    for c, m in metadata.items():
        asked = asked.withMetadata(c, m)
    first = predict_batch(marked, asked, "_case", {p: column_name(c) for p, c in sources.items()}, target, k=1, tables=tables,
                          with_p=False, fold="_fold")
    actual = asked.select("_case", "_fold", "_times", classes(asked, column_name(target)).alias("actual"))
    return actual.join(first.select("_case", "feature"), "_case", "left").groupBy(F.col("_fold").alias("fold")).agg(
        F.coalesce(F.sum(F.when(F.array_contains("actual", F.col("feature")), F.col("_times"))), F.lit(0)).alias("hits"),
        F.sum("_times").alias("test_samples"),
    )


def evaluate(df: DataFrame, test: dict, where: dict, target: str, key: str | None = None,
             order_by: list | None = None, tables: dict | None = None) -> DataFrame:
    """One row ``(accuracy, test_samples, train_samples)``; a row whose test condition is null trains.

    ``where`` takes values from the test row with ``{"$get": column}``; other values are
    constants.  No key is needed; ``key`` is accepted for callers that have one.
    """
    marked = with_fold(df, lambda rows: F.when(condition(rows, test), F.lit(0).cast("long")), [*where, *paths_of_get(where), target],
                       order_by, tables, paths(test))
    hits = _hits(marked, where, target, tables).agg(
        F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"), F.coalesce(F.sum("test_samples"), F.lit(0)).alias("test_samples"))
    return hits.select(
        F.try_divide(F.col("hits").cast("double"), F.col("test_samples")).alias("accuracy"),
        "test_samples",
        marked.agg(F.count_if(F.col("_fold").isNull())).scalar().alias("train_samples"),
    )


def cross_validate(df: DataFrame, folds: int, where: dict, target: str, order_by: list, tables: dict | None = None) -> DataFrame:
    """A row ``(fold, accuracy, test_samples, train_samples)`` for each of ``folds`` evaluations, in one job.

    Fold ``i`` holds out every row whose position in ``order_by`` leaves the rest ``i``.
    """
    if folds < 2:
        raise ValueError("there must be two folds at least")
    marked = with_fold(df, lambda rows: F.pmod(F.col(INDEX), F.lit(folds)).cast("long"), [*where, *paths_of_get(where), target],
                       order_by, tables, ["$index"])
    rows = marked.groupBy(F.col("_fold").alias("fold")).agg(F.count("*").alias("own"))
    every = rows.select("fold", (marked.agg(F.count("*")).scalar() - F.col("own")).alias("train_samples"))
    return every.join(_hits(marked, where, target, tables), "fold", "left").select(
        "fold", F.try_divide(F.col("hits").cast("double"), F.col("test_samples")).alias("accuracy"),
        F.coalesce("test_samples", F.lit(0)).alias("test_samples"), "train_samples")


def quick_queries(df: DataFrame, target: str, order_by: list, tables: dict | None = None) -> tuple:
    """Example ``(predict, evaluate)`` queries: all other columns are evidence.

    The predict query takes its values from the first row of ``order_by``.
    """
    head, _, field = target.partition(".")
    if head not in df.columns:
        raise ValueError(f"no column {head!r}, there are {df.columns}")
    if field:
        link = S.link_of(df, head)
        if link is None or field not in (tables or {})[link.table].columns:
            raise ValueError(f"no linked field {target!r}")
    first = df.orderBy(*order_by).limit(1).first()
    if first is None:
        raise ValueError("the table is empty")
    fields = [c for c in df.columns if c not in (head, INDEX)]
    return (
        {"where": {c: first[c] for c in fields}, "predict": target, "select": ["$p", "feature", "$why"]},
        {"test": EVERY_TENTH, "evaluate": {"where": {c: {"$get": c} for c in fields}, "predict": target}},
    )


def quick_predict(df: DataFrame, target: str, order_by: list, limit: int = 10, tables: dict | None = None,
                  explain: bool = False) -> DataFrame:
    query, _ = quick_queries(df, target, order_by, tables)
    return predict(df, query["where"], target, limit, tables, explain)


def quick_evaluate(df: DataFrame, target: str, order_by: list, tables: dict | None = None) -> DataFrame:
    _, query = quick_queries(df, target, order_by, tables)
    return evaluate(df, query["test"], query["evaluate"]["where"], target, order_by=order_by, tables=tables)
