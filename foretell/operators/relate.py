"""Relate: which features of a field go together with a condition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.functions.features import field_features
from foretell.functions.predicates import column_name, condition, paths
from foretell.operators.counts import SCORE_DIGITS, take_best
from foretell.operators.links import bind
from foretell import schema as S


def _mutual_information(n, f, cond, both):
    """Of the 2x2 table of feature and condition, one half added to every cell."""
    cells = {
        (1, 1): both + 0.5,
        (1, 0): f - both + 0.5,
        (0, 1): cond - both + 0.5,
        (0, 0): n - f - cond + both + 0.5,
    }
    total = n + 2.0
    parts = []
    for (i, j), cell in cells.items():
        row = cells[i, 0] + cells[i, 1]
        column = cells[0, j] + cells[1, j]
        parts.append(cell / total * F.log(cell * total / (row * column)))
    return parts[0] + parts[1] + parts[2] + parts[3]


def relate(df: DataFrame, where: dict | None, field: str, limit: int | None = 10,
           tables: dict | None = None) -> DataFrame:
    """``(feature, fs, ps, lift, mi, rank)``, strongest relation first; one aggregation over features.

    Without a limit every feature is returned, and no rank, which would sort them all.
    """
    bound = bind(df, [*paths(where), field], tables)
    name = column_name(field)
    held = F.coalesce(condition(bound, where), F.lit(False)).alias("c")
    features = field_features(field, F.col(name), S.analyzer_of(bound, name))
    all_rows = bound.select(held).agg(F.struct(F.count("*").alias("n"), F.count_if("c").alias("cond"))).scalar()
    counts = (
        bound.select(held, F.explode(features).alias("feature"))
        .groupBy("feature").agg(F.count("*").alias("f"), F.count_if("c").alias("both"))
        .withColumn("t", all_rows)
        .select("feature", F.col("t.n").alias("n"), "f", F.col("t.cond").alias("cond"), "both")
    )
    n, f, cond, both = (F.col(c) for c in ("n", "f", "cond", "both"))
    p = (f + 1.0) / (n + 2.0)
    p_on = (both + 1.0) / (cond + 2.0)
    p_off = (f - both + 1.0) / (n - cond + 2.0)
    found = counts.select(
        "feature",
        F.struct(n.alias("n"), f.alias("f"), cond.alias("cond"), both.alias("f_on_cond"),
                 (f - both).alias("f_on_not_cond")).alias("fs"),
        F.struct(p.alias("p"), p_on.alias("p_on_cond"), p_off.alias("p_on_not_cond")).alias("ps"),
        (p_on / p).alias("lift"),
        _mutual_information(n, f, cond, both).alias("mi"),
    )
    if limit is None:
        return found
    return take_best(found, [-F.round("mi", SCORE_DIGITS), F.col("feature")], limit)
