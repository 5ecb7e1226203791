"""Predict a field from evidence: one query, answered in one pass over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.features import classes, query_evidence
from foretell.functions.predicates import column_name, paths
from foretell.operators.counts import baseline, best_first, gain, log_sum_exp, take_best, unnest
from foretell.operators.links import bind

ROW = ""  # marks the row itself next to its features; a real feature is never empty


def _totals(counted: DataFrame, name: str, n: str):
    """Feature -> count as one map; it holds the query's own features and nothing else."""
    return counted.agg(F.map_from_entries(F.collect_list(F.struct(name, n)))).scalar()


def predict(df: DataFrame, where: dict | None, target: str, limit: int | None = 10, tables: dict | None = None,
            explain: bool = False, among: DataFrame | None = None) -> DataFrame:
    """Ranked answers ``(field, feature, p, rank[, why])`` for ``target``.

    With ``among`` (a column ``feature``) only those answers are ranked; probabilities stay
    those among all answers.

    Each row is reduced to its answer and to the features it shares with the query before
    anything is shuffled; the counts per (answer, feature) are combined map-side.
    """
    bound = bind(df, [*paths(where), target], tables)
    evidence = query_evidence(bound, where)
    h = F.lit(len(evidence.names))
    rows = bound.where(F.col(column_name(target)).isNotNull()).select(
        classes(bound, target).alias("feature"), F.concat(F.array(F.lit(ROW)), evidence.matched).alias("f")
    )
    pairs = (
        rows.select(unnest("feature").alias("feature"), "f")
        .where(F.col("feature").isNotNull())
        .select("feature", unnest("f").alias("f"))
        .groupBy("feature", "f")
        .agg(F.count("*").alias("n"))
    )
    def best(scored):
        return take_best(scored if among is None else scored.join(among, "feature", "left_semi"),
                         best_first("score", "size", h), limit)

    exclusive = S.analyzer_of(bound, column_name(target)) is None
    seen = F.col("f") != ROW
    size = F.max(F.when(~seen, F.col("n")))
    extra = [F.map_from_entries(F.collect_list(F.struct("f", "n"))).alias("seen")] if explain else []

    if exclusive:
        counted = pairs.groupBy("feature").agg(
            size.alias("size"), F.sum(F.when(seen, gain(F.col("n"))).otherwise(0.0)).alias("gain"), *extra
        )
        scored = counted.withColumn("score", baseline(F.col("size"), h) + F.col("gain"))
        ranked = best(scored)
        ranked = ranked.withColumn("p", F.exp(F.col("score") - log_sum_exp(scored, [], F.col("score")).scalar()))
        n_classes = scored.agg(F.count("*")).scalar() if explain else None
        totals = _totals(pairs.groupBy("f").agg(F.sum("n").alias("n")), "f", "n") if explain else None
    else:
        totals = _totals(rows.select(unnest("f").alias("f")).groupBy("f").agg(F.count("*").alias("n")), "f", "n")
        counted = (
            pairs.withColumn("n_f", F.try_element_at(totals, F.col("f")))
            .groupBy("feature")
            .agg(size.alias("size"),
                 F.sum(F.when(seen, gain(F.col("n"), F.col("n_f"))).otherwise(0.0)).alias("gain"), *extra)
            .withColumn("totals", totals)
        )
        known = F.array(*[F.lit(n) for n in evidence.names]) if evidence.names else F.array().cast("array<string>")
        absent = F.reduce(
            known, F.lit(0.0),
            lambda acc, f: acc + F.log(F.coalesce(F.try_element_at("totals", f), F.lit(0)) + 1.0),
        )
        n_rows = F.try_element_at("totals", F.lit(ROW))
        scored = counted.withColumn("score", baseline(F.col("size"), h, n_rows) + F.col("gain") - absent)
        ranked = best(scored)
        ranked = ranked.withColumn("p", 1.0 / (1.0 + F.exp(-F.col("score"))))
        n_classes = F.lit(2)

    out = [F.lit(target).alias("field"), "feature", "p", "rank"]
    if explain:
        ranked = ranked.withColumn("_t", totals).withColumn("_k", n_classes)
        out.append(_why(evidence.names).alias("why"))
    return ranked.select(*out)


def _why(names: list):
    """``[(feature, lift)]``: the prior first, then P(feature | answer) / P(feature)."""
    n = F.try_element_at("_t", F.lit(ROW))
    prior = F.struct(F.lit("prior").alias("feature"), ((F.col("size") + 1.0) / (n + F.col("_k"))).alias("lift"))

    def lift(name):
        on_class = (F.coalesce(F.try_element_at("seen", F.lit(name)), F.lit(0)) + 1.0) / (F.col("size") + 2.0)
        overall = (F.coalesce(F.try_element_at("_t", F.lit(name)), F.lit(0)) + 1.0) / (n + 2.0)
        return F.struct(F.lit(name).alias("feature"), (on_class / overall).alias("lift"))

    return F.array(prior, *[lift(name) for name in names])
