"""Ranking linked rows: match (most probable link value) and recommend (best for a goal)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.features import query_evidence
from foretell.functions.predicates import column_name, condition, paths
from foretell.operators.counts import SCORE_DIGITS, take_best
from foretell.operators.links import bind
from foretell.operators.predict import ROW, predict


def attach_entity(best: DataFrame, df: DataFrame, link_column: str, tables: dict | None) -> DataFrame:
    """The linked rows of the ranked keys in ``feature``; without a link, the keys themselves.

    The keys are read in the type of the linked column, so that they reach its scan.
    """
    link = S.link_of(df, link_column)
    if link is None:
        return best
    entity = (tables or {})[link.table]
    keys = best.withColumn("_key", F.col("feature").cast(entity.schema[link.column].dataType)).drop("feature")
    return entity.join(keys, entity[link.column] == keys["_key"]).drop("_key")


def existing_keys(df: DataFrame, link_column: str, tables: dict | None) -> DataFrame | None:
    """The keys of the linked table as ``feature``; a hit that links to no row is no hit."""
    link = S.link_of(df, link_column)
    if link is None:
        return None
    return (tables or {})[link.table].select(F.col(link.column).cast("string").alias("feature"))


def match(df: DataFrame, where: dict | None, link_column: str, limit: int | None = 10,
          tables: dict | None = None, explain: bool = False) -> DataFrame:
    """Rows of the linked table, most probable first: ``entity columns, p, rank[, why]``."""
    among = existing_keys(df, link_column, tables)
    best = predict(df, where, link_column, limit, tables, explain, among).drop("field")
    return attach_entity(best, df, link_column, tables)


def recommend(df: DataFrame, candidate: str, goal: dict, where: dict | None = None,
              limit: int | None = 10, tables: dict | None = None, explain: bool = False) -> DataFrame:
    """Candidates by the probability of ``goal``: ``entity columns or feature, p, rank[, why]``.

    Without ``where`` this is the smoothed rate of the goal among the rows of a candidate;
    with it, a yes/no model of the goal with the candidate and ``where`` as evidence.
    """
    bound = bind(df, [*paths(goal), *paths(where), candidate], tables)
    rows = bound.where(F.col(column_name(candidate)).isNotNull()).withColumn(
        "_goal", F.coalesce(condition(bound, goal), F.lit(False))
    )
    x = F.col(column_name(candidate)).cast("string").alias("feature")
    plain = "." not in candidate
    among = existing_keys(bound, column_name(candidate), tables) if plain else None
    counts = rows.groupBy(x).agg(F.count("*").alias("n"), F.count_if("_goal").alias("good"))
    if where:
        evidence = query_evidence(bound, where)
        has = F.concat(F.array(F.lit(ROW)), evidence.matched)
        per_feature = (  # one entry per feature of the query, plus the row marker
            rows.select("_goal", F.explode(has).alias("f"))
            .groupBy("f").agg(F.count_if("_goal").alias("good"), F.count_if(~F.col("_goal")).alias("bad"))
        )
        found = F.map_from_entries(F.collect_list(F.struct("f", F.struct("good", "bad"))))
        counts = counts.withColumn("t", per_feature.agg(found).scalar())
        row = F.try_element_at("t", F.lit(ROW))

        def odds(good, bad):
            return F.log((good + 1.0) / (row["good"] + 2.0)) - F.log((bad + 1.0) / (row["bad"] + 2.0))

        score = F.log((row["good"] + 1.0) / (row["bad"] + 1.0)) + odds(F.col("good"), F.col("n") - F.col("good"))
        for name in evidence.names:
            f = F.try_element_at("t", F.lit(name))
            score = score + odds(F.coalesce(f["good"], F.lit(0)), F.coalesce(f["bad"], F.lit(0)))
        lifts = [F.struct(F.lit(name).alias("feature"), F.exp(odds(
            F.coalesce(F.try_element_at("t", F.lit(name))["good"], F.lit(0)),
            F.coalesce(F.try_element_at("t", F.lit(name))["bad"], F.lit(0)))).alias("lift")) for name in evidence.names]
        scored = counts.select("feature", "n", "good", (1.0 / (1.0 + F.exp(-score))).alias("p"), F.array(*lifts).alias("lifts"))
    else:
        scored = counts.select("feature", "n", "good", ((F.col("good") + 1.0) / (F.col("n") + 2.0)).alias("p"),
                               F.array().cast("array<struct<feature:string,lift:double>>").alias("lifts"))
    kept = scored if among is None else scored.join(among, "feature", "left_semi")
    best = take_best(kept, [-F.round("p", SCORE_DIGITS), F.col("feature")], limit)
    if explain:  # the goal's rate, the candidate's rate against it, the odds of the rest of the evidence
        rate = rows.agg((F.count_if("_goal") + 1.0) / (F.count("*") + 2.0)).scalar()
        own = (F.col("good") + 1.0) / (F.col("n") + 2.0) / rate
        why = F.concat(F.array(F.struct(F.lit("prior").alias("feature"), rate.alias("lift")),
                               F.struct(F.concat(F.lit(f"{candidate}="), "feature").alias("feature"), own.alias("lift"))), "lifts")
        best = best.withColumn("why", why)
    best = best.select("feature", "p", "rank", *(["why"] if explain else []))
    return attach_entity(best, bound, column_name(candidate), tables) if plain else best
