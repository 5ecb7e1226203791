"""Similarity: rows most like an example, by the cosine of idf-weighted features.

An ``Index`` holds what a query needs: the postings (feature, row) in the order of features; how often each
feature occurs; the norm of each row; and the number of rows.  Every row is tokenised once, when it is added,
and its postings are sorted once, as a part of the index; a query reads those of its own features alone.  Rows
that are added later change the frequencies and with them all norms, which are made anew from the stored rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.functions.features import query_evidence, row_features
from foretell.functions.predicates import paths
from foretell.operators.counts import SCORE_DIGITS, take_best, unnest
from foretell.operators.links import bind
from foretell.operators.skew import ROWS_PER_SALT, common_join
from foretell.plans.workspace import stored


def squared_idf(frequency: Column, n: int) -> Column:
    idf = F.log((F.lit(n) + 1.0) / (frequency + 1.0)) + 1.0
    return idf * idf


def _postings(df: DataFrame, fields: list, key: str, tables: dict | None) -> DataFrame:
    """``(key, feature)``; a row without features keeps one entry, with a null feature."""
    bound = bind(df, fields, tables)
    return bound.select(F.col(key).alias("key"), unnest(row_features(bound, fields)).alias("feature"))


@dataclass
class Index:
    """An inverted index over ``fields`` of a table, under ``key``; ``like`` names their types and analyzers."""

    like: DataFrame
    fields: list
    key: str
    tables: dict | None
    postings: DataFrame  # (feature, key), each part of it in the order of features
    rows: DataFrame  # the same (key, feature), row by row
    norms: DataFrame  # (key, norm)
    frequency: DataFrame  # (feature, df)
    n: int
    rows_per_salt: int = ROWS_PER_SALT

    def append(self, df: DataFrame) -> Index:
        """The index of these rows and those of ``df``, whose keys must be new."""
        new = stored(_postings(df, self.fields, self.key, self.tables), "postings")
        counts = new.groupBy("feature").agg(F.count("*").alias("df")).where("feature IS NOT NULL")
        frequency = stored(self.frequency.unionByName(counts).groupBy("feature").agg(F.sum("df").alias("df")), "frequencies")
        n = self.n + new.select("key").distinct().count()
        new = new.where("feature IS NOT NULL")
        rows = self.rows.unionByName(new)
        norms = _norms(rows, frequency, n, self.rows_per_salt)
        return Index(self.like, self.fields, self.key, self.tables, self.postings.unionByName(_sorted(new)), rows, norms,
                     frequency, n, self.rows_per_salt)

    def scores(self, example: dict) -> DataFrame:
        """``(key, score)`` of all rows that share a feature with ``example``, from the postings of its features."""
        wanted, norm, known = self._asked(example)
        if not known:
            return self.postings.select(F.col("key").alias(self.key), F.lit(0.0).alias("score")).limit(0)
        weight = F.create_map(*[F.lit(x) for item in known.items() for x in item])
        own = self.postings.where(F.col("feature").isin(wanted))
        shared = own.groupBy("key").agg(F.sum(F.element_at(weight, F.col("feature"))).alias("shared"))
        return shared.join(self.norms, "key").select(
            F.col("key").alias(self.key), (F.col("shared") / (F.col("norm") * F.lit(norm))).alias("score"))

    def _asked(self, example: dict) -> tuple:
        if {f for f, v in example.items() if v is not None} - set(self.fields):
            raise ValueError(f"the index holds {self.fields}, not {sorted(example)}")
        return _asked(self.like, example, self.tables, self.frequency, self.n)

    def top(self, df: DataFrame, example: dict, limit: int | None = 10) -> DataFrame:
        """The rows of ``df`` most like ``example`` with ``score`` and ``rank``."""
        return _with_rows(df, self.scores(example), self.key, limit)


def _asked(like: DataFrame, example: dict, tables: dict | None, frequency: DataFrame, n: int) -> tuple:
    """``(features, norm, {feature: weight of those that occur})``; of the query's size."""
    wanted = query_evidence(bind(like, paths(example), tables), example).names
    rows = frequency.where(F.col("feature").isin(wanted)).select("feature", squared_idf(F.col("df"), n)).collect() if wanted else []
    known = {r[0]: r[1] for r in rows}
    unseen = like.sparkSession.sql("SELECT 0 AS df").select(squared_idf(F.col("df"), n)).first()[0]
    return wanted, sum(known.get(w, unseen) for w in wanted) ** 0.5, known


def _weights(frequency: DataFrame, n: int) -> DataFrame:
    return frequency.select("feature", squared_idf(F.col("df"), n).alias("w"), "df")


def _norms(rows: DataFrame, frequency: DataFrame, n: int, rows_per_salt: int) -> DataFrame:
    """``(key, norm)`` of stored rows; what lies side by side is added up before it is shuffled."""
    weighed = common_join(rows, _weights(frequency, n), "feature", "df", "key", rows_per_salt, exact=True)
    return stored(weighed.groupBy("key").agg(F.sqrt(F.sum("w")).alias("norm")), "norms")


def _sorted(rows: DataFrame) -> DataFrame:
    """Postings as a part of an index."""
    ordered = rows.select("feature", "key").repartitionByRange("feature", "key").sortWithinPartitions("feature", "key")
    return stored(ordered, "index")


def build_index(df: DataFrame, fields: list, key: str, tables: dict | None = None, rows_per_salt: int = ROWS_PER_SALT) -> Index:
    """An ``Index`` over the rows of ``df``; keys are unique."""
    rows = stored(_postings(df, fields, key, tables), "postings").where("feature IS NOT NULL")
    frequency = stored(rows.groupBy("feature").agg(F.count("*").alias("df")), "frequencies")
    n = df.count()
    return Index(df, list(fields), key, tables, _sorted(rows), rows, _norms(rows, frequency, n, rows_per_salt), frequency, n, rows_per_salt)


def similarity_scores(df: DataFrame, example: dict, key: str, tables: dict | None = None,
                      rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``(key, score)`` of all rows that share a feature with ``example``, without an index.

    The rows are tokenised once; features are counted over the whole table, combined map-side.  Norms
    are only made of rows that share a feature, with frequent features spread.
    """
    fields = [f for f, v in example.items() if v is not None]
    wanted = query_evidence(bind(df, paths(example), tables), example).names
    if not wanted:
        return df.select(key, F.lit(0.0).alias("score")).limit(0)
    postings = stored(_postings(df, fields, key, tables).where("feature IS NOT NULL"), "postings")
    frequency = stored(postings.groupBy("feature").agg(F.count("*").alias("df")), "frequencies")
    n = df.count()
    _, norm, known = _asked(df, example, tables, frequency, n)
    if not known:
        return df.select(key, F.lit(0.0).alias("score")).limit(0)
    sharing = postings.where(F.col("feature").isin(wanted)).select("key").distinct()
    sharing = stored(postings.join(sharing, "key", "left_semi"), "sharing")  # it is read several times
    sums = (
        common_join(sharing, _weights(frequency, n), "feature", "df", "key", rows_per_salt, exact=True)
        .groupBy("key")
        .agg(F.sum("w").alias("all"), F.sum(F.when(F.col("feature").isin(wanted), F.col("w"))).alias("shared"))
    )
    return sums.select(F.col("key").alias(key), (F.col("shared") / (F.sqrt("all") * F.lit(norm))).alias("score"))


def _with_rows(df: DataFrame, scores: DataFrame, key: str, limit: int | None) -> DataFrame:
    best = take_best(scores, [-F.round("score", SCORE_DIGITS), F.col(key)], limit)
    # at most ``limit`` rows are broadcast; without a limit Spark chooses the join
    return df.join(best if limit is None else F.broadcast(best), key)


def similarity(df: DataFrame, example: dict, key: str, limit: int | None = 10, tables: dict | None = None) -> DataFrame:
    """The rows most like ``example`` with ``score`` and ``rank``."""
    return _with_rows(df, similarity_scores(df, example, key, tables), key, limit)
