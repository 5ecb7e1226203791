"""Joins on keys of which a few are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 100_000
COMMON = 20_000  # keys whose rows are broadcast


def salted_join(left: DataFrame, right: DataFrame, key: str, spread_by: str,
                rows_per_salt: int = ROWS_PER_SALT, how: str = "inner") -> DataFrame:
    """Equi-join (inner or left) on ``key`` in which hot keys of ``left`` are split over many tasks.

    The hot keys are counted first (combined map-side).  Their rows on the left get a salt
    from ``spread_by``, their rows on the right are repeated per salt; all other rows have
    the single salt 0.  There is at most one hot key per ``rows_per_salt`` rows, and whether
    their list is broadcast is left to Spark's size check.  The result is that of the plain join.

    Splitting skewed partitions at run time does not reach the joins this serves: an aggregation
    by query follows in the same stage plan, and a partition of one key with a long row on the right
    (the classes of a feature) makes its output, not its input, large.
    """
    hot = (
        left.groupBy(key).agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rows_per_salt)
        .select(key, F.ceil(F.col("_rows") / rows_per_salt).cast("int").alias("_salts"))
    )
    salts = F.coalesce("_salts", F.lit(1))
    salted_left = left.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), salts).cast("int")
    )
    salted_right = right.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return salted_left.drop("_salts").join(salted_right.drop("_salts"), [key, "_salt"], how).drop("_salt")


def common_join(left: DataFrame, right: DataFrame, key: str, frequency: str, spread_by: str,
                rows_per_salt: int = ROWS_PER_SALT, how: str = "inner", exact: bool = False, most: int = COMMON) -> DataFrame:
    """The same join, if ``right`` has one row per key and says in ``frequency`` about how often the key occurs on the left.

    The rows of the most frequent keys, ``most`` of them at most, are broadcast.  As words go, these keys
    make up nearly all rows of the left, which then need no shuffle and can be combined where they lie; the
    others go through ``salted_join``, or through a plain join where the ``exact`` frequencies say that none is hot.
    ``right`` is read several times, ``left`` three times: they should be stored.
    """
    seen = right.select(frequency).orderBy(F.desc(frequency)).limit(most + 1).agg(F.count("*"), F.min(frequency)).first()
    if seen[0] <= most:
        return left.join(F.broadcast(right.drop(frequency)), key, how)
    common = F.coalesce(F.col(frequency) > F.lit(seen[1]), F.lit(False))
    listed = F.broadcast(right.where(common).drop(frequency))
    rest = left.join(F.broadcast(right.where(common).select(key)), key, "left_anti")
    others = right.where(~common).drop(frequency)
    if exact and seen[1] <= rows_per_salt:
        return left.join(listed, key).unionByName(rest.join(others, key, how))
    return left.join(listed, key).unionByName(salted_join(rest, others, key, spread_by, rows_per_salt, how))
