"""Mixing sources to target weights by entropy balancing.

Among all document rates that give every source its target number of words, the one with
the least relative entropy to "take each document once" is an exponential tilt:
``rate = exp(lambda of the source)``.  The multipliers maximise the concave dual
``sum(lambda * target) - sum(size * exp(lambda))``; as a document belongs to one source, its
Hessian is diagonal and a Newton step needs each source's word sum alone, which Spark
aggregates once; the steps then run for all sources in parallel.  Rates become copies by
systematic rounding along the documents of a source in the order of their size.

Defined results: a null or empty text has size 0 and is taken 0 words; null is a source of
its own, the last; a source of size 0 has target 0; repeated rows are documents of their own;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foretell.llm.common import WORD, running_start, stored
from foretell.operators.index import with_index

WEIGHTS = (5, 2, 1)  # by position of the source in code point order, repeating
SHARE = 1.5  # words of the mix by words there are
MOST = 2.0  # a source's target, and a document's words, by its size
STEPS = 80  # Newton steps; the rate falls by a factor e in each at most
CLASSES = 8  # size classes by factor e of the size
PARTS = 64  # parts of a size class, by hash


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size)`` with ``target``: shares by weight, cut at ``most`` times the size.

    What is cut goes to the others by weight, until none is above.  The level (words by unit
    of weight) only rises, so it is the whole state of the loop, and a round is one aggregate.
    """
    ordered = with_index(sources, [F.col("source").isNull(), F.col("source")], "_i")
    # ``_i`` is a long and the weights are few, so the literal array is bounded
    ordered = stored(ordered.withColumn("_w", F.get(F.array(*[F.lit(float(w)) for w in weights]),
                                                    F.pmod("_i", F.lit(len(weights))).cast("int"))), "mix-sources")
    total = ordered.agg(F.sum("source_size"), F.sum("_w")).first()
    words = share * float(total[0] or 0)
    level, cut = (words / total[1] if total[1] else 0.0), -1
    while True:
        above = F.col("_w") * F.lit(level) > F.col("source_size") * F.lit(most)
        now = ordered.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, F.col("source_size") * most)), F.sum(F.when(~above, F.col("_w"))),
        ).first()
        if now[0] == cut or not now[2]:
            break
        cut, level = now[0], (words - (now[1] or 0.0)) / now[2]
    target = F.least(F.col("_w") * F.lit(level), F.col("source_size") * F.lit(most))
    return ordered.select("source", "source_size", target.alias("target"))


def tilt(size: Column, target: Column, steps: int = STEPS) -> Column:
    """The multiplier of a source: Newton's method on its coordinate of the dual, from 0."""
    ratio = target / size

    def step(x, _):
        return x - (F.lit(1.0) - ratio * F.exp(-x))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), step)


def rates(targets: DataFrame, most: float = MOST) -> DataFrame:
    """Adds ``rate``, the expected copies of a document of the source; 0 for an empty target."""
    lam = tilt(F.col("source_size").cast("double"), F.col("target"))
    solved = F.when(F.col("target") > 0, F.least(F.exp(lam), F.lit(most))).otherwise(F.lit(0.0))
    return targets.withColumn("rate", solved)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, rate, copies, taken``."""
    rounded = _rounded(docs, key, text, source, weights, share, most)
    return rounded.select(
        "doc_id", "size", "source", F.col("source_size").cast("long").alias("source_size"), "target", "rate",
        F.col("copies").cast("int").alias("copies"), (F.col("copies") * F.col("size")).alias("taken"),
    )


def _size(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def copied(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    The texts are shuffled once, by a key of id, source and text; wholly equal rows share
    what is taken of them.
    """
    taken = _rounded(docs, key, text, source, weights, share, most)
    taken = taken.groupBy(_row_key("doc_id", "source", "size", "_text").alias("_k")).agg(
        F.sum("copies").cast("int").alias("_all"), F.count("*").cast("int").alias("_rows")).where("_all > 0")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        _row_key(key, source, _size(text), _hash(text)).alias("_k"))
    at = F.row_number().over(Window.partitionBy("_k").orderBy("_k"))
    found = rows.join(taken, "_k").withColumn("_at", at)
    copies = F.floor(F.col("_all") / F.col("_rows")).cast("int") + (F.col("_at") <= F.col("_all") % F.col("_rows")).cast("int")
    out = found.withColumn("_copies", copies).where("_copies > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def _hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _row_key(*parts) -> Column:
    return F.to_json(F.struct(*[(F.col(p) if isinstance(p, str) else p).alias(f"p{i}") for i, p in enumerate(parts)]))


def _rounded(docs: DataFrame, key, text, source, weights, share, most) -> DataFrame:
    digest = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), _size(text).alias("size"),
                         _hash(text).alias("_text"))
    # equal rows are counted before anything else, and come apart again at the end
    digest = stored(digest.groupBy("doc_id", "source", "size", "_text").agg(F.count("*").alias("_n")), "mix-sizes")
    sums = digest.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    solved = rates(source_targets(sums, weights, share, most), most).withColumn("_source", _key("source")).drop("source")
    size_class = F.floor(F.log(F.col("size").cast("double") + 1.0) * CLASSES) * PARTS
    bucket = size_class + F.pmod(F.xxhash64("doc_id", "size"), F.lit(PARTS))
    rows = digest.withColumns({"_source": _key("source"), "_bucket": bucket})
    placed = _by_bucket(running_start(rows, "_source", "_bucket", ["size", "doc_id", "_text"], "_n", "_start"), solved)
    at = F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("_n") - 1))
    placed = placed.withColumn("_at", at)
    part = F.col("rate") - F.floor("rate")

    def passed(n):  # documents that the fractional copies have reached after n of them
        return F.floor(part * n + F.lit(0.5))

    copies = F.floor("rate") + passed(F.col("_at") + 1) - passed(F.col("_at"))
    rounded = stored(placed.withColumn("copies", copies).select(
        "doc_id", "size", "source", "source_size", "target", "rate", "copies", "_source", "_text", "_at", "_bucket"), "mix-copies")
    return _corrected(rounded)


def _corrected(rounded: DataFrame) -> DataFrame:
    """Moves the words of a source closer to its target by rounding its smallest documents the other way.

    The rounding leaves an error of about one large document.  Of the documents whose other
    rounding reduces it, the smallest are turned while their words together stay below it.
    """
    total = F.sum(F.col("copies") * F.col("size")) - F.first("target")
    errors = rounded.groupBy("_source").agg(total.alias("_error"))
    down = F.col("copies") > F.floor("rate")
    fraction = F.col("rate") > F.floor("rate")
    turns = fraction & (F.col("size") > 0) & F.when(F.col("_error") > 0, down).otherwise(~down)
    rows = _by_bucket(rounded, errors).withColumn("_turn", F.when(turns, F.col("size")).otherwise(F.lit(0)).cast("long"))
    ranked = running_start(rows, "_source", "_bucket", ["size", "doc_id", "_text", "_at"], "_turn", "_before_turn")
    turned = (F.col("_turn") > 0) & (F.col("_before_turn") + F.col("_turn") <= F.abs("_error"))
    step = F.when(turned, F.when(F.col("_error") > 0, F.lit(-1)).otherwise(F.lit(1))).otherwise(F.lit(0))
    return ranked.withColumn("copies", F.col("copies") + step)


def _by_bucket(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Joins what is known of each source by its buckets, so that a large source is not dealt to one task."""
    known = rows.select("_source", "_bucket").distinct().join(sources, "_source")
    return rows.join(known, ["_source", "_bucket"])


def _key(source: str) -> Column:
    """A key that is never null: null and every string stay apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
