"""Many predictions in one job: every row of a table is a query.

Only (feature, class) pairs that occur in the training rows are joined to the queries; the
score of a class that shares no feature with a query depends on its size and on the number of the
query's features alone (see ``counts``).

With many classes the features that most classes know would still bring every query together
with every class.  Queries share few different sets of such features, so the classes are
scored once for each set, which gives a *floor* under every (query, class) score:

* a query joins the postings of its other features only, and adds their gains to the floors;
* gains are positive, so a class that stands on its floor is only among the ``k`` best of a query if
  it is among the ``k`` best floors of its set: a query takes no more than these;
* the softmax sum is that of the floors plus what the other features add, all positive terms.

The result equals scoring every (query, class) pair, without forming those pairs.  When
there are only a few classes, each gets a column instead: the counts of a feature are one
row, and a query needs one row per feature.

Held-out rows are counted with all others, by fold, and the counts of what a fold trains on are the
difference, so one aggregation serves any number of folds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.features import classes as classes_of
from foretell.functions.features import row_features
from foretell.functions.predicates import column_name
from foretell.operators.counts import BIN, SCORE_DIGITS, baseline, best_first, gain, lse_of, unnest
from foretell.operators.links import bind
from foretell.operators.skew import ROWS_PER_SALT, common_join, salted_join
from foretell.plans.workspace import stored

FEW_CLASSES = 32  # up to this many classes get a column each
HEAD = 1_000  # features that may count as shared by most classes; bounds what is collected
SHARES = (1, 2, 4, 8)  # a shared feature is known to at least one class of so many


def predict_batch(train: DataFrame, queries: DataFrame, key: str, fields, target: str, k: int = 10,
                  tables: dict | None = None, with_p: bool = True, few_classes: int = FEW_CLASSES,
                  head: int = HEAD, rows_per_salt: int = ROWS_PER_SALT, fold: str | None = None) -> DataFrame:
    """The ``k`` best answers of each query row: ``(key, feature, p, rank)``.

    ``fields``: evidence fields of ``train``, as a list or as ``{field: query column}``.
    ``key`` identifies a query row.  Up to ``few_classes`` classes are scored side by side,
    more of them as described above.  ``fold`` names a whole-number column of both tables, from 0: a query
    does not learn from the rows of its own fold; rows without one are learnt by all.  There should be few folds.
    """
    sources = dict(fields) if isinstance(fields, dict) else {f: f for f in fields}
    train = bind(train, [*sources, target], tables)
    train = train.where(F.col(column_name(target)).isNotNull())
    queries = bind(queries, list(sources.values()), tables)
    is_text = S.analyzer_of(train, column_name(target)) is not None

    found = row_features(queries, list(sources), like=train, sources=sources)
    of_fold = F.lit(0).cast("long") if fold is None else F.coalesce(F.col(fold).cast("long"), F.lit(-1).cast("long"))
    q = queries.select(F.col(key).alias("qid"), of_fold.alias("fold"), found.alias("f"))
    everyone = None
    if not any(S.analyzer_of(train, column_name(path)) for path in sources):
        # few plain fields: many rows ask the same, so each set of features is scored once
        everyone = q.select(F.col("qid").alias("row"), "fold", "f")
        q = q.groupBy("fold", "f").agg(F.min("qid").alias("qid"))
    else:
        q = stored(q, "asked")  # texts are tokenised once
    learnt = train.select(
        classes_of(train, target).alias("_c"), row_features(train, list(sources)).alias("_f"),
        (F.lit(None).cast("long") if fold is None else F.col(fold).cast("long")).alias("_fold"))
    folds = None if fold is None else sorted(r[0] for r in queries.select(of_fold).distinct().collect())
    sizes, rows = _sizes(learnt, folds)
    listed = sizes.select("class").distinct().limit(few_classes + 1).collect()  # a bounded look at the classes
    if len(listed) <= few_classes:
        best = _few(learnt, q, sorted(r["class"] for r in listed), sizes, rows, folds, is_text, k, rows_per_salt)
    else:
        best = _many(learnt, q, sizes, rows, folds, is_text, k, with_p, head, rows_per_salt)
    best = best.select("qid", F.col("class").alias("feature"), *(["p"] if with_p else []), "rank")
    if everyone is not None:
        answered = q.join(best, "qid").drop("qid")  # at most k rows per set of features
        asked = F.struct("fold", "f")
        best = salted_join(everyone.select("row", asked.alias("asked")), answered.select(asked.alias("asked"), *best.columns[1:]),
                           "asked", "row", rows_per_salt).drop("asked").withColumnRenamed("row", "qid")
    return best.withColumnRenamed("qid", key)


def _left(counts: DataFrame, keys: list, folds: list | None, values: list) -> DataFrame:
    """Counts ``(keys, _fold, values)`` as what each fold trains on: ``(fold, keys, values)``.

    Without folds the counts are those of fold 0.  A fold takes its own rows off the total.
    """
    if folds is None:
        return counts.select(F.lit(0).cast("long").alias("fold"), *keys, *values)
    own = F.when(F.col("_fold").isNotNull(), F.struct("_fold", F.struct(*values)))
    total = counts.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values], F.map_from_entries(F.collect_list(own)).alias("_own"))
    every = F.explode(F.array(*[F.lit(f).cast("long") for f in folds]))
    spread = total.select("*", every.alias("fold")).withColumn("_out", F.try_element_at("_own", F.col("fold")))
    return spread.select("fold", *keys, *[(F.col(v) - F.coalesce(F.col(f"_out.{v}"), F.lit(0))).alias(v) for v in values])


def _sizes(learnt: DataFrame, folds: list | None) -> tuple:
    """``(fold, class, size)`` of the classes that a fold trains on, and ``{fold: rows}``; both from one pass.

    The rows are counted as one more class, under a null name.
    """
    named = learnt.select("_fold", F.explode(F.array_append(F.filter("_c", lambda c: c.isNotNull()), F.lit(None).cast("string"))).alias("class"))
    counts = named.groupBy("class", "_fold").agg(F.count("*").alias("size"))
    sizes = stored(_left(counts, ["class"], folds, ["size"]).where("size > 0"), "class-sizes")
    rows = {r["fold"]: r["size"] for r in sizes.where("class IS NULL").collect()}  # one row a fold
    return sizes.where("class IS NOT NULL"), rows


def _by_fold(values: dict) -> Column:
    """A number that depends on the fold; 0 for folds without one."""
    if len(values) == 1 and 0 in values:
        return F.lit(values[0])
    pairs = [F.lit(x).cast("long") for item in values.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("fold")), F.lit(0)) if pairs else F.lit(0)


def _few(learnt: DataFrame, q: DataFrame, names: list, sizes: DataFrame, rows: dict, folds: list | None, is_text: bool, k: int,
         rows_per_salt: int) -> DataFrame:
    """``(qid, class, p, rank)`` with one column per class; one row per feature is joined."""
    ids = range(len(names))
    columns = ["n_f", *(f"n{i}" for i in ids)]
    holds = [F.array_contains("_c", name).alias(f"c{i}") for i, name in enumerate(names)]  # once a row, not a feature
    counts = (
        learnt.select("_fold", *holds, unnest("_f").alias("feature")).where("feature IS NOT NULL")
        .groupBy("feature", "_fold")
        .agg(F.count("*").alias("n_f"), *[F.count_if(f"c{i}").alias(f"n{i}") for i in ids])
    )
    counts = stored(_left(counts, ["feature"], folds, columns), "feature-counts")
    n_f = F.col("n_f") if is_text else None
    gains = counts.select(
        F.struct("fold", "feature").alias("asked"), F.log(F.col("n_f") + 1.0).alias("absent"),
        *[gain(F.col(f"n{i}"), n_f).alias(f"g{i}") for i in ids], F.col("n_f").alias("often")
    )
    # a query without features keeps one row, under a name that no feature has
    evidence = q.select("qid", "fold", F.size("f").alias("h"), unnest("f").alias("feature")).fillna("", ["feature"]).select(
        "qid", "fold", "h", F.struct("fold", "feature").alias("asked"))
    sums = (
        common_join(evidence, gains, "asked", "often", "qid", rows_per_salt, how="left")
        .groupBy("qid")
        .agg(F.max("h").alias("h"), F.max("fold").alias("fold"),
             *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ["absent", *(f"g{i}" for i in ids)]])
    )
    size: dict = {name: {} for name in names}
    for r in sizes.collect():  # few classes, a row each a fold
        size[r["class"]][r["fold"]] = r["size"]
    for i, name in enumerate(names):
        sums = sums.withColumn(f"s{i}", _by_fold(size[name]))
    sums = sums.withColumn("n_rows", _by_fold(rows))
    h = F.col("h")

    def entry(i):
        own = F.col(f"s{i}")
        score = baseline(own, h, F.col("n_rows") if is_text else None) + F.col(f"g{i}")
        tie = F.when(h >= 2, own).otherwise(-own).cast("long")
        found = F.struct((-F.round(score, SCORE_DIGITS)).alias("o"), tie.alias("t"), F.lit(names[i]).alias("class"), score.alias("score"))
        return found if folds is None else F.when(own > 0, found)

    kind = "array<struct<o:double,t:bigint,class:string,score:double>>"
    entries = F.sort_array(F.array_compact(F.array(*[entry(i) for i in ids]))) if names else F.array().cast(kind)
    scored = sums.select("qid", "absent", entries.alias("all"))
    if is_text:
        p = 1.0 / (1.0 + F.exp(F.col("absent") - F.col("e.score")))
    else:
        scored = scored.withColumn("lse", lse_of(F.transform("all", lambda e: e["score"])))
        p = F.exp(F.col("e.score") - F.col("lse"))
    best = scored.select("*", F.posexplode(F.slice("all", 1, k)).alias("at", "e"))
    return best.select("qid", "e.class", p.alias("p"), (F.col("at") + 1).alias("rank"))


def _postings(learnt: DataFrame, sizes: DataFrame, folds: list | None, is_text: bool) -> tuple:
    """``(fold, feature, class, size, gain)`` of the pairs that occur; and ``(fold, feature, n_f)`` of a Text target."""
    listed = learnt.select("_c", "_fold", F.explode("_f").alias("feature"))
    pairs = (listed.select("feature", "_fold", unnest("_c").alias("class")).where(F.col("class").isNotNull())
             .groupBy("feature", "class", "_fold").agg(F.count("*").alias("n")))
    pairs = _left(pairs, ["feature", "class"], folds, ["n"]).where("n > 0").join(sizes, ["fold", "class"])
    totals = None
    if is_text:
        counts = listed.groupBy("feature", "_fold").agg(F.count("*").alias("n_f"))
        totals = stored(_left(counts, ["feature"], folds, ["n_f"]), "feature-sizes")
        pairs = pairs.join(totals, ["fold", "feature"])
    pairs = pairs.select("fold", "feature", "class", "size", gain(F.col("n"), F.col("n_f") if is_text else None).alias("gain"))
    return stored(pairs, "postings"), totals


def _shared_features(q: DataFrame, pairs: DataFrame, n_classes: int, head: int) -> list:
    """The features that are scored by sets: those whose sets spare most joined rows, none if none do."""
    reach = (pairs.groupBy("fold", "feature").agg(F.count("*").alias("reach")).groupBy("feature").agg(F.max("reach").alias("reach"))
             .where(F.col("reach") * SHARES[-1] >= n_classes).orderBy(F.desc("reach"), "feature").limit(head).collect())
    if not reach:
        return []
    known = F.create_map(*[F.lit(x) for r in reach for x in (r["feature"], r["reach"])])
    choices = [[r["feature"] for r in reach if r["reach"] * share >= n_classes] for share in SHARES]
    measures = []
    for i, chosen in enumerate(choices):
        g = F.array_intersect("f", F.array(*[F.lit(c) for c in chosen]).cast("array<string>"))
        measures += [F.approx_count_distinct(F.xxhash64("fold", F.size("f"), F.array_sort(g))).alias(f"sets{i}"),
                     F.sum(F.reduce(g, F.lit(0).cast("long"), lambda acc, x: acc + F.element_at(known, x))).alias(f"spared{i}")]
    seen = q.agg(*measures).first()
    gains = [(seen[f"spared{i}"] or 0) - seen[f"sets{i}"] * n_classes for i in range(len(choices))]
    best = max(range(len(choices)), key=lambda i: gains[i])
    return choices[best] if gains[best] > 0 else []


def _many(learnt: DataFrame, q: DataFrame, sizes: DataFrame, rows: dict, folds: list | None, is_text: bool, k: int, with_p: bool,
          head: int, rows_per_salt: int) -> DataFrame:
    """``(qid, class, p, rank)`` from the floors of shared sets and the postings of all other features."""
    pairs, totals = _postings(learnt, sizes, folds, is_text)
    n_rows = _by_fold(rows) if is_text else None
    n_classes = sizes.groupBy("fold").count().agg(F.max("count")).first()[0]
    shared = F.array(*[F.lit(f) for f in _shared_features(q, pairs, n_classes, head)]).cast("array<string>")
    q = q.select("qid", "fold", F.size("f").alias("h"), F.array_sort(F.array_intersect("f", shared)).alias("g"),
                 F.array_except("f", shared).alias("rest"), *(["f"] if is_text and with_p else []))
    sets = stored(q.groupBy("fold", "h", "g").agg(F.min("qid").alias("gid")), "shared-sets")
    q = stored(q.join(sets, ["fold", "h", "g"]).drop("g"), "queries")

    floor = baseline(F.col("size"), F.col("h"), n_rows)
    known = (  # few sets, each with the classes that know its features
        sets.select("gid", "fold", "h", F.explode("g").alias("feature")).join(pairs, ["fold", "feature"])
        .groupBy("gid", "class")
        .agg(F.max("h").alias("h"), F.max("fold").alias("fold"), F.max("size").alias("size"), F.sum("gain").alias("gain"))
        .withColumn("score", floor + F.col("gain"))
    )
    known = stored(known, "floors")
    first = _first_by_size(sets, sizes, k).withColumn("score", floor)
    columns = ["gid", "h", "class", "size", "score"]
    lists = stored(_best(known.select(*columns).unionByName(first.select(*columns)), "gid", k), "best-floors")

    asked = q.select("qid", "gid", "h", F.explode("rest").alias("feature"), "fold")
    added = (
        salted_join(asked.select("qid", "gid", "h", F.struct("fold", "feature").alias("asked")),
                    pairs.select(F.struct("fold", "feature").alias("asked"), "fold", "class", "size", "gain"), "asked", "qid", rows_per_salt)
        .groupBy("qid", "class")
        .agg(F.max("gid").alias("gid"), F.max("fold").alias("fold"), F.max("h").alias("h"), F.max("size").alias("size"), F.sum("gain").alias("gain"))
        .join(known.select("gid", "class", F.col("score").alias("known")), ["gid", "class"], "left")
        .withColumn("score", F.coalesce("known", floor) + F.col("gain"))
    )
    added = stored(added, "added")  # it is used twice below
    standing = q.select("qid", "gid").join(lists.select(*columns), "gid")
    best = _best(added.select("qid", *columns[1:]).unionByName(standing.select("qid", *columns[1:])), "qid", k)
    if not with_p:
        return best
    if is_text:
        evidence = q.select("qid", F.explode("f").alias("feature"), "fold").select("qid", F.struct("fold", "feature").alias("asked"))
        absent = (
            salted_join(evidence, totals.select(F.struct("fold", "feature").alias("asked"), "n_f"), "asked", "qid", rows_per_salt)
            .groupBy("qid").agg(F.sum(F.log(F.col("n_f") + 1.0)).alias("absent"))
        )
        odds = F.col("score") - F.coalesce("absent", F.lit(0.0))
        return best.join(absent, "qid", "left").withColumn("p", 1.0 / (1.0 + F.exp(-odds)))
    norms = _norm(sets.select("gid", "fold", "h"), known, sizes)
    more = _added_terms(added, "qid")
    terms = F.coalesce("terms", F.array().cast("array<double>"))
    lse = q.select("qid", "gid").join(norms, "gid").join(more, "qid", "left").select(
        "qid", lse_of(F.array_append(terms, F.col("lse"))).alias("lse"))
    return best.join(lse, "qid").withColumn("p", F.exp(F.col("score") - F.col("lse")))


def _added_terms(scored: DataFrame, key: str) -> DataFrame:
    """``(key, terms)``: logs of what the gains of scored classes add to a sum.

    A class adds exp(score) - exp(score - gain), which is positive as its gain is, so nothing
    cancels.  The sums go by exponent bins (see ``log_sum_exp``).
    """
    e = F.floor(F.col("score") / BIN)
    added = F.exp(F.col("score") - e * BIN) * -F.expm1(-F.col("gain"))
    return (
        scored.select(key, e.alias("e"), added.alias("v"))
        .groupBy(key, "e").agg(F.sum("v").alias("v"))
        .groupBy(key)
        .agg(F.collect_list(F.when(F.col("v") > 0, F.col("e") * BIN + F.log("v"))).alias("terms"))
    )


def _norm(sets: DataFrame, known: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(gid, lse)``: all classes at their baseline plus what the shared features add.

    There are at most sqrt(2 * rows) different class sizes, and as many baseline sums as
    there are different feature counts among the queries.
    """
    histogram = sizes.groupBy("fold", "size").agg(F.count("*").alias("c")).groupBy("fold").agg(
        F.collect_list(F.struct("size", "c")).alias("hist"))
    base = (
        sets.select("fold", "h").distinct().join(histogram, "fold")
        .select("fold", "h", lse_of(F.transform("hist", lambda x: F.log(x["c"]) + baseline(x["size"], F.col("h")))).alias("base"))
    )
    terms = F.coalesce("terms", F.array().cast("array<double>"))
    return (sets.join(base, ["fold", "h"]).join(_added_terms(known, "gid"), "gid", "left")
            .select("gid", lse_of(F.array_append(terms, F.col("base"))).alias("lse")))


def _best(candidates: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` best classes per ``key``; a class may stand twice, with its score and with a floor below it.

    Among the 2k best entries are the k best classes, so what is shuffled is cut to 2k
    entries per query and task first.
    """
    order = best_first("score", "size", F.col("h"), "class")
    per_query = Window.partitionBy(key)
    return (
        candidates.withColumn("at", F.row_number().over(per_query.orderBy(*order)))
        .where(F.col("at") <= 2 * k)
        .withColumn("copy", F.row_number().over(Window.partitionBy(key, "class").orderBy("at")))
        .where(F.col("copy") == 1)
        .withColumn("rank", F.row_number().over(per_query.orderBy("at")))
        .where(F.col("rank") <= k)
    )


def _first_by_size(sets: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """``(gid, fold, h, class, size)``: the ``k`` best classes by baseline: rising size with two or more features, else falling."""
    def first(rising: bool) -> DataFrame:
        order = [F.col("size").asc() if rising else F.col("size").desc(), F.col("class").asc()]
        return (sizes.withColumn("at", F.row_number().over(Window.partitionBy("fold").orderBy(*order))).where(F.col("at") <= k)
                .select("fold", F.lit(rising).alias("rising"), "class", "size"))

    listed = first(True).unionByName(first(False))
    return sets.select("gid", "fold", "h", (F.col("h") >= 2).alias("rising")).join(listed, ["fold", "rising"]).drop("rising")
