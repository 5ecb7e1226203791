"""Approximate nearest neighbours by inner product: a hierarchical k-means tree.

Vectors get one more coordinate that makes all norms equal, so that the largest inner product
is the least distance.  A tree of k-means splits is fitted on a bounded sample (``FIT``
vectors); every vector is then sent down to its leaf.  A query visits leaves best bin first:
a priority queue holds the nodes seen so far by the distance of their centres.  How many
leaves it visits is widened until the neighbours of ``PROBES`` sample queries, found by brute
force over all vectors, are reached with a recall of ``RECALL``.  The size of the tree
(``leaves``) is a parameter and does not follow the data, so that the visits of a query do
not either; vectors without any structure need most leaves, whatever the tree.

Equal vectors are one candidate with its smallest ``k + 1`` ids, all that a result can use,
and equal queries are searched once.  Vectors and queries of a leaf meet in blocks of bounded
size, so a leaf with a third of all vectors is many groups; each block keeps the best
``k + 1`` of a query.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components
take no part.  A row with the query's id is its
own.  Rows equal in id and vector count once.  Ties go to the smaller id.  A query visits
leaves until it has met ``k + 1`` vectors if there are so many; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foretell.llm.common import mapped, send_package, stored

K, EVERY = 20, 20
FIT = 20_000  # vectors of the sample, and at most FIT_VALUES numbers
FIT_VALUES = 8_000_000
BRANCHES, LEAVES = 8, 64  # children of a node; a node with fewer than this part of the sample is a leaf
PROBES, RECALL = 200, 0.95
ROWS, QUERIES = 2048, 1024  # vectors and queries of a block
SMALL = 1000  # vectors of a length, other than the most frequent, that need no tree


def _centres(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centre)
        fresh = np.array([x[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centre)])
        if np.allclose(fresh, centre):
            break
        centre = fresh
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (x @ centre.T - (centre * centre).sum(axis=1) / 2).argmax(axis=1)


class Tree:
    """Centres and children of the nodes; node 0 is the root, and leaves are numbered."""

    def __init__(self, x: np.ndarray, leaf: float, seed: int = 2):
        rng = np.random.default_rng(seed)
        self.centre, self.children, self.leaf = [np.zeros(x.shape[1])], [[]], [-1]
        self.leaves = 0
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            own = x[rows]
            split = _centres(own, BRANCHES, rng) if len(rows) > max(leaf, 1) else own[:0]
            near = _nearest(own, split) if len(split) > 1 else np.zeros(len(rows), int)
            if len(np.unique(near)) < 2:  # small enough, or all alike
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            for i in np.unique(near):
                self.children[node].append(len(self.centre))
                self.centre.append(split[i])
                self.children.append([])
                self.leaf.append(-1)
                work.append((self.children[node][-1], rows[near == i]))
        self.centre = np.array(self.centre)
        self.half = (self.centre * self.centre).sum(axis=1) / 2

    def assign(self, x: np.ndarray) -> np.ndarray:
        out, work = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            children = self.children[node]
            if not children:
                out[rows] = self.leaf[node]
                continue
            near = _nearest(x[rows], self.centre[children])
            work += [(c, rows[near == i]) for i, c in enumerate(children) if (near == i).any()]
        return out

    def visit(self, query: np.ndarray):
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            children = self.children[node]
            if not children:
                yield self.leaf[node]
                continue
            far = self.half[children] - self.centre[children] @ query
            for d, c in zip(far.tolist(), children):
                heapq.heappush(queue, (d, c))


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), np.float64) if len(column) else np.zeros((0, 0))


def _raised(x: np.ndarray, most: float) -> np.ndarray:
    """One more coordinate, so that every norm is ``most``."""
    return np.hstack([x, np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0))[:, None]])


def _flat(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.zeros((len(x), 1))])


def clean(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, v)`` of the vectors that take part, as doubles."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad).where(F.exists("v", lambda x: x != 0))


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = K,
           recall: float = RECALL, leaves: int = LEAVES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest of each id that ``every`` divides, among all rows.

    Vectors of different lengths have no product: each is answered among those of its own length.  These get
    a tree of their own, or, if they are at most ``SMALL`` of a rarer length, are compared with each other.
    """
    send_package(df.sparkSession)
    rows = clean(df, key, vector)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("many"))
    counts = {r["n"]: r["many"] for r in sizes.orderBy(F.desc("many"), "n").collect()}  # a row a length
    large = [n for i, n in enumerate(counts) if not i or counts[n] > SMALL]
    out = None
    for n in large:
        own = _searched(rows.where(F.size("v") == n), every, k, recall, leaves)
        out = own if out is None else out.unionByName(own)
    if out is not None and len(large) == len(counts):
        return out
    few = rows.where(~F.size("v").isin(large)).withColumn("n", F.size("v")).distinct()
    small = few.groupBy("n").applyInPandas(_compared(every, k), HITS)
    return small if out is None else out.unionByName(small)


HITS = "query_id long, rank int, vec_id long, score double"


def _compared(every: int, k: int):
    def run(pdf):
        x, ids = _matrix(pdf["v"]), pdf["id"].to_numpy()
        out = []
        for i in np.flatnonzero(ids % every == 0):
            others = np.flatnonzero(ids != ids[i])
            scores = (x[others] * x[i]).sum(axis=1)
            order = np.lexsort((ids[others], -scores))[:k]
            out += [(ids[i], rank, ids[others[j]], scores[j]) for rank, j in enumerate(order, 1)]
        return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])

    return run


def _searched(rows: DataFrame, every: int, k: int, recall: float, leaves: int) -> DataFrame:
    """The same among vectors of one length, by a tree."""
    spark = rows.sparkSession
    rows = rows.withColumn("vkey", F.xxhash64("v"))
    first = Window.partitionBy("vkey", "v").orderBy("id")
    few = rows.distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    vectors = few.groupBy("vkey", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    vectors = stored(vectors.withColumn("first", F.col("ids")[0]), "ann-vectors")
    asked = stored(rows.where(F.col("id") % every == 0).select("vkey", F.col("id").alias("query_id")).distinct(), "ann-asked")

    # the norm, size and number of the vectors
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, most, dim = vectors.agg(F.count("*"), F.max(norm), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], HITS)
    fit = min(FIT, max(BRANCHES, FIT_VALUES // dim))
    sample = vectors.orderBy("vkey").limit(fit).select("v").collect()
    tree = Tree(_raised(np.array([r["v"] for r in sample]), most), len(sample) / leaves)

    def sent(batches):
        for pdf in batches:
            if len(pdf):
                pdf["leaf"] = tree.assign(_raised(_matrix(pdf["v"]), most)).astype(np.int32)
                yield pdf

    index = mapped(vectors, sent, "vkey long, v array<double>, ids array<long>, first long, leaf int")
    index = stored(index, "ann-index")
    queries = stored(index.join(asked.select("vkey").distinct(), "vkey", "left_semi").select("vkey", "v"), "ann-queries")

    sizes = index.groupBy("leaf").count().collect()  # at most a row per leaf of the bounded tree
    held = np.zeros(tree.leaves, np.int64)
    held[[r["leaf"] for r in sizes]] = [r["count"] for r in sizes]
    visits = calibrated(index, queries, tree, most, k, recall)

    def visited(batches):
        for pdf in batches:
            out = []
            for q, v in zip(pdf["vkey"], pdf["v"]):
                met = steps = 0
                for leaf in tree.visit(np.append(v, 0.0)):
                    if steps >= visits and met > k:
                        break
                    steps, met = steps + 1, met + held[leaf]
                    out.append((q, v, leaf))
            yield pd.DataFrame(out, columns=["q", "v", "leaf"])

    going = mapped(queries, visited, "q long, v array<double>, leaf int")
    # blocks: row chunks and query chunks of every leaf, by hash
    chunks = index.groupBy("leaf").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("rows"))
    asking = going.groupBy("leaf").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("queries"))
    blocks = F.broadcast(chunks.join(asking, "leaf"))  # at most a row per leaf
    left = index.join(blocks, "leaf").select(
        "leaf", F.pmod("vkey", "rows").cast("int").alias("rc"), F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("qc"),
        "vkey", "v", "ids", "first")
    right = going.join(blocks, "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("rc"), F.pmod("q", "queries").cast("int").alias("qc"), "q", "v")

    def block(vs, qs):
        if not len(vs) or not len(qs):
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64"), "first": pd.Series(dtype="int64"), "ids": pd.Series(dtype=object)})
        return _best(_matrix(qs["v"]), qs["q"].to_numpy(), _matrix(vs["v"]), vs, k + 1)

    keys = ["leaf", "rc", "qc"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        block, "q long, score double, first long, ids array<long>")
    by_vector = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    kept = found.withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= k + 1)
    single = kept.select("q", "score", F.explode("ids").alias("id"))
    by_id = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    single = single.withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= k + 1)
    lists = single.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("_n", "id", "score"))).alias("hits"))
    out = asked.join(lists, asked["vkey"] == lists["q"])
    others = F.slice(F.filter("hits", lambda h: h["id"] != F.col("query_id")), 1, k)
    return out.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))


def _best(q: np.ndarray, names: np.ndarray, x: np.ndarray, vs: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best vectors of a block for each query; scores are summed the same way in any block."""
    near = q @ x.T
    first = vs["first"].to_numpy()
    spare = min(len(x), k + 8)  # the product may differ in the last place from the score
    if spare == len(x):
        part = np.tile(np.arange(len(x)), (len(q), 1))
        more = np.zeros(len(q), bool)
    else:
        part = np.argpartition(-near, spare - 1, axis=1)[:, :spare]
        values = np.take_along_axis(near, part, 1)
        # more than the spare ones may be as good as the last that counts
        last = np.sort(values, axis=1)[:, -k] - 1e-9 * (1 + np.abs(values).max(axis=1))
        more = (near >= last[:, None]).sum(axis=1) > spare
    exact = (x[part] * q[:, None, :]).sum(axis=2)
    order = np.lexsort((first[part], -exact), axis=1)[:, :k]
    rows, scores = np.take_along_axis(part, order, 1), np.take_along_axis(exact, order, 1)
    for i in np.flatnonzero(more):
        at = np.flatnonzero(near[i] >= last[i])
        own = (x[at] * q[i]).sum(axis=1)
        best = np.lexsort((first[at], -own))[:k]
        rows[i], scores[i] = at[best], own[best]
    rows = rows.ravel()
    return pd.DataFrame({"q": np.repeat(names, min(k, len(x))), "score": scores.ravel(), "first": first[rows],
                         "ids": vs["ids"].to_numpy()[rows]})


def calibrated(index: DataFrame, queries: DataFrame, tree: Tree, most: float, k: int, recall: float) -> int:
    """The leaves to visit for the wanted recall, on ``PROBES`` queries against all vectors."""
    probes = queries.orderBy("vkey").limit(PROBES).collect()
    if not probes:
        return 1
    names, q = np.array([r["vkey"] for r in probes]), np.array([r["v"] for r in probes])

    def exact(batches):
        for pdf in batches:
            if len(pdf):
                vs = pdf.reset_index(drop=True)
                vs["ids"] = [[i] for i in vs["leaf"]]
                yield _best(q, names, _matrix(vs["v"]), vs, k + 1)

    by_query = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    true = mapped(index.select("v", "first", "leaf"), exact, "q long, score double, first long, ids array<long>").withColumn(
        "_n", F.row_number().over(by_query)).where(F.col("_n") <= k + 1).select("q", F.col("ids")[0].alias("leaf")).collect()
    place = {}
    for name, v in zip(names.tolist(), q):
        place[name] = {leaf: i for i, leaf in enumerate(tree.visit(np.append(v, 0.0)))}
    depth = np.array([place[r["q"]][r["leaf"]] for r in true])
    visits = 1
    while (depth < visits).mean() < recall and visits < tree.leaves:
        visits += max(1, visits // 8)
    return min(visits, tree.leaves)
