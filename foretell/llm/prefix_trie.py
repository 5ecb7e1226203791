"""The prefix trie of conversations: which turns conversations share from their start on.

Conversations become sequences of turn ids, which Spark sorts into ranges.  A task lays the
sequences of its range out as padded matrices of ``BAND`` turns, numpy sorts the rows
(``lexsort``), and where a row differs from the one above in a turn or, OR-accumulated, in an
earlier one, a node starts.  A node is a run of rows, so ``reduceat`` over the starts of a depth
gives what its members and its subtree add up to.  Only the prefixes of the first and of the last
row of a range can have members in other ranges: these boundary nodes come with what lies below
them inside their range, are added up by their key, and one task walks their small tree (two
paths a range) from the leaves to the root.

A turn is its role and text by a digest of 128 bits; the texts themselves are never moved.  A
conversation is held whole by a task, as 24 bytes a turn; ranges have about ``PER_RANGE`` turns.
The digest over the members that end in a node is fed range by range, from packed lists.

Defined results: turns are ordered by number (null first), then role, then digest, so equal rows
keep apart as turns of their own; a null role or text is empty; rows without a ``conv_id`` belong to no
conversation; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import mapped, send_package, stored

FAMILY, HEADS = 5, 9  # fixed values: conversations that share a base, and the modulus of the head's length
BAND = 32  # turns of a padded matrix
PER_RANGE = 1_000_000  # turns of a range

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
#: rows of a range: closed nodes, and the parts of boundary nodes with their keys
PART = NODE + ", shard long, key binary, parent binary, bytes long, ends binary"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turn(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn; the length of the role keeps role and text apart."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def head_length(conv: Column) -> Column:
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(HEADS)).cast("int")


def sequences(rows: DataFrame) -> DataFrame:
    """``(conv_id, seq)``: the turns of every conversation in order, each ``(id, bytes)``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), role.alias("role"), _turn(role, text).alias("id"), F.octet_length(text).alias("bytes")).alias("t"))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("all"))  # struct order: null first
    return listed.select("conv_id", F.transform("all", lambda t: F.struct(t["id"], t["bytes"])).alias("seq"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Every conversation with the head of the first of its family in place of its own."""
    family = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    base = convs.where(F.pmod("conv_id", F.lit(FAMILY)) == 0).select(
        F.col("conv_id").alias("family"), F.slice("seq", 1, HEADS - 1).alias("head"))
    h = head_length(F.col("conv_id"))
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<id:binary,bytes:int>>")), F.lit(1), h)
    return (convs.withColumn("family", family).join(base, "family", "left")
            .select("conv_id", F.concat(head, F.slice("seq", h + 1, F.greatest(F.size("seq"), F.lit(1)))).alias("seq")))


class _Rows:
    """The sequences of a range, sorted."""

    def __init__(self, conv: np.ndarray, lengths: np.ndarray, ids: np.ndarray, size: np.ndarray):
        """``ids``: rank of each turn, one conversation after the other; ``size``: bytes of its text."""
        self.ids, self.size = ids, size
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        order = self._sorted(conv, starts, lengths)
        self.conv, self.lengths, self.starts = conv[order], lengths[order], starts[order]

    def _matrix(self, starts, lengths, at: int) -> np.ndarray:
        """Turns ``at`` to ``at + BAND`` of each row, padded by -1."""
        place = at + np.arange(min(BAND, int(lengths.max()) - at))
        real = place < lengths[:, None]
        return np.where(real, self.ids[np.where(real, starts[:, None] + place, 0)], -1)

    def _sorted(self, conv, starts, lengths) -> np.ndarray:
        """Rows by their turns, then conversation: the last band first, each with the rows that reach it.

        A row that ends before a band stands before those with equal earlier turns that reach it.
        """
        by_conv = np.argsort(conv, kind="stable")
        order = np.zeros(0, np.int64)
        for at in range((max(int(lengths.max()) - 1, 0) // BAND) * BAND, -1, -BAND):
            reach = lengths[by_conv] > at
            ends_here = by_conv[reach & (lengths[by_conv] <= at + BAND)]
            order = np.concatenate([ends_here, order])
            if len(order):
                order = order[np.lexsort(self._matrix(starts[order], lengths[order], at).T[::-1])]
        return np.concatenate([by_conv[lengths[by_conv] == 0], order])

    def changes(self):
        """``(depth, rows, new)`` from the first turn on: the rows that are so long, and where a node starts."""
        rows, carried = np.flatnonzero(self.lengths > 0), None
        for at in range(0, int(self.lengths.max()), BAND):
            keep = self.lengths[rows] > at
            carried = np.concatenate([[True], np.zeros(len(rows) - 1, bool)])[keep] if carried is None else carried[keep]
            rows = rows[keep]
            matrix = self._matrix(self.starts[rows], self.lengths[rows], at)
            differs = np.ones(matrix.shape, bool)
            differs[1:] = matrix[1:] != matrix[:-1]
            differs[:, 0] |= carried
            masks = np.logical_or.accumulate(differs, axis=1)
            for k in range(matrix.shape[1]):
                deep = self.lengths[rows] > at + k
                yield at + k + 1, rows[deep], masks[deep, k]
            carried = masks[:, -1]


def _keys(ids: np.ndarray) -> list:
    """A key of every prefix of a sequence of 16-byte ids, the empty one first."""
    out = [hashlib.md5(b"root").digest()]
    for i in ids:
        out.append(hashlib.md5(out[-1] + i.tobytes()).digest())
    return out


def _shard_nodes(shard: int, conv, lengths, raw, size) -> list:
    """Columns of ``PART`` for the rows of one range."""
    order = np.lexsort((raw[:, 1], raw[:, 0])) if len(raw) else np.zeros(0, np.int64)
    rank = np.zeros(len(raw), np.int64)
    if len(raw):
        rank[order] = np.cumsum(np.concatenate([[0], (raw[order][1:] != raw[order][:-1]).any(axis=1)]))
    t = _Rows(conv, lengths, rank, size)
    n = len(conv)
    paths = {0: _keys(raw[t.starts[0] : t.starts[0] + t.lengths[0]]), n - 1: _keys(raw[t.starts[n - 1] : t.starts[n - 1] + t.lengths[n - 1]])}
    levels = [(0, np.arange(n), np.concatenate([[True], np.zeros(n - 1, bool)])), *t.changes()]
    below_saved, below_leaves = np.zeros(n, np.int64), np.zeros(n, np.int64)  # of closed nodes, at their first row
    child_new = np.zeros(n, bool)  # rows at which a closed node of the next depth starts
    child_any = np.zeros(n, bool)
    out: list = []
    for depth, rows, new in reversed(levels):
        starts = np.flatnonzero(new)
        first = rows[starts]
        count = np.diff(np.append(starts, len(rows)))
        last = rows[np.append(starts[1:], len(rows)) - 1]
        add = lambda x: np.add.reduceat(x[rows], starts)
        open_ = (first == 0) | (last == n - 1)
        children = add(child_new.astype(np.int64))
        leaf = add(child_any.astype(np.int64)) == 0
        bytes_ = size[t.starts[first] + depth - 1] if depth else np.zeros(len(first), np.int64)
        own = (count - 1) * bytes_
        saved, leaves = add(below_saved), add(below_leaves)
        closed_leaf = leaf & ~open_
        total_saved = saved + np.where(open_, 0, own)
        total_leaves = leaves + closed_leaf
        least = np.minimum.reduceat(t.conv[rows], starts)
        ending = t.lengths[rows] == depth
        n_ending = np.add.reduceat(ending.astype(np.int64), starts)
        ends = np.full(len(first), None, object)
        digests = np.full(len(first), NO_ENDS, object)
        at = np.concatenate([[0], np.cumsum(n_ending)])
        listed = t.conv[rows][ending]
        for i in np.flatnonzero(n_ending):
            packed = ",".join(map(str, np.sort(listed[at[i] : at[i + 1]]))).encode()
            if open_[i]:
                ends[i] = packed
            else:
                digests[i] = hashlib.sha256(packed).hexdigest()
        above = np.full(len(first), None, object)  # the key of a parent that is open
        key = np.full(len(first), None, object)
        for i in np.flatnonzero(open_):
            path = paths[0] if first[i] == 0 else paths[n - 1]
            key[i] = path[depth]
            above[i] = path[depth - 1] if depth else None
        out.append([least, np.full(len(first), depth), first, count, children, total_leaves, total_saved, digests, key, above, bytes_, ends, open_])
        child_new[:], child_any[:] = False, False
        child_new[first[~open_]] = True
        child_any[first] = True
        below_saved[first] += np.where(open_, 0, own)
        below_leaves[first] += closed_leaf
    # parents, from the root on
    rows_out: list = []
    out.reverse()
    parent_first = parent_least = parent_open = None
    for level in out:
        least, depth, first, open_ = level[0], level[1], level[2], level[12]
        parent = np.full(len(first), None, object)
        above = level[9]
        if parent_first is not None:
            up = np.searchsorted(parent_first, first, side="right") - 1
            shut = ~parent_open[up]
            parent[shut] = parent_least[up][shut]
            for i in np.flatnonzero(~shut & ~open_):
                above[i] = parent_key[up[i]]
        rows_out.append([least, depth, parent, *level[3:8], np.full(len(first), shard), level[8], above, level[10], level[11]])
        parent_first, parent_least, parent_open, parent_key = first, least, open_, level[8]
    return [np.concatenate([r[i] for r in rows_out]) for i in range(13)]


_TYPES = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
_NAMES = [c.split()[0] for c in PART.split(", ")]


def _range(batches):
    """The nodes of one range, closed ones and parts of boundary ones."""
    from pyspark import TaskContext

    conv, lengths, raw, size = [], [], [], []
    for batch in batches:
        conv.append(batch.column("conv_id").to_numpy(zero_copy_only=False))
        ids = batch.column("ids")
        lengths.append(np.diff(np.asarray(ids.offsets)).astype(np.int64))
        raw.append(np.frombuffer(b"".join(ids.flatten().to_pylist()), ">u8").reshape(-1, 2))
        size.append(batch.column("bytes").flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    if not sum(map(len, conv)):
        return
    columns = _shard_nodes(TaskContext.get().partitionId(), *(np.concatenate(x) for x in (conv, lengths, raw, size)))
    for at in range(0, len(columns[0]), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 50_000], t) for c, t in zip(columns, _TYPES)], _NAMES)


def _digests(batches):
    """``(key, ends_sha256)`` from packed lists sorted by key and range."""
    key, digest = None, None
    done: list = []
    for pdf in batches:
        for k, ends in zip(pdf["key"], pdf["ends"]):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(bytes(ends))
            else:
                digest.update(b"," + bytes(ends))
        if len(done) > 10_000:
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
            done = []
    if key is not None:
        done.append((key, digest.hexdigest()))
    yield pd.DataFrame(done, columns=["key", "ends_sha256"])


def _joined_tree(batches):
    """Boundary nodes with the sums over their subtrees; one task, a few nodes a range."""
    parts = list(batches)
    if not sum(map(len, parts)):
        return
    t = pd.concat(parts, ignore_index=True)
    place = {k: i for i, k in enumerate(t["key"])}
    up = [-1 if p is None else place[p] for p in t["parent"]]
    convs, children = t["conv_id"].tolist(), t["n_children"].tolist()
    for p in up:
        if p >= 0:
            children[p] += 1
    # what closed nodes add is in the sums already; this is what the boundary nodes add
    leaves, saved = [int(c == 0) for c in children], ((t["n_convs"] - 1) * t["bytes"]).tolist()
    for i in np.argsort(-t["depth"].to_numpy(), kind="stable"):
        if up[i] >= 0:
            leaves[up[i]] += leaves[i]
            saved[up[i]] += saved[i]
    yield t[["key", "conv_id", "depth", "n_convs"]].assign(
        parent_conv_id=pd.array([convs[p] if p >= 0 else None for p in up], "Int64"), n_children=children,
        n_leaves=t["n_leaves"] + leaves, saved_tokens=t["saved_tokens"] + saved)


def nodes(convs: DataFrame, per_range: int = PER_RANGE) -> DataFrame:
    """The trie of ``(conv_id, seq)``, a row for each node."""
    spark = convs.sparkSession
    send_package(spark)
    flat = stored(convs.select("conv_id", F.transform("seq", lambda t: t["id"]).alias("ids"),
                               F.transform("seq", lambda t: t["bytes"]).alias("bytes")), "conversations")
    turns = flat.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0)).alias("n")).first()["n"]
    ranges = max(1, -(-turns // per_range), min(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // 20_000))
    cut = flat.repartitionByRange(ranges, "ids", "conv_id")
    parts = stored(cut.mapInArrow(_range, PART), "trie-parts")
    shared = parts.where(F.col("key").isNotNull())
    sums = shared.groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes"))
    joined = mapped(sums.coalesce(1), _joined_tree,
                    "key binary, conv_id long, depth long, n_convs long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long")
    joined = stored(joined, "trie-boundary")
    ends = shared.where(F.col("ends").isNotNull()).select("key", "shard", "ends")
    ends = mapped(ends.repartition("key").sortWithinPartitions("key", "shard"), _digests, "key binary, ends_sha256 string")
    names = [c.split()[0] for c in NODE.split(", ")]
    boundary = joined.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).select(*names)
    closed = parts.where(F.col("key").isNull())
    inner = closed.where(F.col("parent").isNull()).select(*names)
    known = joined.select(F.col("key").alias("parent"), F.col("conv_id").alias("_above"))
    outer = closed.where(F.col("parent").isNotNull()).join(known, "parent").withColumn("parent_conv_id", F.col("_above")).select(*names)
    return boundary.unionByName(inner).unionByName(outer)


def trie(rows: DataFrame, per_range: int = PER_RANGE) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations: columns as in ``NODE``."""
    return nodes(rebuilt(sequences(rows)), per_range)


def oracle() -> str:
    """The same in SQL, by every prefix of every conversation."""
    step = "list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    digits = "list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda crc, b: {step}), 4294967295)"
    return f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT conv_id, turn, role, md5(strlen(role)::VARCHAR || ':' || role || text) AS id, strlen(text) AS bytes FROM turns),
convs AS (SELECT conv_id, {crc} % {HEADS} AS h, list(id || bytes::VARCHAR ORDER BY turn NULLS FIRST, role, id) AS seq,
  list(bytes ORDER BY turn NULLS FIRST, role, id) AS bytes FROM keyed GROUP BY conv_id),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.seq[1:c.h], []), c.seq[c.h + 1:]) AS seq,
  list_concat(coalesce(b.bytes[1:c.h], []), c.bytes[c.h + 1:]) AS bytes
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - (c.conv_id % {FAMILY} + {FAMILY}) % {FAMILY}),
prefixes AS (SELECT conv_id, seq[1:d] AS key, d AS depth, len(seq) = d AS ends, CASE WHEN d > 0 THEN bytes[d] ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
  sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id END::VARCHAR, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM prefixes GROUP BY 1, 2),
family AS (SELECT c.key[1:c.depth - 1] AS key, c.depth - 1 AS depth, count(*) AS n_children FROM nodes c WHERE c.depth > 0 GROUP BY 1, 2),
whole AS (SELECT n.*, coalesce(f.n_children, 0) AS n_children, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN family f ON f.key = n.key AND f.depth = n.depth LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]),
below AS (SELECT key[1:a] AS key, a AS depth, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM whole) GROUP BY 1, 2)
SELECT w.conv_id, w.depth, w.parent_conv_id, w.n_convs, w.n_children, b.n_leaves, b.saved_tokens, w.ends_sha256
FROM whole w JOIN below b ON b.key = w.key AND b.depth = w.depth"""
