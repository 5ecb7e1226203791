"""Suffix-array dedup: bytes that lie in a string of ``LENGTH`` bytes which also starts elsewhere are removed.

Every string of ``LENGTH`` bytes is anchored at the leftmost least hash of its substrings of
``GRAM`` bytes.  Equal strings have equal anchors, so strings are only compared with those of the
same anchor.  Neighbouring strings with one anchor place form a region (about 140 starts):

1. Each region becomes its anchor, a digest and its place; regions whose digest occurs twice are
   repeated as a whole, whatever the number of their copies.
2. Of the other anchors with several different regions, one region of each digest is read from the
   texts.  Shards hold whole anchors and about ``SHARD`` bytes.  A region is cut down to the starts of
   which ``WIDTHS[0]`` neighbours share what they have in common with another region of the anchor, as no
   others can be repeated; the suffix array of the rest is made by induced sorting and its permuted
   common prefixes tell the repeated starts.
3. An anchor with more than ``LIMIT`` different regions is cut further, by the part that 32 (then 1)
   neighbouring starts have in common, so that no group outgrows a shard; the last cut leaves
   equal strings only, which are counted.
4. The repeated starts go back to every occurrence of their region, and each text loses what they cover.

Texts are told apart by a digest of id and text, so equal rows need no number; they are occurrences of
their own.  Anchors and shards decide which strings are compared, never whether they are equal.

Defined results: a null text is empty; a text shorter than ``LENGTH`` bytes stays whole; matches are judged
on the input and never cross texts; repeated rows lose every text of at least ``LENGTH`` bytes; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import send_package, stored
from foretell.llm.suffixes import repeated_starts

LENGTH, GRAM = 400, 128
STEP = 1 << 17  # starts handled at a time, which bounds memory in long texts
SHARD = 1 << 21  # bytes of a suffix array
LIMIT = 1000  # different regions of an anchor that one suffix array may hold
WIDTHS = (32, 1)  # neighbouring starts that are cut out together of larger groups

_random = np.random.default_rng(13)
_SYMBOL = _random.integers(0, 1 << 63, 256, dtype=np.uint64)
_FACTOR = 0x9E3779B97F4A7C15  # odd, so that its powers can be undone
_POS = 18  # bits for a place within a step


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(factor)
    return np.multiply.accumulate(out)


def _hashes(data: np.ndarray, gram: int, powers: tuple) -> np.ndarray:
    """A hash of every substring of ``gram`` bytes."""
    up, down = powers
    n = len(data)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_SYMBOL[data] * up[:n])])
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, by running minima from both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[: n - width + 1], from_left[width - 1 : n])


class Cutter:
    """Cuts texts into regions."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, min(gram, length)
        size = STEP + length
        self.powers = _powers(_FACTOR, size), _powers(pow(_FACTOR, -1, 1 << 64), size)

    def regions(self, data: np.ndarray):
        """``(anchor hashes, first starts, numbers of starts, places of the anchor after the first start)``."""
        total = len(data) - self.length + 1
        mask = np.uint64((1 << _POS) - 1)
        for at in range(0, total, STEP):
            n = min(STEP, total - at)
            h = _hashes(data[at : at + n + self.length - 1], self.gram, self.powers)
            packed = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
            anchor = (_least(packed, self.length - self.gram + 1) & mask).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            yield h[anchor[first]].view(np.int64), first + at, np.diff(np.append(first, n)), anchor[first] - first


def _digest(*parts: bytes) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for p in parts:
        h.update(p)
    return h.digest()


def _texts(batch, name: str = "text"):
    column = batch.column(name).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else [0]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for i in range(len(column)):
        yield data[offsets[i] : offsets[i + 1]]


PLACED = "key long, digest binary, uid binary, at long, n int, lead int"


def _placed(length: int, gram: int):
    """The regions of every text, without their bytes."""
    def run(batches):
        cutter = Cutter(length, gram)
        for batch in batches:
            held, size = [], 0

            def out():
                columns = [np.concatenate([h[i] for h in held]) for i in range(4)]
                digests = [d for h in held for d in h[4]]
                uids = [h[5] for h in held for _ in h[4]]
                return pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), pa.array(digests, pa.binary()), pa.array(uids, pa.binary()), pa.array(columns[1]),
                     pa.array(columns[2].astype(np.int32)), pa.array(columns[3].astype(np.int32))],
                    ["key", "digest", "uid", "at", "n", "lead"])

            for uid, data in zip(batch.column("uid").to_pylist(), _texts(batch)):
                for key, first, n, lead in cutter.regions(data):
                    digests = [_digest(data[a : a + k + length - 1]) for a, k in zip(first.tolist(), n.tolist())]
                    held.append((key, first, n, lead, digests, uid))
                    size += len(key)
                    if size > 100_000:
                        yield out()
                        held, size = [], 0
            if held:
                yield out()

    return run


REGION = "key long, digest binary, n int, lead int, body binary"


def _read(length: int):
    """The bytes of the chosen regions of every text."""
    def run(batches):
        for batch in batches:
            held, size = [], 0
            for data, wanted in zip(_texts(batch), batch.column("wanted").to_pylist()):
                for w in wanted:
                    held.append((w["key"], w["digest"], w["n"], w["lead"], data[w["at"] : w["at"] + w["n"] + length - 1].tobytes()))
                    size += w["n"] + length
                    if size > 1 << 24:
                        yield _rows(held, REGION)
                        held, size = [], 0
            if held:
                yield _rows(held, REGION)

    return run


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _rows(rows: list, schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], _ARROW[t]) for i, t in enumerate(types)], list(names))


FOUND = "key long, digest binary, first int, last int"


def _classes(n: int, lead: int, length: int, width: int):
    """``(first, last, low, begin, end)``: runs of starts that have the same ``width`` distances to the anchor, from ``low`` on.

    All of them hold the bytes from ``begin`` to ``end`` of the region, which stand at the same place before
    and behind the anchor in every region with such a run.
    """
    first = 0
    while first < n:
        low = (lead - first) // width * width
        last = min(n - 1, lead - low)
        yield first, last, low, lead - low, lead - low - width + 1 + length
        first = last + 1


def _promising(group: list, length: int, width: int) -> list:
    """``(owner, first, body)``: the parts of the regions of one anchor that may hold a repeated start."""
    marks: list = []
    seen: dict = {}
    for _, _, n, lead, body in group:
        own = [(first, last, (low, body[begin:end])) for first, last, low, begin, end in _classes(n, lead, length, width)]
        marks.append(own)
        for _, _, mark in own:
            seen[mark] = seen.get(mark, 0) + 1
    out = []
    for (key, digest, _, _, body), own in zip(group, marks):
        start = None
        for first, last, mark in [*own, (0, 0, None)]:
            if seen.get(mark, 0) > 1:
                start = first if start is None else start
                end = last
            elif start is not None:
                out.append(((key, digest), start, body[start : end + length]))
                start = None
    return out


def _sorted_shards(length: int, size: int, width: int):
    """Repeated starts of regions, by suffix arrays over whole anchors; rows come sorted by anchor."""
    def run(batches):
        group, held, total = [], [], 0

        def out():
            found = repeated_starts([h[2] for h in held], length)
            return _rows([(*held[b][0], first + held[b][1], last + held[b][1]) for b, first, last in found], FOUND)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "digest", "n", "lead", "body"))):
                if group and row[0] != group[0][0]:
                    held += _promising(group, length, width)
                    total = sum(len(h[2]) for h in held)
                    group = []
                    if total >= size:
                        yield out()
                        held = []
                group.append(row)
        held += _promising(group, length, width)
        if held:
            yield out()

    return run


PIECE = "key long, digest binary, owner_key long, owner binary, shift int, n int, lead int, body binary"


def _pieces(length: int, width: int):
    """Regions cut into ``width`` starts, grouped by what these starts have in common."""
    def run(batches):
        for batch in batches:
            out, size = [], 0
            columns = (batch.column(c).to_pylist() for c in ("key", "digest", "n", "lead", "body"))
            for key, digest, n, lead, body in zip(*columns):
                for first, last, low, begin, end in _classes(n, lead, length, width):
                    piece, before = body[first : last + length], lead - first
                    sign = _digest(key.to_bytes(8, "big", signed=True), low.to_bytes(4, "big"), body[begin:end])
                    own = _digest(before.to_bytes(4, "big"), piece)
                    out.append((int.from_bytes(sign[:8], "big", signed=True), own, key, digest, first, last - first + 1, before, piece))
                    size += len(piece)
                    if size > 1 << 24:
                        yield _rows(out, PIECE)
                        out, size = [], 0
            if out:
                yield _rows(out, PIECE)

    return run


def _repeats(regions: DataFrame, length: int, shard: int, limit: int, widths: tuple) -> DataFrame:
    """``FOUND``: repeated starts in different regions of one anchor; ``regions`` are stored, as ``REGION``."""
    spark = regions.sparkSession
    kinds = regions.groupBy("key").agg(F.count("*").alias("kinds"), F.sum(F.octet_length("body")).alias("size"))
    kinds = stored(kinds.where(F.col("kinds") > 1), "anchors")
    large = kinds.where(F.col("kinds") > limit).agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    total = kinds.where(F.col("kinds") <= limit).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = max(1, -(-total // shard), min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (shard // 16)))
    small = regions.join(kinds.where(F.col("kinds") <= limit).select("key"), "key").select("key", "digest", "n", "lead", "body")
    found = small.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_sorted_shards(length, shard, WIDTHS[0]), FOUND)
    if not large[0]:
        return found
    crowded = regions.join(kinds.where(F.col("kinds") > limit).select("key"), "key")
    pieces = stored(crowded.mapInArrow(_pieces(length, widths[0]), PIECE), "pieces")
    groups = stored(pieces.groupBy("key", "digest").agg(F.count("*").alias("copies"), F.first("n").alias("n"), F.first("lead").alias("lead"),
                                                        *([F.first("body").alias("body")] if len(widths) > 1 else [])), "piece-groups")
    again = groups.where(F.col("copies") > 1).select("key", "digest", F.lit(0).alias("first"), (F.col("n") - 1).alias("last"))
    if len(widths) > 1:
        again = again.unionByName(_repeats(groups.select(*[c.split()[0] for c in REGION.split(", ")]), length, shard, limit, widths[1:]))
    back = pieces.select("key", "digest", "owner_key", "owner", "shift").join(again, ["key", "digest"])
    return found.unionByName(back.select(F.col("owner_key").alias("key"), F.col("owner").alias("digest"),
                                         (F.col("first") + F.col("shift")).alias("first"), (F.col("last") + F.col("shift")).alias("last")))


def _uid(key: str, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), text)))


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, shard: int = SHARD,
             limit: int = LIMIT, widths: tuple = WIDTHS) -> DataFrame:
    """``(uid, first, last)``: runs of starts of repeated strings in every text; ``uid`` as in ``texts``."""
    send_package(docs.sparkSession)
    rows = texts(docs, key, text)
    long = rows.where(F.octet_length("text") >= length)
    placed = stored(long.select("uid", "text").mapInArrow(_placed(length, gram), PLACED), "regions")
    kinds = stored(placed.groupBy("key", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("uid", "at", "n", "lead")).alias("one")), "region-kinds")
    several = kinds.groupBy("key").agg(F.count("*").alias("kinds")).where(F.col("kinds") > 1).select("key")
    chosen = kinds.join(several, "key").select("one.uid", F.struct("key", "digest", "one.at", "one.n", "one.lead").alias("w"))
    wanted = chosen.groupBy("uid").agg(F.collect_list("w").alias("wanted"))
    # a text that stands twice gives its regions twice; they are copies anyway, and found as such
    regions = stored(long.join(wanted, "uid").select("text", "wanted").mapInArrow(_read(length), REGION), "region-bytes")
    whole = kinds.where(F.col("copies") > 1).select("key", "digest", F.lit(0).alias("first"), (F.col("one.n") - 1).alias("last"))
    found = stored(whole.unionByName(_repeats(regions, length, shard, limit, widths)), "repeats")
    return placed.select("key", "digest", "uid", "at").join(found, ["key", "digest"]).select(
        "uid", (F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("last")).alias("last"))


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(uid, id, text)``: the texts with a digest of id and text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(_uid(key, whole).alias("uid"), F.col(key).alias("id"), whole.alias("text"))


def _kept(length: int):
    schema = [pa.int64()] * 4 + [pa.binary()]

    def run(batches):
        for batch in batches:
            rows = []
            for i, data, starts in zip(batch.column("id").to_pylist(), _texts(batch), batch.column("starts").to_pylist()):
                spans: list = []
                for first, last in sorted((s["first"], s["last"]) for s in starts or ()):
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last + length)
                    else:
                        spans.append([first, last + length])
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
                rows.append((i, len(data), len(data) - len(kept), len(spans), kept))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(schema)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def stripped(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, **settings) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: what is left of every text, as bytes."""
    spans = repeated(docs, key, text, length, **settings)
    starts = spans.distinct().groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("starts"))
    rows = texts(docs, key, text).withColumn("id", F.col("id").cast("long")).join(starts, "uid", "left")
    return rows.select("id", "text", "starts").mapInArrow(
        _kept(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame, **settings) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``."""
    return stripped(docs, **settings).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def oracle(length: int = LENGTH) -> str:
    """The same in SQL, by every string of every text."""
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
strings AS (SELECT r, unnest(range(0, len(x) // 2 - {length - 1})) AS i FROM texts WHERE len(x) >= {2 * length}),
marked AS (SELECT s.r, s.i, md5(substr(t.x, (2 * s.i + 1)::BIGINT, {2 * length})) AS h FROM strings s JOIN texts t USING (r)),
again AS (SELECT h FROM marked GROUP BY h HAVING count(*) > 1),
hits AS (SELECT m.r, m.i FROM marked m SEMI JOIN again USING (h)),
runs AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {length} THEN 0 ELSE 1 END AS new FROM hits)),
spans AS (SELECT r, min(i) AS a, max(i) + {length} AS b FROM runs GROUP BY r, run),
edges AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT e.r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
  string_agg(substr(t.x, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a) AS kept FROM edges e JOIN texts t USING (r) GROUP BY e.r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(from_hex(CASE WHEN n_spans IS NULL THEN x ELSE kept || substr(x, (2 * last + 1)::BIGINT) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)"""
