"""Near-duplicate documents: MinHash signatures joined within a Hamming distance.

1. Every text gives its set of word shingles as 64-bit hashes, and of that set a count, a
   digest and 64 MinHash values of 16 bits, packed four to a long (a chunk).  Texts with equal
   sets are one class from here on.
2. Multi-index Hamming join: if two signatures differ in at most ``DISTANCE`` = 31 of the 64
   values, then by the pigeonhole principle one of the 16 chunks differs in at most one value.
   So each chunk is entered four times, with one value masked; every pair within the distance
   meets under one of 64 keys.  A pair that is as similar as the threshold (0.85) is farther
   apart with a probability of 5e-11 (0.8: 8e-8).
3. A key's classes are first compared with one of them, its smallest; candidates within the
   distance are confirmed on their full sets, and confirmed links become components.
4. Then, under every key that still holds several components, the classes outside its largest
   one are compared with all classes of other components.  Shingles that no other of these
   classes has bound what a class can share: a class, or a pair, that they keep below the
   threshold is out before any pair is formed.  Bound, distance and "not under an earlier key"
   are part of the join condition, so a pair leaves the join once at most.  After this every
   pair within the distance is linked, not similar enough, or joined through others.

A group of copies of any size gives one link per key and class, not all its pairs.  Sets are
computed again for the classes that meet others, and are shuffled for those alone.

Defined results: without words a text has an empty set and is a component of its own; a row
with a null id is not linked (its component is null and it is kept); rows that repeat an id
share the component of their text.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import mapped, stored

VALUES, LANES = 64, 4
CHUNKS = VALUES // LANES
DISTANCE = 2 * CHUNKS - 1
WORDS = 5
SIEVE = 1 << 24  # bits
BLOCK = 1 << 19  # bytes of text worked on at a time
U = np.uint64
_rng = np.random.default_rng(85)
SPREAD = _rng.integers(0, 1 << 63, VALUES, U) * U(2) + U(1)
SHIFT = _rng.integers(0, 1 << 63, VALUES, U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over 64 (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _word_hashes(data: bytes) -> tuple:
    """Hash and start of every word, A-Z in lower case."""
    a = np.frombuffer(data, np.uint8)
    a = np.where((a >= 65) & (a <= 90), a + np.uint8(32), a)
    inside = np.concatenate([[False], (a != 32) & ((a < 9) | (a > 13)), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, U), starts
    lengths = ends - starts
    text = a[inside[1:-1]].astype(U) + U(1)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(text)) - np.repeat(first, lengths)
    by_place = mix((np.arange(int(lengths.max())) + 1).astype(U) * U(0x9E3779B97F4A7C15))
    return mix(np.add.reduceat(text * by_place[place], first) + lengths.astype(U)), starts


def each_text(texts: list):
    """The word hashes of each text in turn.  Short texts are hashed together, long ones in blocks."""
    run, size = [], 0

    def hashed():
        hashes, starts = _word_hashes(b"\n".join(run))
        at = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in run]))
        return [hashes[i:j] for i, j in zip(at[:-1], at[1:])] if run else []

    for t in texts:
        raw = t.encode("utf-8")
        if size + len(raw) > BLOCK:
            yield from hashed()
            run, size = [], 0
        if len(raw) > BLOCK:
            yield _long(raw)
        else:
            run.append(raw)
            size += len(raw) + 1
    yield from hashed()


def words_of(texts: list) -> list:
    return list(each_text(texts))


def _long(raw: bytes) -> np.ndarray:
    parts, at = [], 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1  # a word is never cut
        parts.append(_word_hashes(raw[at:end])[0])
        at = end
    return np.concatenate(parts) if parts else np.empty(0, U)


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the shingles of a text."""
    n = len(words)
    if not n:
        return words
    k = min(n, size)
    h = words[: n - k + 1].copy()
    for i in range(1, k):
        h = mix(h * U(0x9E3779B97F4A7C15) + words[i : n - k + 1 + i])
    return np.unique(h + U(k))


def signature(found: np.ndarray) -> np.ndarray:
    """``CHUNKS`` longs of four 16-bit MinHash values."""
    least = np.full(VALUES, U(2**64 - 1))
    for i in range(0, len(found), 4096):
        part = found[i : i + 4096]
        np.minimum(least, (part[:, None] * SPREAD + SHIFT).min(axis=0), out=least)
    short = mix(least) & U(0xFFFF)
    lanes = short.reshape(CHUNKS, LANES)
    packed = lanes[:, 0]
    for i in range(1, LANES):
        packed = packed | (lanes[:, i] << U(16 * i))
    return packed.view(np.int64)


CHUNK_NAMES = [f"s{i}" for i in range(CHUNKS)]
DIGEST_SCHEMA = "id string, n long, d1 long, d2 long, " + ", ".join(f"{c} long" for c in CHUNK_NAMES)


def _digest(size: int):
    def run(batches):
        for pdf in batches:
            rows = np.zeros((len(pdf), 3 + CHUNKS), np.int64)
            for i, words in enumerate(each_text(pdf["text"].tolist())):
                s = shingles(words, size)
                if len(s):
                    rows[i, 0] = len(s)
                    rows[i, 1:3] = _two(s)
                    rows[i, 3:] = signature(s)
            out = pd.DataFrame(rows, columns=["n", "d1", "d2", *CHUNK_NAMES])
            out.insert(0, "id", pdf["id"])
            yield out

    return run


def _two(found: np.ndarray) -> np.ndarray:
    """A digest of a set, of two longs."""
    return np.array([found.sum(dtype=U), mix(found ^ U(0x5851F42D4C957F2D)).sum(dtype=U)]).view(np.int64)


def _sets(size: int):
    """The sets of texts, where they are those of the classes that the ids stand for."""

    def run(batches):
        for pdf in batches:
            out = []
            for c, d1, d2, words in zip(pdf["id"], pdf["d1"], pdf["d2"], each_text(pdf["text"].tolist())):
                found = shingles(words, size)
                if tuple(_two(found)) == (d1, d2):
                    out.append((c, found.view(np.int64)))
            yield pd.DataFrame(out, columns=["c", "set"])

    return run


def _similar(share: int):
    """Pairs whose sets have ``100 * common >= share * union``."""

    def run(batches):
        for pdf in batches:
            keep = []
            for a, b in zip(pdf["set_a"], pdf["set_b"]):
                x, y = np.asarray(a).view(U), np.asarray(b).view(U)  # sorted without sign
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= share * (len(x) + len(y) - common))
            yield pdf.loc[keep, ["a", "b"]]

    return run


def _masked_keys() -> Column:
    """``(place, key)``: each chunk with one of its values masked."""
    keys = []
    for i in range(CHUNKS):
        for lane in range(LANES):
            mask = ~(0xFFFF << (16 * lane)) & (2**64 - 1)
            mask -= 2**64 if mask >= 2**63 else 0
            place = F.lit(LANES * i + lane)
            key = F.xxhash64(place, F.col(f"s{i}").bitwiseAND(F.lit(mask)))
            keys.append(F.struct(place.alias("place"), key.alias("key")))
    return F.array(*keys)


def _chunk_apart(left: str, right: str, chunk: str) -> Column:
    """In how many of its four values a chunk differs: bits that say which lanes of the xor are not 0."""
    x = F.col(f"{left}.{chunk}").bitwiseXOR(F.col(f"{right}.{chunk}"))
    # adding in the lower 15 bits of a lane carries into its top bit unless they are 0; the
    # lanes are taken in two halves, so that the sum stays within a long
    y = F.shiftrightunsigned(x, 16)
    low, top = F.lit(0x00007FFF00007FFF), F.lit(0x0000800000008000)
    even = (x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(top)
    odd = (y.bitwiseAND(low) + low).bitwiseOR(y).bitwiseAND(top)
    return F.bit_count(even) + F.bit_count(odd)


def _apart(left: str, right: str) -> Column:
    """In how many of the 64 values two rows differ."""
    total = F.lit(0)
    for c in CHUNK_NAMES:
        total = total + _chunk_apart(left, right, c)
    return total


def _first_meeting(left: str, right: str) -> Column:
    """Whether the key of the rows is the first under which they meet."""
    place = F.col(f"{left}.place")
    first = F.coalesce(*[F.when(_chunk_apart(left, right, c) <= 1, F.lit(i)) for i, c in enumerate(CHUNK_NAMES)])
    chunk, lane = F.shiftright(place, 2), place.bitwiseAND(F.lit(3))
    same = F.coalesce(*[F.when(chunk == i, F.col(f"{left}.{c}") == F.col(f"{right}.{c}")) for i, c in enumerate(CHUNK_NAMES)])
    return (first == chunk) & ((lane == 0) | ~same)


def _near(left: str, right: str, share: int) -> Column:
    """Sizes that allow the similarity, then signatures within the distance."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return (F.least(a, b) * 100 >= F.greatest(a, b) * share) & (_apart(left, right) <= DISTANCE)


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(c, comp)`` for every node of the edges ``(a, b)``: the smallest node it can reach.

    Each round takes the least label among neighbours, then the label of that label, until
    nothing changes; rounds are written to the shared folder.
    """
    both = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                  .union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("comp")).withColumnRenamed("u", "c")
    labels = stored(labels, f"{name}-labels")
    while True:
        told = both.join(labels, both["v"] == labels["c"]).groupBy("u").agg(F.min("comp").alias("told"))
        now = labels.join(told, labels["c"] == told["u"]).select("c", "comp", F.least("comp", "told").alias("next"))
        jump = labels.select(F.col("c").alias("j"), F.col("comp").alias("jumped"))
        now = now.join(jump, now["next"] == jump["j"]).select("c", F.least("next", "jumped").alias("comp"), F.col("comp").alias("was"))
        now = stored(now, f"{name}-labels")
        labels = now.select("c", "comp")
        if not now.where("comp <> was").limit(1).count():
            return labels


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = 85, size: int = WORDS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row; ``share`` in hundredths."""
    # ids travel to Python as strings: pandas would turn longs with nulls into floats
    rows = docs.select(F.col(key).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digests = mapped(rows, _digest(size), DIGEST_SCHEMA)
    digests = stored(digests.withColumn("id", F.col("id").cast("long")), "dup-digests")
    rows = rows.withColumn("id", F.col("id").cast("long"))
    classes = digests.where("n > 0 AND id IS NOT NULL").groupBy("d1", "d2", "n").agg(
        F.min("id").alias("c"), *[F.first(s).alias(s) for s in CHUNK_NAMES])
    classes = stored(classes, "dup-classes")
    keyed = classes.select("c", F.explode(_masked_keys()).alias("k")).select("c", "k.place", "k.key")
    shared = keyed.groupBy("key").agg(F.count("*").alias("many"), F.min("c").alias("centre")).where("many > 1")
    met = stored(keyed.join(shared.select("key", "centre"), "key"), "dup-keys")
    asked = classes.join(met.select("c").distinct(), "c", "left_semi").select(F.col("c").alias("id"), "d1", "d2")
    sets = _sets_of(rows, stored(asked, "dup-asked"), size)

    signed = classes.select("c", "n", *CHUNK_NAMES)
    first = met.where("c <> centre").select(F.col("centre").alias("a"), F.col("c").alias("b")).distinct()
    x, y = signed.alias("x"), signed.alias("y")
    first = first.join(x, F.col("a") == F.col("x.c")).join(y, F.col("b") == F.col("y.c")).where(_near("x", "y", share))
    edges = stored(_confirmed(first.select("a", "b"), sets, share), "dup-links")
    label = components(edges, "dup-first")

    # what is left: keys with several components
    placed = met.join(label, "c", "left").select("key", "place", "c", F.coalesce("comp", "c").alias("comp"))
    by_key = placed.groupBy("key", "comp").agg(F.count("*").alias("many"))
    mixed = by_key.groupBy("key").agg(
        F.count("*").alias("comps"), F.max(F.struct("many", "comp"))["comp"].alias("largest")).where("comps > 1")
    open_keys = stored(placed.join(mixed.select("key", "largest"), "key"), "dup-open")
    live = sets.join(open_keys.select("c").distinct(), "c", "left_semi")
    for turn in range(2):  # without the classes that are out, others have more of their own
        live = stored(_sharing(live, share), f"dup-live{turn}")
    open_keys = open_keys.join(live.select("c", "own"), "c").join(signed, "c")
    x, y = open_keys.where("comp <> largest").alias("x"), open_keys.alias("y")
    # a pair of two classes outside the largest component is formed from its smaller side alone
    once = (F.col("y.comp") == F.col("y.largest")) | (F.col("x.c") < F.col("y.c"))
    crossed = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & once
                     & _bounded("x", "y", share) & _near("x", "y", share) & _first_meeting("x", "y"))
    second = stored(crossed.select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b")).distinct(), "dup-second")
    more = _confirmed(second, sets, share)
    own = label.select(F.col("c").alias("a"), F.col("comp").alias("b"))
    label = components(stored(own.union(more.select("a", "b")), "dup-links"), "dup-all")

    named = classes.select("d1", "d2", "n", "c").join(label, "c", "left").select(
        "d1", "d2", "n", F.coalesce("comp", "c").alias("comp"))
    out = digests.select("id", "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _sets_of(rows: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """``(c, n, set)`` of the classes asked for; a class is named by the smallest id of its texts."""
    texts = _sifted(rows.where("id IS NOT NULL"), asked).join(asked, "id")
    once = texts.withColumn("_t", F.xxhash64("text")).dropDuplicates(["id", "_t"]).select("id", "d1", "d2", "text")
    found = mapped(once, _sets(size), "c long, set array<long>")
    return stored(found.select("c", F.size("set").alias("n"), "set"), "dup-sets")


def _sharing(sets: DataFrame, share: int) -> DataFrame:
    """The classes that may be similar to another of them, with ``own``: how many shingles no other has."""
    single = sets.select("c", F.explode("set").alias("s")).groupBy("s").agg(
        F.min("c").alias("c"), F.max("c").alias("d")).where("c = d")
    own = single.groupBy("c").agg(F.count("*").alias("own"))
    joined = sets.select("c", "n", "set").join(own, "c", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    return joined.where((F.col("n") - F.col("own")) * 100 >= F.col("n") * share)


def _bounded(left: str, right: str, share: int) -> Column:
    """Whether the shingles of their own leave two sets enough in common."""
    a, b, p, q = (F.col(c) for c in (f"{left}.n", f"{right}.n", f"{left}.own", f"{right}.own"))
    return F.least(a - p, b - q) * 100 >= F.greatest(a + q, b + p) * share


def _confirmed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs ``(a, b)`` that are similar enough on their full sets."""
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("c").alias("b"), F.col("set").alias("set_b")), "b")
    return mapped(both.select("a", "b", "set_a", "set_b"), _similar(share), "a long, b long")


def _sifted(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows whose id may be asked for, so that the others are not shuffled.

    A bitmap of ``SIEVE`` bits (2 MB, whatever the data) holds a hash of every id asked for.
    """
    def hashed(c):
        return F.pmod(F.xxhash64(c), F.lit(SIEVE)).cast("int")

    bits = asked.select(hashed("id").alias("h")).groupBy(F.shiftright("h", 15).alias("_page")).agg(
        F.bitmap_construct_agg(F.col("h").bitwiseAND(F.lit(32767)).cast("long")).alias("_bits"))
    at = F.col("_h").bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substr("_bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.when(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), at.bitwiseAND(F.lit(7)) + 1)) != 0, True)
    hashes = rows.withColumn("_h", hashed("id")).withColumn("_page", F.shiftright("_h", 15))
    return hashes.join(F.broadcast(bits), "_page").where(bit).select(*rows.columns)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", share: int = 80, size: int = WORDS) -> DataFrame:
    """The documents without near-duplicates: of each component, the one with the smallest id.

    Whole rows that repeat are one document; rows without an id stay.
    """
    kept = linked(docs, key, text, share, size).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept")).distinct()
    # whole rows travel as one column, so none of their names can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("id"),
                       F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    once = rows.join(kept, F.col("id") == F.col("kept"), "left_semi").dropDuplicates(["id", "hash"])
    return once.union(rows.where("id IS NULL")).select("row.*")
