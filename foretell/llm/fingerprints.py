"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over a window of seven bytes marks chunk boundaries where its low bits are
all ones; the number of bits sets the block size.  The block size of a text is the smallest
power of two that leaves it ``MOST`` boundaries at most, so it follows from the text alone.
Every chunk gives one character, and a fingerprint holds the signatures at the block size
and at its double: ``block:signature:signature``.  Two fingerprints compare where they have
a block size in common, by one less the edit distance over the longer length.

Each document also meets the one after it (ascending ``doc_id``): ranges of ids, cut at ids
that exist, are sorted in one shuffle, and the document at each cut is sent to the range
before it as well, so that no range needs another.  A range is streamed.

Defined results: a null text is empty and has the fingerprint ``2::``; equal fingerprints
have likeness 1, without a common block size it is 0.  Null ids come last.  Rows with one
id stand in the order of a hash of their text.  A table of one document is its own next
one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import mapped
from foretell.operators.index import bucket_of

WINDOW = 7
MOST = 64  # boundaries of the first signature at most
RANGES = 4  # ranges of ids by shuffle partition
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
# a number for each byte value and a multiplier for each place of the window
BYTE = np.random.default_rng(7).integers(0, 1 << 32, 256, np.uint32)
PLACE = np.random.default_rng(8).integers(0, 1 << 31, WINDOW, np.uint32) * np.uint32(2) + np.uint32(1)


def _rolling(data: bytes) -> np.ndarray:
    """A mixed hash of the last ``WINDOW`` bytes at every position."""
    x = BYTE[np.frombuffer(data, np.uint8)]
    h = x * PLACE[0]
    for k in range(1, min(WINDOW, len(x))):
        h[k:] += x[:-k] * PLACE[k]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return h


def _signature(h: np.ndarray, values: np.ndarray, ends: np.ndarray) -> str:
    """One character per chunk; the last chunk has what follows the last boundary."""
    starts = np.concatenate([[0], ends + 1])
    if starts[-1] == len(h):
        starts = starts[:-1]
    sums = np.add.reduceat(values, starts, dtype=np.uint32)
    sums ^= sums >> np.uint32(16)
    return ALPHABET[(sums * np.uint32(0x9E3779B1)) >> np.uint32(26)].tobytes().decode()


def fingerprint(text: str | bytes) -> str:
    data = text.encode("utf-8") if isinstance(text, str) else text
    if not data:
        return "2::"
    h = _rolling(data)

    def ends(bits, among=None):
        mask = np.uint32((1 << bits) - 1)
        if among is None:
            return np.flatnonzero((h & mask) == mask)
        return among[(h[among] & mask) == mask]

    bits = max(1, (len(data) // (2 * MOST)).bit_length() - 1)
    found = ends(bits)
    while bits > 1 and len(found) <= MOST:
        bits -= 1
        found = ends(bits)
    while len(found) > MOST and bits < 31:
        bits += 1
        found = ends(bits, found)
    values = h * np.uint32(0x85EBCA77)
    values ^= values >> np.uint32(13)
    return f"{1 << bits}:{_signature(h, values, found)}:{_signature(h, values, ends(bits + 1, found) if bits < 31 else found)}"


def distance(a: str, b: str) -> int:
    """Edit distance (insert, delete, replace), a bit per character of ``a`` (Myers, 1999)."""
    if not a or not b:
        return len(a) + len(b)
    where: dict = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top, out = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    plus, minus = full, 0
    for c in b:
        eq = where.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(across | plus) & full, plus & across
        out += 1 if up & top else -1 if down & top else 0
        up, down = (up << 1 | 1) & full, down << 1 & full
        plus, minus = down | ~(eq | minus | up) & full, up & (eq | minus)
    return out


def likeness(a: str, b: str) -> float:
    """From 0 to 1; the better of the block sizes that both fingerprints have."""
    if a == b:
        return 1.0
    (p, a1, a2), (q, b1, b2) = a.split(":"), b.split(":")
    p, q = int(p), int(q)
    pairs = [(x, y) for s, x in ((p, a1), (2 * p, a2)) for t, y in ((q, b1), (2 * q, b2)) if s == t]
    return max([1 - distance(x, y) / max(len(x), len(y)) for x, y in pairs if x or y], default=0.0)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` of every text, where the rows lie."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["_key"], "fingerprint": [fingerprint(t) for t in pdf["_text"]]})

    rows = docs.select(F.col(key).cast("string").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return _with_id(mapped(rows, run, "doc_id string, fingerprint string"))


SCHEMA = ("doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _with_id(df: DataFrame) -> DataFrame:
    """Ids travel to Python and back as strings: pandas would turn longs with nulls into floats."""
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text, and both likenesses."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # ids that exist, in the number of ranges; this pass reads the ids alone
    shares = [i / (RANGES * parts) for i in range(RANGES * parts)]
    cuts = rows.agg(F.min("id"), F.percentile_approx("id", shares, 10 * len(shares))).first()
    bounds = sorted({*(cuts[1] or []), cuts[0]} - {None})
    last = max(len(bounds) - 1, 0)
    listed = F.array(*[F.lit(b).cast("long") for b in bounds]).cast("array<long>")
    at = F.when(F.col("id").isNull(), F.lit(last)).otherwise(bucket_of(F.col("id"), listed, len(bounds)) - 1).cast("int")
    cut = F.col("id") == F.get(listed, F.col("_at")) if bounds else F.col("id").isNull()
    before = F.pmod(F.col("_at") - 1, F.lit(last + 1)).cast("int")
    # a row for its own range (0) and, at a cut, one for the range before (1)
    own = F.struct(F.col("_at").alias("range"), F.lit(0).alias("edge"))
    both = F.array(own, F.struct(before.alias("range"), F.lit(1).alias("edge")))
    dealt = rows.withColumn("_at", at).select(
        F.explode(F.when(F.coalesce(cut, F.lit(False)), both).otherwise(F.array(own))).alias("to"), "id", "text")
    dealt = dealt.select("to.range", "to.edge", "id", "text", F.xxhash64("text").alias("tie"))
    ordered = dealt.repartition(parts, "range").sortWithinPartitions(
        "range", "edge", F.col("id").asc_nulls_last(), "tie")
    return _with_id(mapped(ordered.withColumn("id", F.col("id").cast("string")), _streamed, SCHEMA))


def _streamed(batches):
    held = None  # (range, id, text, fingerprint) that waits for its next document
    for pdf in batches:
        out = []
        for part, edge, i, t in zip(pdf["range"], pdf["edge"], pdf["id"], pdf["text"]):
            if edge and (held is None or held[0] != part):
                continue  # a further row with the id of the cut
            f = fingerprint(t)
            if held is not None:
                if held[0] != part:
                    raise ValueError("a range ended without the first document of the next one")
                out.append(_compared(held, t, f))
            held = None if edge else (part, i, t, f)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    if held is not None and held[1] is None and held[0] == 0:
        # without any id there is no cut: the documents without one follow each other, the last stands alone
        t = held[2]
        yield pd.DataFrame([_compared(held, t, held[3])], columns=[c.split()[0] for c in SCHEMA.split(", ")])
    elif held is not None:
        raise ValueError("a range ended without the first document of the next one")


def _compared(held, following: str, its: str) -> tuple:
    _, i, t, f = held
    changed = edited(t, following)
    raw = changed.encode("utf-8")
    g = fingerprint(raw)
    return i, len(t), hashlib.sha256(raw).hexdigest(), f, g, likeness(f, g), likeness(f, its)
