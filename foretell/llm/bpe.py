"""Byte-level BPE encoding and decoding on padded matrices.

A text is cut by the tokenizer's pattern; each piece is encoded on its own.  The distinct
pieces of a slice of documents are laid out in matrices, one per length class: a row holds
the token ids of a piece, padded.  In each round every row merges its leftmost pair of least
rank, found by one look at the ranks of all its adjacent pairs; the rest of the row moves one
place left.  Pairs are looked up in an open hash table.  Rows without a pair left leave the
matrix.  A piece that is a token itself is that token, as in the public library; a piece
longer than ``WIDEST`` bytes does the same merges one by one from a heap, in n log n.

Documents are mapped where they lie, without a shuffle; pieces of long texts are streamed.
Known pieces are kept up to ``KEPT`` of them, which saves work and changes nothing.

Defined results: a null text is empty; an empty text has no tokens (and the digest of
nothing).  Rows that repeat are encoded each.  Lone surrogates cannot occur in a string
column.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from bisect import bisect_left
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import regex

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import mapped

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WIDTHS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512)
WIDEST = WIDTHS[-1]
KEPT = 200_000  # pieces remembered by a worker
SLICE = 1 << 20  # characters cut into pieces at a time
PIECES = 100_000  # pieces of one long text at a time
NONE = np.int32(2**31 - 1)  # rank of a pair that is no token
SLOT = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing with linear probing."""

    def __init__(self, pairs: dict):
        self.bits = max(4, (4 * len(pairs) + 1).bit_length())
        keys = np.fromiter(((a << 32) | b for a, b in pairs), np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64(2**64 - 1))
        self.values = np.full(size, NONE)
        self.probes, slot = 0, self._slot(keys)
        while len(keys):  # one key settles in each free slot, the rest look at the next slot
            self.probes += 1
            free = self.keys[slot] == np.uint64(2**64 - 1)
            first = np.zeros(len(slot), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & (size - 1)

    def _slot(self, keys):
        return ((keys * SLOT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot, shape = self._slot(keys), keys.shape
        keys, slot = keys.ravel(), slot.ravel()
        out = np.where(self.keys[slot] == keys, self.values[slot], NONE)
        rest = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != np.uint64(2**64 - 1)))
        for _ in range(self.probes):
            if not len(rest):
                break
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (found != np.uint64(2**64 - 1))]
        return out.reshape(shape)


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranked = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in ranked}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(len(self.tokens))]
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pad = len(self.tokens)  # no pair holds it
        ranks, pairs = self.ranks, {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pairs, self.table = pairs, PairTable(pairs)
        self.pattern = regex.compile(pattern)
        self.known: dict = {}

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def pieces(self, text: str):
        """The pieces of a text in lists of bounded length, each known when it is given out."""
        matches = self.pattern.finditer(text)
        while part := [m.group() for m in islice(matches, PIECES)]:
            self.learn(part)
            yield part

    def learn(self, pieces) -> None:
        """Encodes those of the pieces that are not known yet."""
        pieces = set(pieces)
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > KEPT:
            self.known, new = {}, pieces
        classes: dict = {}
        for piece in new:
            raw = piece.encode("utf-8")
            rank = self.ranks.get(raw)
            if rank is not None:
                self.known[piece] = (rank,)
            elif len(raw) > WIDEST:
                self.known[piece] = self._by_heap(raw)
            else:
                classes.setdefault(bisect_left(WIDTHS, len(raw)), []).append((piece, raw))
        for width, rows in classes.items():
            for start in range(0, len(rows), part := max(1, (1 << 20) // WIDTHS[width])):
                self._by_matrix(WIDTHS[width], rows[start:start + part])

    def _by_matrix(self, width: int, rows: list) -> None:
        lengths = np.fromiter((len(raw) for _, raw in rows), np.int64, len(rows))
        ids = np.full((len(rows), width), self.pad, np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.bytes[np.frombuffer(b"".join(raw for _, raw in rows), np.uint8)]
        ranks = self.table.look(ids[:, :-1], ids[:, 1:])
        who = np.arange(len(rows))
        place = np.arange(width)
        while len(who):
            at = ranks.argmin(axis=1)  # the leftmost of the least rank
            line = np.arange(len(who))
            least = ranks[line, at]
            over = least == NONE
            if over.any():  # finished rows leave
                for i, row, n in zip(who[over].tolist(), ids[over].tolist(), lengths[who[over]].tolist()):
                    self.known[rows[i][0]] = tuple(row[:n])
                keep = ~over
                who, ids, ranks, at, least = who[keep], ids[keep], ranks[keep], at[keep], least[keep]
                if not len(who):
                    break
                line = np.arange(len(who))
            ids[line, at] = least
            lengths[who] -= 1
            longest = int(lengths[who].max())
            moved = place[:longest] + (place[:longest] > at[:, None])
            ids = np.concatenate([np.take_along_axis(ids, np.minimum(moved, ids.shape[1] - 1), 1),
                                  np.full((len(who), 1), self.pad, np.int32)], axis=1)
            # the last column of a full row was moved, not doubled
            ids[np.arange(ids.shape[1]) >= lengths[who][:, None]] = self.pad
            moved = np.minimum(moved, ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, moved, 1)
            ranks[line, at] = self.table.look(ids[line, at], ids[line, at + 1])
            before = np.maximum(at - 1, 0)
            left = self.table.look(ids[line, before], ids[line, before + 1])
            ranks[line, before] = left
            ranks[np.arange(ranks.shape[1]) >= (lengths[who] - 1)[:, None]] = NONE

    def _by_heap(self, raw: bytes) -> tuple:
        """The same merges for one long piece: linked parts and a heap of (rank, position)."""
        ids = self.bytes[np.frombuffer(raw, np.uint8)].tolist()
        n = len(ids)
        after, before, pairs = list(range(1, n + 1)), list(range(-1, n - 1)), self.pairs
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get((ids[i], ids[j])) != rank:
                continue  # a part has merged elsewhere since
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get((rank, ids[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := pairs.get((ids[h], rank))) is not None:
                heapq.heappush(heap, (r, h))
        return tuple(i for i in ids if i >= 0)

    def encode(self, text: str) -> list:
        return self.ids(self.pieces(text))

    def ids(self, parts) -> list:
        out = []
        for part in parts:
            out.extend(chain.from_iterable(map(self.known.__getitem__, part)))
        return out

    def digest(self, parts) -> tuple:
        """(number of tokens, digest of the ids, digest of the decoded bytes), in bounded memory."""
        n, names, raw = 0, hashlib.sha256(), hashlib.sha256()
        for part in parts:
            ids = list(chain.from_iterable(map(self.known.__getitem__, part)))
            if ids:
                names.update((("," if n else "") + ",".join(map(self.names.__getitem__, ids))).encode())
                raw.update(self.decode(ids))
                n += len(ids)
        return n, names.hexdigest(), raw.hexdigest()

    def cut(self, texts: list) -> list:
        """The pieces of each text, as an iterable of lists; those of short texts are learnt in one go."""
        if sum(map(len, texts)) > SLICE:
            return [self.pieces(t) for t in texts]
        found = [self.pattern.findall(t) for t in texts]
        self.learn(chain.from_iterable(found))
        return [(p,) for p in found]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    return Codec(path, pattern)


def _slices(texts: list):
    """Runs of texts of together about ``SLICE`` characters."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > SLICE:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def _mapped(docs: DataFrame, key: str, text: str, schema: str, one, path, pattern) -> DataFrame:
    path, pattern = path or vocabulary_path(), pattern or split_pattern()

    def run(batches):
        c = codec(path, pattern)
        for pdf in batches:
            rows = []
            for texts in _slices(pdf["_text"].tolist()):
                rows.extend(one(c, texts))
            yield pd.concat([pdf[["_key"]], pd.DataFrame(rows, columns=["a", "b", "c"][: len(rows[0]) if rows else 3])],
                            axis=1).set_axis([p.split()[0] for p in schema.split(", ")], axis=1)

    rows = docs.select(F.col(key).cast("string").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # ids travel as strings: pandas would turn longs with nulls into floats
    return mapped(rows, run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def _digests(c: Codec, texts: list) -> list:
    return [c.digest(parts) for parts in c.cut(texts)]


def _ids(c: Codec, texts: list) -> list:
    return [(c.ids(parts),) for parts in c.cut(texts)]


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
            pattern: str | None = None) -> DataFrame:
    """``(doc_id, ids)``: the token ids of every text."""
    return _mapped(docs, key, text, "doc_id string, ids array<int>", _ids, path, pattern)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
            pattern: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every text, encoded and decoded again."""
    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, key, text, schema, _digests, path, pattern)
