"""Secret scans: fixed patterns, and a linear-chain conditional random field beside them.

The patterns of ``base_spans`` always count.  The field tags every token of a text as secret
begin (B), inside (I) or outside (O), from the token's shape, its neighbouring words and
features of the whole text, and is decoded by Viterbi over the whole text; its spans are added
where no pattern matched.  The tokens of many texts are scored together.  A token whose score as
outside leads by more than any steps and the next token could make up is outside on every best path;
such tokens cut the texts into short runs, which go through Viterbi side by side.  A text of more
than ``LONG_TEXT`` characters is read in blocks of ``BLOCK`` tokens; what carries over is the words before,
the scores of the three tags and a byte a token for the way back.  Both give the same tags.

Nobody labelled secrets, so the field is trained at a distance: windows tagged by the patterns, at
most ``WINDOWS`` with a match, of all documents, and at most ``WINDOWS`` without one, of about
``SAMPLE`` documents.  A window of more than ``LONGEST`` tokens is cut into several.  So that it
learns context and shape rather than the patterns, windows with a match are repeated with
random secrets of other shapes and other credential words, and, as counter-examples, with
harmless numbers, addresses and names in place of the secret, or without the credential word.
Windows become feature ids of two bytes one by one, and the fit goes by ``BATCH`` windows at a time.

Defined results: a null or empty text has no spans (the digest of nothing, an empty list).
Texts are scanned whole.  Repeated rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, takewhile

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import mapped, send_package, stored

# fixed values: the patterns of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# credential words that the field knows besides
CREDENTIALS = NAMES + ("auth", "bearer", "credential", "private_key", "access_key", "client_secret", "pwd")
HEX_CLASS = bytes(104 if chr(b) in "0123456789abcdef" else 46 for b in range(256))

TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+|[^\sA-Za-z0-9+/_.=-]")
LONG = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
CREDENTIAL = re.compile("|".join(CREDENTIALS), re.I | re.A)
AROUND = 80  # characters of a window on either side, extended to whole tokens
SAMPLE, WINDOWS, COPIES = 20_000, 2_000, 4
LONGEST = 60  # tokens of a window that is trained on
BUCKETS = 1 << 12
TAGS = "OBI"
HARD = -1e4  # score of a forbidden step
BLOCK = 1 << 15  # tokens scored at a time
KNOWN = 1 << 16  # tokens remembered by a worker
SINCE = 5  # tokens after a credential word
LONG_TEXT = 1 << 18  # characters above which a text is read on its own, in blocks
LONG_RUN = 256  # tokens above which a run goes through Viterbi on its own
TOGETHER = 1 << 19  # characters of texts scored together
BATCH, PASSES = 1024, 10  # windows of a step of the fit, and least passes over all


def base_spans(text: str) -> list:
    """``(start, kind, end)`` of the patterns, by start and kind."""
    out = []
    low = text.lower()  # only to see whether a pattern can match
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if b"h" * 32 in text.encode("utf-8").translate(HEX_CLASS):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _secret_parts(text: str, spans: list) -> list:
    """The secrets themselves: of an assignment, its value."""
    out = []
    for start, kind, end in spans:
        m = ASSIGN.match(text, start, end) if kind == 0 else None
        out.append(m.span(2) if m else (start, end))
    return out


def windows(text: str) -> list:
    """``(start, end)`` of the stretches that the field is trained on."""
    seeds = [m.span() for m in LONG.finditer(text) if not m[0].strip("+/_.=-").isalpha()]
    low = text.lower()
    if any(n in low for n in CREDENTIALS):
        seeds += [m.span() for m in CREDENTIAL.finditer(text)]
    out: list = []
    for start, end in sorted(seeds):
        start, end = max(0, start - AROUND), min(len(text), end + AROUND)
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def file_features(text: str) -> list:
    """Features of the whole text."""
    n = len(text) + 1
    return [f"file:{name}={value}" for name, value in (
        ("size", min(n.bit_length(), 20)), ("code", any(c in text for c in "{};")), ("equals", "=" in text),
        ("quotes", '"' in text), ("lines", min((text.count("\n") * 200) // n, 10)))]


@lru_cache(1 << 15)
def _shape(t: str) -> list:
    n = len(t)
    lower, upper = sum(c.islower() for c in t), sum(c.isupper() for c in t)
    digits = sum(c.isdigit() for c in t)
    other = n - lower - upper - digits
    hexed = all(c in "0123456789abcdef" for c in t)
    kinds = (lower > 0) + (upper > 0) + (digits > 0)
    size = "1" if n == 1 else "2-7" if n < 8 else "8-11" if n < 12 else "12-15" if n < 16 else "16-23" if n < 24 else "24-"
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(t, t[1:]))
    form = "digits" if digits == n else "number" if digits + t.count(".") + t.count("-") == n else "plain" if not digits and not other and (
        not upper or t.istitle() or t.isupper()) else "hex" if hexed else "marks" if other == n else "dotted" if "." in t.strip(".") else "mixed"
    return [f"size={size}", f"form={form}", f"form+size={form}{size}", f"kinds={kinds}", f"turns={min(turns, 6)}",
            f"distinct={min(len(set(t)), 16) // 4}", f"marks={min(other, 3)}"]


def features(tokens: list, of_file: list) -> list:
    """Names of the features of every token."""
    low = [t.lower() for t in tokens]
    word = ["KEY" if any(c in w for c in CREDENTIALS) else w if len(w) == 1 else "" for w in low]
    near = [i for i, w in enumerate(word) if w == "KEY"]
    out = []
    for i, t in enumerate(tokens):
        since = min([i - k for k in near if 0 < i - k <= 5], default=0)
        f = _shape(t) + [f"word={word[i]}", f"before={word[i - 1] if i else '^'}", f"before2={word[i - 2] if i > 1 else '^'}",
                         f"after={word[i + 1] if i + 1 < len(tokens) else '$'}", f"since={since}"]
        out.append(f + [f"since+{x}" for x in f[:3] if since] + (of_file if f[1] != "form=plain" else []))
    return out


def _bucket(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "big") % BUCKETS


class Field:
    """Weights of a linear-chain field over hashed features."""

    def __init__(self, emit=None, step=None):
        self.emit = np.zeros((BUCKETS, 3)) if emit is None else emit
        self.step = np.zeros((3, 3)) if step is None else step
        self.known: dict = {}
        self.scorer = None  # made for whole texts, of the weights as they are then

    def ids(self, found: list) -> list:
        known = self.known
        if len(known) > 50_000:
            known.clear()
        return [[known.get(n) if n in known else known.setdefault(n, _bucket(n)) for n in names] for names in found]

    def scores(self, found: list) -> np.ndarray:
        return np.array([self.emit[i].sum(axis=0) for i in self.ids(found)])

    def allowed(self) -> np.ndarray:
        step = self.step.copy()
        step[0, 2] = HARD  # I does not follow O
        return step

    def decode(self, found: list) -> list:
        """The best tags; the tokens before and after the window are outside."""
        s, step = self.scores(found), self.allowed()
        best, back = s[0] + np.array([0.0, 0.0, HARD]), []
        for row in s[1:]:
            total = best[:, None] + step
            back.append(total.argmax(axis=0))
            best = total.max(axis=0) + row
        tags = [int(best.argmax())]
        for pointer in reversed(back):
            tags.append(int(pointer[tags[-1]]))
        return tags[::-1]

    def fit(self, examples, rounds: int = 100, rate: float = 0.1, decay: float = 1e-4, batch: int = BATCH) -> Field:
        """Maximises the likelihood of ``(feature names, tags)`` by Adam.

        A step takes ``batch`` windows; there are at least ``rounds`` steps and ``PASSES`` passes.
        """
        tokens, tags = [], []
        for found, own in examples:
            rows = self.ids(found)
            wide = np.full((len(rows), max(map(len, rows))), BUCKETS, np.int16)
            for i, row in enumerate(rows):
                wide[i, : len(row)] = row
            tokens.append(wide)
            tags.append(np.array(own, np.int8))
        self.known.clear()
        widest, n = max(t.shape[1] for t in tokens), len(tokens)
        sizes = np.array([len(t) for t in tags])
        ids = np.full((sizes.sum(), widest), BUCKETS, np.int16)
        at = 0
        for t in tokens:
            ids[at : at + len(t), : t.shape[1]] = t
            at += len(t)
        del tokens
        gold, starts = np.concatenate(tags).astype(np.int64), np.cumsum(sizes) - sizes
        moments = [[np.zeros((BUCKETS + 1, 3)), np.zeros((BUCKETS + 1, 3))], [np.zeros((3, 3)), np.zeros((3, 3))]]
        weights = [np.zeros((BUCKETS + 1, 3)), np.zeros((3, 3))]
        order, r = np.arange(n), np.random.default_rng(9)
        groups = -(-n // batch)
        for turn in range(1, max(rounds, PASSES * groups if groups > 1 else 0) + 1):
            if groups > 1 and turn % groups == 1:
                order = r.permutation(n)
            mine = order[(turn - 1) % groups :: groups]
            grads = self._gradients(weights, ids, gold, starts[mine], sizes[mine], decay)
            for w, g, m in zip(weights, grads, moments):
                m[0][:] = 0.9 * m[0] + 0.1 * g
                m[1][:] = 0.999 * m[1] + 0.001 * g * g
                w += rate * (m[0] / (1 - 0.9**turn)) / (np.sqrt(m[1] / (1 - 0.999**turn)) + 1e-8)
            weights[0][BUCKETS] = 0.0
        self.emit, self.step = weights[0][:BUCKETS].copy(), weights[1].copy()
        self.scorer = None
        return self

    @staticmethod
    def _gradients(weights, all_ids, all_gold, starts, sizes, decay) -> list:
        """Of the mean log likelihood of some windows, by the two passes over them side by side."""
        n, longest = len(starts), int(sizes.max())
        real = np.arange(longest) < sizes[:, None]
        rows = (starts[:, None] + np.arange(longest))[real]
        ids, widest = all_ids[rows], all_ids.shape[1]
        gold = np.zeros((n, longest), np.int64)
        gold[real] = all_gold[rows]
        line = np.arange(n)
        pair_gold = np.zeros((3, 3))
        both = real[:, 1:]
        np.add.at(pair_gold, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        emit, step = weights[0], weights[1].copy()
        step[0, 2] = HARD
        s = np.zeros((n, longest, 3))
        s[real] = sum(emit[ids[:, f]] for f in range(widest))
        s[:, 0, 2] += HARD
        ahead = np.zeros((n, longest, 3))
        ahead[:, 0] = s[:, 0]
        for t in range(1, longest):
            grown = np.logaddexp.reduce(ahead[:, t - 1, :, None] + step, axis=1) + s[:, t]
            ahead[:, t] = np.where(real[:, t, None], grown, ahead[:, t - 1])
        behind = np.zeros((n, longest, 3))
        expected = np.zeros((3, 3))
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        for t in range(longest - 2, -1, -1):
            after = behind[:, t + 1] + s[:, t + 1]
            behind[:, t] = np.where(real[:, t + 1, None], np.logaddexp.reduce(step + after[:, None, :], axis=2), behind[:, t + 1])
            joint = np.exp(ahead[:, t, :, None] + step + after[:, None, :] - total[:, None, None])
            expected += joint[real[:, t + 1]].sum(axis=0)
        own = np.exp(ahead + behind - total[:, None, None]) * real[..., None]
        miss = -own
        miss[line[:, None], np.arange(longest), gold] += real
        flat, places = miss[real], ids.ravel().astype(np.int64)
        grad = np.stack([np.bincount(places, np.repeat(flat[:, k], widest), BUCKETS + 1) for k in range(3)], axis=1)
        return [grad / n - decay * emit, (pair_gold - expected) / n - decay * weights[1]]


class Scorer:
    """Scores and tags whole texts as ``Field`` does, with what is known of each token in tables."""

    def __init__(self, field: Field):
        self.field = field
        room = 1 << 12  # grows; places 0 and 1 are the edges of a text
        self.shape = np.zeros((room, 3))  # of the shape of a token
        self.follows = np.zeros((room, 3))  # more if a credential word is near
        self.plain = np.zeros(room, bool)
        self.word = np.zeros(room, np.int64)  # of the words below
        self.forms: dict = {}
        self.words: dict = {}
        self.around = np.zeros((4, 1024, 3))  # of the words of a token, before, two before and after
        self.since = np.array([self._sum([f"since={i}"]) for i in range(SINCE + 1)])
        self.places: dict = {}
        for edge in ("", "KEY", "^", "$"):
            self._word(edge)
        self.word[:2] = self.words["^"], self.words["$"]
        self.files: dict = {}
        self.sure = self._margins()

    def _margins(self) -> tuple:
        """What a token can gain by not being outside: from the steps alone, and if the next one were inside.

        Put O in the place of B or I, and B in that of an I behind it: the path stays allowed, and
        changes by no more than this and the scores of the two tokens.
        """
        step = self.field.allowed()
        before = {None: lambda x: 0.0} | {p: (lambda x, p=p: step[p, x]) for p in range(3)}
        after = {None: lambda x: 0.0} | {m: (lambda x, m=m: step[x, m]) for m in range(3)}
        alone = max(before[p](x) + after[m](x) - before[p](0) - after[m](0) for p in before for x in (1, 2) for m in (None, 0, 1))
        ahead = max(before[p](x) + step[x, 2] + after[m](2) - before[p](0) - step[0, 1] - after[m](1)
                    for p in before for x in (1, 2) for m in after)
        return alone + 1e-6, ahead + 1e-6

    def _sum(self, names: list) -> np.ndarray:
        return self.field.emit[self.field.ids([names])[0]].sum(axis=0)

    def _word(self, word: str) -> int:
        at = self.words.get(word)
        if at is None:
            at = self.words[word] = len(self.words)
            if at == self.around.shape[1]:
                self.around = np.concatenate([self.around, np.zeros_like(self.around)], axis=1)
            for i, name in enumerate(("word", "before", "before2", "after")):
                self.around[i, at] = self._sum([f"{name}={word}"])
        return at

    def _add(self, token: str) -> int:
        at = self.places[token] = len(self.places) + 2
        if at == len(self.word):
            for name in ("shape", "follows", "plain", "word"):
                table = getattr(self, name)
                setattr(self, name, np.concatenate([table, np.zeros_like(table)]))
        self.word[at] = self._word("KEY" if CREDENTIAL.search(token) else token.lower() if len(token) == 1 else "")
        # words of small letters alone differ in their shape by length and number of letters only
        f = (len(token), len(set(token))) if token.isalpha() and token.isascii() and token.islower() else tuple(_shape(token))
        if f not in self.forms:
            if len(self.forms) > KNOWN:
                self.forms.clear()
            names = _shape(token)
            self.forms[f] = self._sum(names), self._sum([f"since+{x}" for x in names[:3]]), names[1] == "form=plain"
        self.shape[at], self.follows[at], self.plain[at] = self.forms[f]
        return at

    def blocks(self, text: str):
        """The scores of the tokens of a text, block by block."""
        tokens = (m[0] for m in TOKEN.finditer(text))
        of_file = None
        edge, last = self.words["^"], self.words["$"]
        before, since = np.array([edge, edge]), SINCE + 1  # the words before the block, and the distance of its start from a credential word
        now = list(islice(tokens, BLOCK))
        while now:
            if len(self.places) > KNOWN:
                self.places.clear()
            coming = list(islice(tokens, BLOCK))
            known, add = self.places, self._add
            ids = np.array([known[t] if t in known else add(t) for t in (now + coming[:1])])
            word = np.concatenate([before, self.word[ids], [] if coming else [last]]).astype(np.int64)
            ids = ids[: len(now)]
            n = len(now)
            own = word[2 : n + 2]
            s = self.shape[ids]
            for table, part in zip(self.around, (own, word[1 : n + 1], word[:n], word[3:])):
                s += table[part]
            at = np.arange(n)
            key = np.maximum.accumulate(np.where(own == self.words["KEY"], at, -since))
            far = at - np.concatenate([[-since], key[:-1]])
            near = (far <= SINCE) & (far > 0)
            s += self.since[np.where(near, far, 0)]
            s[near] += self.follows[ids[near]]
            if not self.plain[ids].all():
                of_file = self._sum(file_features(text)) if of_file is None else of_file
                s[~self.plain[ids]] += of_file
            before, since = word[n : n + 2], min(n - int(key[-1]), SINCE + 1)
            now = coming
            yield s

    def tags(self, text: str) -> list | None:
        """The best tags of all tokens of one text; None if all are outside."""
        return self._path(row for s in self.blocks(text) for row in s.tolist())

    def _path(self, rows, first: bool = True, last: bool = True) -> list | None:
        """The best tags of tokens with these scores; tokens beyond a side that is no edge are outside."""
        step = self.field.allowed().tolist()
        (oo, ob, oi), (bo, bb, bi), (io, ib, ii) = step
        rows = iter(rows)
        start = next(rows, None)
        if start is None:
            return None
        o, b, i = start
        if first:
            i += HARD
        else:
            o, b, i = o + oo, b + ob, i + oi
        back = bytearray()  # of each token but the first: from which tag O, B and I come, two bits each
        for so, sb, si in rows:
            to, way = o + oo, 0
            if b + bo > to:
                to, way = b + bo, 1
            if i + io > to:
                to, way = i + io, 2
            tb, x = o + ob, 0
            if b + bb > tb:
                tb, x = b + bb, 4
            if i + ib > tb:
                tb, x = i + ib, 8
            ti, y = o + oi, 0
            if b + bi > ti:
                ti, y = b + bi, 16
            if i + ii > ti:
                ti, y = i + ii, 32
            o, b, i = to + so, tb + sb, ti + si
            back.append(way | x | y)
        if not last:
            o, b, i = o + oo, b + bo, i + io
        tag = 0 if o >= b and o >= i else 1 if b >= i else 2
        if not tag and not any(back.translate(None, OUTSIDE)):
            return None
        tags = [tag]
        for way in reversed(back):
            tag = way >> 2 * tag & 3
            tags.append(tag)
        return tags[::-1] if any(tags) else None

    def _flat(self, tokens_of: list) -> tuple:
        """Scores of the tokens of several texts in a row, two edges before each and one behind: ``(scores, ids, text)``."""
        known, add = self.places, self._add
        if len(known) > KNOWN:
            known.clear()
        ids: list = []
        for tokens in tokens_of:
            ids += (0, 0)
            ids += [known[t] if t in known else add(t) for t in tokens]
            ids.append(1)
        ids = np.array(ids, np.int64)
        n = len(ids)
        of = np.repeat(np.arange(len(tokens_of)), [len(t) + 3 for t in tokens_of])
        begin = np.concatenate([[0], np.cumsum([len(t) + 3 for t in tokens_of])])[of] + 2
        word = self.word[ids]
        s = self.shape[ids]
        for table, shift in zip(self.around, (0, 1, 2, -1)):
            s += table[np.roll(word, shift)]
        at = np.arange(n)
        key = np.maximum.accumulate(np.where((word == self.words["KEY"]) & (ids > 1), at, -1))
        before = np.concatenate([[-1], key[:-1]])
        far = np.where(before >= begin, at - before, SINCE + 1)
        near = far <= SINCE
        s += self.since[np.where(near, far, 0)]
        s[near] += self.follows[ids[near]]
        return s, ids, of

    def tags_of(self, texts: list) -> list:
        """The best tags of every text, as ``tags`` gives them."""
        tokens_of = [TOKEN.findall(t) for t in texts]
        s, ids, of = self._flat(tokens_of)
        odd = (ids > 1) & ~self.plain[ids]
        sums = np.zeros((len(texts), 3))
        for i in np.unique(of[odd]):
            found = tuple(file_features(texts[i]))
            if found not in self.files:
                self.files[found] = self._sum(list(found))
            sums[i] = self.files[found]
        s[odd] += sums[of[odd]]
        alone, ahead = self.sure
        lead = s[:, 0] - np.maximum(s[:, 1], s[:, 2])
        coming = np.where(np.roll(ids, -1) == 1, -np.inf, np.roll(s[:, 2] - s[:, 1], -1))
        open_ = (ids > 1) & ~((lead > alone) & (lead > coming + ahead))
        edge = np.diff(np.concatenate([[0], open_.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        tags = np.zeros(len(ids), np.int8)
        wide = ends - starts > LONG_RUN
        for a, b in zip(starts[wide], ends[wide]):
            tags[a:b] = self._path(s[a:b].tolist(), ids[a - 1] == 0, ids[b] == 1) or 0
        self._side_by_side(s, ids, starts[~wide], ends[~wide], tags)
        out, at = [], 0
        for tokens in tokens_of:
            own = tags[at + 2 : at + 2 + len(tokens)]
            out.append(own.tolist() if own.any() else None)
            at += len(tokens) + 3
        return out

    def _side_by_side(self, s, ids, starts, ends, tags) -> None:
        """Viterbi over many runs, longest first, a column of all runs that reach it at a time."""
        if not len(starts):
            return
        order = np.argsort(starts - ends, kind="stable")
        starts, ends = starts[order], ends[order]
        step, sizes = self.field.allowed(), ends - starts
        first, last = ids[starts - 1] == 0, ids[ends] == 1
        best = s[starts] + np.where(first[:, None], [0.0, 0.0, HARD], step[0])
        reach = [int(np.searchsorted(-sizes, -k, side="left")) for k in range(int(sizes[0]))]  # runs longer than k
        back = [None]
        for k in range(1, int(sizes[0])):
            m = reach[k]
            total = best[:m, :, None] + step
            back.append(total.argmax(axis=1).astype(np.int8))
            best[:m] = total.max(axis=1) + s[starts[:m] + k]
        tag = (best + np.where(last[:, None], 0.0, step[:, 0])).argmax(axis=1)
        for k in range(int(sizes[0]) - 1, -1, -1):
            m = reach[k]
            tags[starts[:m] + k] = tag[:m]
            if k:
                tag[:m] = back[k][np.arange(m), tag[:m]]


OUTSIDE = bytes(w for w in range(64) if not w & 3)  # ways in which O comes from O


def tagged(text: str, start: int, end: int, secrets: list) -> tuple:
    """Tokens of a window with their places and tags."""
    tokens, places, tags = [], [], []
    secrets, at = sorted(secrets), 0
    for m in TOKEN.finditer(text, start, end):
        tokens.append(m[0])
        places.append(m.span())
        while at < len(secrets) and secrets[at][1] <= m.start():
            at += 1
        near = takewhile(lambda s: s[0] < m.end(), (secrets[i] for i in range(at, len(secrets))))
        hit = next((s for s in near if m.start() < s[1]), None)
        began = hit is not None and len(tags) > 0 and tags[-1] > 0 and places[-2][1] > hit[0]
        tags.append(0 if hit is None else 2 if began else 1)
    return tokens, places, tags


def _random_secret(r: random.Random) -> str:
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabet, least, most = r.choice([
        ("0123456789abcdef", 32, 64), (low + low.upper() + digits, 16, 48), (low + low.upper() + digits + "+/", 24, 64),
        (low.upper() + digits, 16, 32), (low + digits + "_", 20, 40), (low + digits + "-", 12, 40)])
    body = "".join(r.choice(alphabet) for _ in range(r.randint(least, most)))
    return r.choice(["", "", "AKIA", "key-", "ghp_", "sk_live_"]) + body + r.choice(["", "", "=", "=="])


def _harmless(r: random.Random) -> str:
    digits = "".join(r.choice("0123456789") for _ in range(16))
    return r.choice([
        digits, digits[:14], ".".join(str(r.randint(0, 255)) for _ in range(4)), f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}",
        f"mail{r.randint(0, 99)}.example.com", f"v{r.randint(0, 9)}.{r.randint(0, 99)}.{r.randint(0, 99)}-beta",
        f"report_{digits[:4]}.pdf", "internationally", "re-establishing", f"item/{digits[:6]}/index.html"])


def examples(sampled: list, seed: int = 9):
    """Training windows ``(feature names, tags)`` from ``(tokens, tags, file features)``, one by one."""
    r = random.Random(seed)
    for tokens, tags, of_file in sampled:
        yield features(tokens, of_file), tags
        at = [i for i, t in enumerate(tags) if t == 1]
        if not at:
            continue
        keys = [i for i, t in enumerate(tokens) if any(c in t.lower() for c in CREDENTIALS) and tags[i] == 0]
        for copy in range(COPIES):
            changed, labels = list(tokens), list(tags)
            secret = copy % 2 == 0
            for i in at:
                changed[i] = _random_secret(r) if secret else _harmless(r)
                if not secret:
                    labels[i] = 0
            labels = [0 if t == 2 and not labels[i - 1] else t for i, t in enumerate(labels)]
            for i in keys:
                changed[i] = r.choice(CREDENTIALS) if secret or r.random() < 0.5 else r.choice(["page", "ref", "total", "id", "see"])
            yield features(changed, of_file), labels


def _cut(tokens: list, tags: list):
    """A window in parts of at most ``LONGEST`` tokens, which split a secret only if it is longer than that."""
    at = 0
    while at < len(tokens):
        end = min(at + LONGEST, len(tokens))
        if end < len(tokens):
            end = next((i for i in range(end, at, -1) if tags[i] != 2), end)
        part = tags[at:end]
        yield tokens[at:end], [1] + part[1:] if part[0] == 2 else part
        at = end


def _windows_of(most: int):
    """``(window, hit, place)``: the windows with a match, and those without one where ``sampled``.

    A task returns the first ``most`` of each by the hash ``place``, among which are all that can be
    the first of all tasks.
    """
    def run(batches):
        first: dict = {False: {}, True: {}}
        for pdf in batches:
            for text, sampled in zip(pdf["text"], pdf["sampled"]):
                for window, hit in _examples_of(text, sampled):
                    place = int.from_bytes(hashlib.blake2b(window.encode(), digest_size=8).digest(), "big", signed=True)
                    first[hit][place, window] = first[hit].get((place, window), 0) + 1
            for hit, kept in first.items():
                if len(kept) > most:
                    first[hit] = {k: kept[k] for k in heapq.nsmallest(most, kept)}
        rows = [(w, hit, place) for hit, kept in first.items() for (place, w), n in kept.items() for _ in range(min(n, most))]
        yield pd.DataFrame(rows, columns=["window", "hit", "place"]).astype({"hit": bool, "place": "int64"})

    return run


def _examples_of(text: str, sampled: bool):
    """``(window, hit)`` of a text."""
    base = base_spans(text)
    if not base and not sampled:
        return
    secrets, of_file = sorted(_secret_parts(text, base)), file_features(text)
    at = 0
    for start, end in windows(text):
        while at < len(secrets) and secrets[at][1] <= start:
            at += 1
        own = list(takewhile(lambda s: s[0] < end, (secrets[i] for i in range(at, len(secrets)))))
        if not own and not sampled:
            continue
        tokens, _, tags = tagged(text, start, end, own)
        for some, few in _cut(tokens, tags):
            if sampled or any(few):
                yield json.dumps([some, few, of_file]), any(few)


def trained(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, most: int = WINDOWS) -> Field:
    """A field trained on at most ``most`` windows with a match, and as many without one.

    Those with a match are taken from all documents, the others from about ``sample`` of them,
    by a hash of the window, so reruns agree.
    """
    n = docs.count()
    share = int(1_000_000 * min(1.0, sample / max(n, 1)))
    sampled = F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), sampled.alias("sampled"))
    found = stored(mapped(rows, _windows_of(most), "window string, hit boolean, place long"), "secret-windows")
    chosen = [w for hit in (F.col("hit"), ~F.col("hit"))
              for w in found.where(hit).orderBy("place", "window").limit(most).collect()]
    if not chosen:
        return Field()
    return Field().fit(examples([json.loads(w["window"]) for w in chosen]))


def _spans_of_tags(text: str, tags: list | None) -> list:
    out: list = []
    if tags is None:
        return out
    for m, tag in zip(TOKEN.finditer(text), tags):
        if tag == 2 and out:
            out[-1] = (out[-1][0], 3, m.end())
        elif tag:
            out.append((m.start(), 3, m.end()))
    return out


def _apart(found: list, base: list) -> list:
    """The spans that overlap none of ``base``; both are sorted by start."""
    out, at, end = [], 0, 0  # the greatest end of the base spans that start before the span ends
    for s in found:
        while at < len(base) and base[at][0] < s[2]:
            end = max(end, base[at][2])
            at += 1
        if end <= s[0]:
            out.append(s)
    return out


def spans(field: Field, text: str) -> tuple:
    """Base spans, and all spans with those of the field that overlap no base span."""
    return next(spans_of(field, [text]))


def spans_of(field: Field, texts) -> Iterator[tuple]:
    """``spans`` of every text, many texts at a time."""
    field.scorer = field.scorer or Scorer(field)
    texts = list(texts)
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and len(texts[end]) <= LONG_TEXT and size < TOGETHER:
            size += len(texts[end])
            end += 1
        some = texts[at:end] or texts[at : at + 1]
        found = field.scorer.tags_of(some) if end > at else [field.scorer.tags(some[0])]
        for text, tags in zip(some, found):
            base = base_spans(text)
            yield base, sorted(base + _apart(_spans_of_tags(text, tags), base))
        at += len(some)


def _listed(found: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every text."""
    field = field or trained(docs, key, text)
    emit, step = field.emit.astype(np.float32), field.step

    def run(batches):
        f = Field(emit, step)
        for pdf in batches:
            rows = []
            for base, found in spans_of(f, pdf["text"]):
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(found)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", pdf["id"])
            yield out

    rows = docs.select(F.col(key).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = "doc_id string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return mapped(rows, run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


MARK = "[SECRET]"


def redacted(docs: DataFrame, text: str = "text", key: str = "doc_id", field: Field | None = None) -> DataFrame:
    """The documents with every span replaced by ``MARK``; a null text stays null, all columns stay."""
    field = field or trained(docs, key, text)
    emit, step = field.emit.astype(np.float32), field.step
    send_package(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = Field(emit, step)
        for texts in batches:
            known = texts.fillna("")
            out = pd.Series([_without(t, found) for t, (_, found) in zip(known, spans_of(f, known))], texts.index, object)
            yield out.where(texts.notna(), None)

    return docs.withColumn(text, clean(F.col(text)))


def _without(text: str, found: list) -> str:
    out, at = [], 0
    for a, _, b in found:
        if a >= at:
            out += [text[at:a], MARK]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text
