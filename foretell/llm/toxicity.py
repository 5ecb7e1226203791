"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Word stems (words and their first 4 to 8 letters) that toxic documents hold far more often
   are mined from labelled documents; each is a lexicon voter.  Pattern voters judge how many
   such stems a text has, how many different ones, how dense they are, and its form (capitals,
   exclamation marks, symbols).  Voters say toxic, clean, or nothing.
2. The label model knows for each voter how often it gives each answer to toxic and to clean
   texts, and how voters correlate within a class; a voter that repeats others counts for less.
   Expectation maximisation fits it, with the given labels as one more, strong voter, and
   gives every sampled document a probability of being toxic.
3. A logistic classifier over counts, densities and forms is trained on these probabilities
   and scores every whole text where it lies.

Labels are taken only from documents outside the held-out fold (crc32 of the id as text, mod 4,
is 2), at most ``LABELLED`` of them, chosen by a hash.  Near copies among them with the same
label (where two MinHash values agree both) count once, by the one with the smallest id, as a
copied text would make all its words look toxic.  Labels, language,
source and id are no inputs of a score.

Defined results: a null or empty text is scored like a text without words; a null id is not
held out; ids labelled twice count as toxic if any label says so; without labels every score
is 0.  Repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import mapped, send_package, stored
from foretell.llm.neardup import shingles, words_of

FOLDS, HELD_OUT = 4, 2
LABELLED = 10_000  # documents that labels are learnt from, at most
CHUNK = 512  # texts scored, and rows of a fit worked on, at a time
STEMS = 300  # mined stems, at most
LEAST = 4  # toxic documents that a stem must occur in
LIFT = 4.0  # times as often in toxic documents as in others
THRESHOLD = 0.3
PREFIXES = range(4, 9)
WORDS = re.compile(r"\w+")
KNOWN = 300_000  # words remembered by a worker
UPPER = bytes(range(65, 91))
SYMBOLS = b"!#$%&*?@^~|"
TRUST = 0.98  # probability that a given label is right


def held_out(key: Column) -> Column:
    crc = F.crc32(key.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def stems_of(word: str) -> list:
    return [f"={word}"] + [word[:k] for k in PREFIXES if len(word) > k]


def _mine(batches):
    """Of each batch: in how many toxic and clean documents a stem occurs, and how often."""
    for pdf in batches:
        docs, hits = (Counter(), Counter()), (Counter(), Counter())
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            own: Counter = Counter()
            for word, n in Counter(WORDS.findall(text.lower())).items():
                for stem in stems_of(word):
                    own[stem] += n
            docs[toxic].update(own.keys())
            hits[toxic].update(own)
        names = list(docs[0].keys() | docs[1].keys())
        yield pd.DataFrame({"stem": names, "d0": [docs[0][s] for s in names], "d1": [docs[1][s] for s in names],
                            "h0": [hits[0][s] for s in names], "h1": [hits[1][s] for s in names]})


def _sketch(batches):
    for pdf in batches:
        found = [shingles(w) for w in words_of(pdf["text"].tolist())]
        pdf["least"] = [int(s[0].view(np.int64)) if len(s) else -1 for s in found]
        pdf["most"] = [int(s[-1].view(np.int64)) if len(s) else -1 for s in found]
        yield pdf


class Features:
    """Counts of a text: for every stem, and the forms behind the pattern voters."""

    FORMS = ("hits", "kinds", "density", "capitals", "shouts", "symbols", "words")

    def __init__(self, stems: list):
        self.place = {s: i for i, s in enumerate(stems)}
        self.known: dict = {}
        self.plain: set = set()

    def _stems(self, word: str) -> tuple:
        return tuple(self.place[s] for s in stems_of(word) if s in self.place)

    def row(self, text: str) -> np.ndarray:
        words = WORDS.findall(text.lower())
        counts, stems = Counter(words), np.zeros(len(self.place))
        hits = 0
        for word in counts.keys() - self.plain:
            at = self.known.get(word)
            if at is None:
                at = self._stems(word)
                if not at:
                    if len(self.plain) >= KNOWN:
                        self.plain.clear()
                    self.plain.add(word)
                    continue
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[word] = at
            n = counts[word]
            hits += n  # a word counts once, however many of its stems are listed
            for i in at:
                stems[i] += n
        raw = text.encode("utf-8")
        n, size = len(words) + 1, len(raw) + 1
        forms = [hits, sum(word in self.known for word in counts), hits / n, (size - 1 - len(raw.translate(None, UPPER))) / size,
                 raw.count(b"!!") / n, (size - 1 - len(raw.translate(None, SYMBOLS))) / size, len(words)]
        return np.concatenate([forms, stems])


def inputs(x: np.ndarray) -> np.ndarray:
    """What the linear classifier sees of rows of ``Features``."""
    hits, kinds, density, capitals, shouts, symbols, words = (x[:, i] for i in range(len(Features.FORMS)))
    cols = [np.ones(len(x)), np.log1p(hits), np.log1p(kinds), np.minimum(density, 0.1) * 20, np.sqrt(density), capitals,
            np.minimum(shouts, 1), symbols * 5, np.log1p(words) / 5, np.minimum(hits, 1), np.minimum(hits, 2) / 2, np.minimum(hits, 4) / 4]
    return np.concatenate([np.stack(cols, axis=1), np.log1p(x[:, len(Features.FORMS):])], axis=1)


def votes(x: np.ndarray) -> np.ndarray:
    """1 toxic, -1 clean, 0 nothing; a column per voter."""
    hits, kinds, density, capitals, shouts, symbols, _ = (x[:, i] for i in range(len(Features.FORMS)))

    def when(yes, no=None):
        return np.where(yes, 1, np.where(no, -1, 0) if no is not None else 0)

    patterns = [when(hits >= 2, hits == 0), when(hits >= 3, hits <= 1), when(hits >= 5), when(kinds >= 2, kinds == 0),
                when(kinds >= 3), when(density >= 0.005, density < 0.001), when(density >= 0.01), when(density >= 0.02),
                when(capitals >= 0.3), when(shouts >= 0.2), when(symbols >= 0.1)]
    return np.concatenate([np.stack(patterns, axis=1), (x[:, len(Features.FORMS):] > 0).astype(int)], axis=1)


def _slices(n: int) -> list:
    """Rows that are worked on at a time, so that what is made of them stays small."""
    return [slice(at, at + CHUNK) for at in range(0, n, CHUNK)]


def _moments(v: np.ndarray, q: np.ndarray) -> tuple:
    """Of a class, to which the rows belong by ``q``: how often each answer is given, and the covariance of the voters."""
    voters, total = v.shape[1], max(q.sum(), 1e-9)
    given, cov = np.zeros((voters, 3)), np.zeros((voters, voters))
    for own in _slices(len(v)):
        for a in range(3):
            given[:, a] += q[own] @ (v[own] == a - 1)
    mean = (given[:, 2] - given[:, 0]) / total
    for own in _slices(len(v)):
        dev = v[own] - mean
        cov += (dev * q[own][:, None]).T @ dev
    return given, cov / total


def label_model(v: np.ndarray, y: np.ndarray, rounds: int = 15) -> np.ndarray:
    """The probability of each row being toxic, from its votes and its given label."""
    given = np.where(y > 0, np.log(TRUST / (1 - TRUST)), np.log((1 - TRUST) / TRUST))
    p = np.where(y > 0, TRUST, 1 - TRUST)
    for _ in range(rounds):
        prior = (p.sum() + 1) / (len(p) + 2)
        table, discount = [], 0.0
        for q, share in ((p, prior), (1 - p, 1 - prior)):
            answers, cov = _moments(v, q)
            table.append(np.log((answers + 0.5) / (q.sum() + 1.5)))
            # correlations of the voters within the class
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = np.abs(cov / sd[:, None] / sd[None, :])
            np.fill_diagonal(corr, 0)
            discount = discount + share * corr.sum(axis=1)
        weights = (table[0] - table[1]) / (1 + discount)[:, None]
        odds = np.concatenate([sum((v[own] == a - 1) @ weights[:, a] for a in range(3)) for own in _slices(len(v))])
        p = 1 / (1 + np.exp(-np.clip(odds + given + np.log(prior / (1 - prior)), -30, 30)))
    return p


def logistic(x: np.ndarray, p: np.ndarray, ridge: float = 0.3, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic classifier on soft labels, by Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = np.diag(keep)
        for own in _slices(len(x)):
            curve += (x[own] * (q[own] * (1 - q[own]) + 1e-9)[:, None]).T @ x[own]
        step = np.linalg.solve(curve, x.T @ (p - q) - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights from rows of ``Features`` and their labels; besides ``x`` only votes and inputs are held whole."""
    v = np.concatenate([votes(x[own].astype(float)).astype(np.int8) for own in _slices(len(x))])
    p = label_model(v, y)
    del v
    seen = np.empty((len(x), inputs(x[:1].astype(float)).shape[1]))
    for own in _slices(len(x)):
        seen[own] = inputs(x[own].astype(float))
    return logistic(seen, p)


class Model:
    def __init__(self, stems: list, weights):
        self.stems, self.weights = stems, weights

    def scores(self, texts, features: Features) -> np.ndarray:
        if self.weights is None or not len(texts):
            return np.zeros(len(texts))
        texts, out = list(texts), []
        for at in range(0, len(texts), CHUNK):  # a row is as wide as the lexicon
            x = inputs(np.stack([features.row(t) for t in texts[at : at + CHUNK]]))
            out.append(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))
        return np.concatenate(out)


def _stems(counts: DataFrame, toxic: int, clean: int) -> list:
    """The most telling stems, of nested ones with equal counts the longest."""
    lift = (F.col("d1") / F.lit(max(toxic, 1))) / ((F.col("d0") + 0.5) / F.lit(clean + 1))
    often = (F.col("h1") + 0.5) / (F.col("h0") + 0.5) * F.lit((clean + 1) / (toxic + 1))
    gain = F.col("d1") * F.log(lift) + F.col("h1") * F.log(often) / 4
    rows = counts.where((F.col("d1") >= LEAST) & (lift >= LIFT) & (often >= LIFT)).select("stem", "d0", "d1", "h0", "h1", gain.alias("gain"))
    rows = rows.orderBy(F.desc("gain"), "stem").limit(4 * STEMS).collect()
    by_counts: dict = {}
    for r in rows:
        key = (r["d0"], r["d1"], r["h0"], r["h1"], r["stem"].lstrip("=")[:4])
        if key not in by_counts or len(r["stem"]) > len(by_counts[key]["stem"]):
            by_counts[key] = r
    return [r["stem"] for r in sorted(by_counts.values(), key=lambda r: (-r["gain"], r["stem"]))[:STEMS]]


def _once(sketched: DataFrame) -> DataFrame:
    """The first row by id of those with the same label that agree in both values."""
    return sketched.groupBy("least", "most", "toxic").agg(F.min_by("text", F.struct("_id", "text")).alias("text"))


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = LABELLED) -> Model:
    given = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    given = given.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # at most ``most`` small rows, so this side may be broadcast
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.col("doc_id").alias("_id"), "toxic")
    named = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = named.join(F.broadcast(chosen), F.col("_key") == F.col("_id")).select("_id", "text", "toxic")
    sketched = mapped(rows, _sketch, "_id long, text string, toxic int, least long, most long")
    sample = stored(_once(sketched).select("text", "toxic"), "tox-sample")
    # ids may repeat, so the texts are cut to the bound again, by a hash; only hashes are sorted
    last = sample.select(F.xxhash64("text").alias("h")).orderBy("h").limit(most).agg(F.max("h")).first()[0]
    sample = sample.where(F.xxhash64("text") <= F.lit(last))
    sizes = sample.agg(F.sum("toxic"), F.count("*")).first()
    toxic, n = int(sizes[0] or 0), int(sizes[1])
    if not toxic or toxic == n:
        return Model([], None)
    counts = mapped(sample, _mine, "stem string, d0 long, d1 long, h0 long, h1 long").groupBy("stem").agg(
        *[F.sum(c).alias(c) for c in ("d0", "d1", "h0", "h1")])
    stems = _stems(counts, toxic, n - toxic)

    def measured(batches):
        f = Features(stems)
        for pdf in batches:
            yield pd.DataFrame({"x": [f.row(t).astype(np.float32).tobytes() for t in pdf["text"]], "toxic": pdf["toxic"]})

    found = mapped(sample, measured, "x binary, toxic int").orderBy("x", "toxic").collect()
    x = np.empty((len(found), len(Features.FORMS) + len(stems)), np.float32)
    y = np.zeros(len(found), int)
    for i, r in enumerate(found):
        x[i], y[i] = np.frombuffer(r["x"], np.float32), r["toxic"]
    del found
    return Model(stems, fitted(x, y))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every text."""

    def run(batches):
        f = Features(model.stems)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["id"], "score": model.scores(pdf["text"], f)})

    rows = docs.select(F.col(key).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = mapped(rows, run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold; all columns stay."""
    send_package(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = Features(model.stems)
        for texts in batches:
            yield pd.Series(model.scores(texts.fillna(""), f))

    return docs.where(score(F.col(text)) < threshold)
