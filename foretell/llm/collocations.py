"""Phrase collocations: frequent phrases of two to five words, level by level, scored against their parts.

A phrase can only be frequent if all its parts are.  So the words are counted first, and then,
for k = 2 to 5, only the positions count at which the frequent phrases of k - 1 words start both
here and one word later.  The frequent phrases of k - 1 words are double-array tries of at most
``MOST`` phrases each, broadcast in parts.  numpy moves all positions of a block of texts through
a trie at once, one word a step; the pairs of states that accept here and one word later are the
safe candidates of k words, no others get a state.  Each task counts its candidates by their
codes, and the sums of the tasks are added by Spark.

Memory: a task holds one block of ``BLOCK`` bytes (or one text, if that is longer), one trie and
at most about ``HELD`` sums.  The driver holds one trie at a time; the number of tries grows with
the number of frequent phrases, the size of none does.

Defined results: a null text is empty, a null ``lang`` is ``und``; repeated rows count each; an
empty table and a language without a frequent phrase give no rows; a piece is never cut, whatever
its length; other columns are not looked at.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foretell.llm.common import send_package, stored

LONGEST, LEAST, TOP = 5, 100, 2000
MOST = 500_000  # phrases of one trie
BLOCK = 1 << 21  # bytes of text that move through the tries together
HELD = 1 << 18  # sums that a task holds before it hands them on
NO_LANG = "und"

# fixed values: bytes that end a piece, and the other one that ends a word
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANK, END = 32, 10
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[list(PIECE_ENDS)] = END
_FOLD[9] = BLANK


class Trie:
    """A double-array trie over words, with a root for each language.

    From state ``s`` the label ``x`` leads to ``base[s] + x`` if that slot belongs to ``s`` by
    ``owner``.  ``accepts`` holds the number of the phrase that ends in a slot, or -1.
    """

    def __init__(self, phrases: list):
        """``phrases``: ``(lang, words)`` of one length, by their number."""
        langs = sorted({lang for lang, _ in phrases})
        words = sorted({w for _, ws in phrases for w in ws})
        self.langs = {lang: i for i, lang in enumerate(langs)}
        self.words = {w: i + len(langs) for i, w in enumerate(words)}
        self.labels = len(langs) + len(words)
        rows = np.array([[self.langs[lang], *(self.words[w] for w in ws)] for lang, ws in phrases], np.int64)
        depth = rows.shape[1]
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        self.base = np.zeros(1, np.int64)
        self.owner = np.full(1, -1, np.int64)
        differs = np.cumsum(rows[1:] != rows[:-1], axis=1) > 0
        room = self._room(2 * (depth + int(differs.sum())))  # twice the number of nodes
        slots = np.zeros(len(rows), np.int64)  # of the node above, for each phrase
        changed = np.zeros(len(rows), bool)
        changed[0] = True
        for d in range(depth):
            first = changed.copy()  # where a node above starts
            changed[1:] |= rows[1:, d] != rows[:-1, d]
            starts = np.flatnonzero(changed)
            room = self._place(slots[starts], first[starts], rows[starts, d], room)
            own = self.base[slots[starts]] + rows[starts, d]
            slots = own[np.cumsum(changed) - 1]
        self.accepts = np.full(len(self.base), -1, np.int64)
        self.accepts[slots] = order

    def _room(self, slots: int) -> int:
        """Makes the arrays at least that long, and one label longer, so that no step leaves them."""
        grown = max(slots + self.labels, len(self.base))
        self.base = np.concatenate([self.base, np.zeros(grown - len(self.base), np.int64)])
        self.owner = np.concatenate([self.owner, np.full(grown - len(self.owner), -1, np.int64)])
        if self.owner[0] == -1:
            self.owner[0] = -2  # the root
        return grown

    def _place(self, parents: np.ndarray, first: np.ndarray, labels: np.ndarray, room: int) -> int:
        """Gives the children of every parent their slots: those of large families first."""
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(parents)))
        r = np.random.default_rng(len(parents))
        for i in starts[sizes > 1][np.argsort(-sizes[sizes > 1], kind="stable")]:
            end = i + sizes[np.searchsorted(starts, i)]
            own, found = labels[i:end], None
            while found is None:
                for _ in range(8):
                    bases = r.integers(0, room - self.labels, 64)
                    fits = np.flatnonzero((self.owner[bases[:, None] + own] == -1).all(axis=1))
                    if len(fits):
                        found = int(bases[fits[0]])
                        break
                else:
                    room = self._room(room + room // 4)
            self.base[parents[i]] = found
            self.owner[found + own] = parents[i]
        single = starts[sizes == 1]
        if len(single):
            free = np.flatnonzero(self.owner[self.labels : room - self.labels] == -1) + self.labels
            if len(free) < len(single):
                room = self._room(room + len(single))
                free = np.flatnonzero(self.owner[self.labels : room - self.labels] == -1) + self.labels
            free = free[: len(single)]
            self.base[parents[single]] = free - labels[single]
            self.owner[free] = parents[single]
        return room

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The next states; -1 is the state that nothing leads out of."""
        to = self.base[states] + labels
        return np.where((states >= 0) & (labels >= 0) & (self.owner[to] == states), to, -1)


class Words:
    """The words of a block of texts: their codes, pieces and languages."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        data = _FOLD[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets[:-1]] = True
        first = first[:-1]
        gap = (data == BLANK) | (data == END)
        starts = ~gap
        starts[1:] &= gap[:-1] | first[1:]
        at = np.flatnonzero(starts)
        self.piece = np.cumsum((data == END) | first, dtype=np.int64)[at]
        self.lang = langs[np.searchsorted(offsets, at, side="right") - 1]
        lengths = np.add.reduceat(~gap, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        raw = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data[~gap])])
        coded = raw.dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.dictionary = coded.dictionary

    @cached_property
    def names(self) -> list:
        return self.dictionary.to_pylist()

    def accepted(self, trie: Trie, langs: list, length: int) -> np.ndarray:
        """The number of the phrase of ``length`` words that starts at each word, or -1."""
        n = len(self.code)
        label = np.fromiter((trie.words.get(w, -1) for w in self.names), np.int64, len(self.names))[self.code]
        roots = np.array([trie.langs.get(lang, -1) for lang in langs] or [-1], np.int64)
        states = trie.step(np.zeros(n, np.int64), roots[self.lang])
        for k in range(length):
            live = max(n - k, 0)
            states[live:] = -1
            states[:live] = trie.step(states[:live], label[k:])
            if k:
                states[:live][self.piece[:live] != self.piece[k:]] = -1
        return np.where(states >= 0, trie.accepts[states], -1)


def _blocks(batches):
    """``(data, offsets, lang codes, langs)`` of about ``BLOCK`` bytes of whole texts."""
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        langs = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(codes):
            continue
        texts = batch.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, side="right")) - 1)
            own = offsets[at : end + 1]
            if own[-1] > own[0]:
                yield data[own[0] : own[-1]], own - own[0], codes[at:end], langs
            at = end


def _added(parts: list) -> pa.RecordBatch:
    """Equal words of a language once, with the sum of their counts."""
    summed = pa.Table.from_batches(parts).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
    return pa.RecordBatch.from_arrays([summed[c].combine_chunks() for c in ("lang", "phrase", "f_sum")], ["lang", "phrase", "f"])


def _counted_words(batches):
    """``(lang, phrase, f)`` of words; the sums are held as Arrow columns, without an object a word."""
    held, size = [], 0

    def out(part):
        return part.set_column(1, "phrase", part.column("phrase").cast(pa.string()))

    for data, offsets, codes, langs in _blocks(batches):
        words = Words(data, offsets, codes)
        many = len(words.dictionary)
        own = words.lang * many + words.code
        counts = np.bincount(own, minlength=len(langs) * many)
        at = np.flatnonzero(counts)
        held.append(pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(at // max(many, 1))), words.dictionary.take(pa.array(at % max(many, 1))).cast(pa.binary()),
             pa.array(counts[at], pa.int64())], ["lang", "phrase", "f"]))
        size += len(at)
        if size > HELD:
            held = [_added(held)]
            size = len(held[0])
            if size > HELD // 2:
                yield out(held[0])
                held, size = [], 0
    if held:
        yield out(_added(held))


def _summed(left: np.ndarray, right: np.ndarray, count: np.ndarray | None = None) -> tuple:
    """Equal pairs once, with the sum of their counts."""
    lefts, i = np.unique(left, return_inverse=True)
    rights, j = np.unique(right, return_inverse=True)
    codes, at, own = np.unique(i * len(rights) + j, return_index=True, return_inverse=True)
    sums = np.bincount(own, weights=count, minlength=len(codes)).astype(np.int64)  # below 2^53, as a task's words are
    return left[at], right[at], sums


def _counted_pairs(tries: list, length: int):
    """``(left, right, f)``: numbers of the accepting states here and one word later, and how often."""
    def run(batches):
        held, size = [], 0
        for data, offsets, codes, langs in _blocks(batches):
            words = Words(data, offsets, codes)
            found = np.full(len(words.code), -1, np.int64)
            for trie, start in tries:
                own = words.accepted(trie.value, langs, length)
                found = np.where(own >= 0, own + start, found)
            both = (found[:-1] >= 0) & (found[1:] >= 0) & (words.piece[:-1] == words.piece[1:])
            at = np.flatnonzero(both)
            if not len(at):
                continue
            held.append(_summed(found[at], found[at + 1]))
            size += len(held[-1][0])
            if size > HELD:
                held = [_summed(*(np.concatenate(c) for c in zip(*held)))]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["left", "right", "f"])
                    held, size = [], 0
        if held:
            merged = _summed(*(np.concatenate(c) for c in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged], ["left", "right", "f"])

    return run


def _numbered(phrases: DataFrame, most: int) -> tuple:
    """Frequent phrases with a number each, in parts of about ``most``; and the parts' starts."""
    phrases = stored(phrases, "phrases")
    n = phrases.count()
    parts = -(-n // most) if n else 0
    part = F.pmod(F.xxhash64("lang", "phrase"), F.lit(max(parts, 1)))
    within = Window.partitionBy("part").orderBy("lang", "phrase")
    numbered = phrases.withColumn("part", part).withColumn("at", F.row_number().over(within).cast("long") - 1)
    numbered = stored(numbered, "numbered-phrases")
    sizes = dict(numbered.groupBy("part").agg(F.count("*").alias("n")).collect()) if parts else {}  # a row a part
    starts, total = {}, 0
    for p in range(parts):
        starts[p] = total
        total += sizes.get(p, 0)
    return numbered, starts


def _tries(numbered: DataFrame, starts: dict) -> list:
    """Broadcast tries, each built from one part."""
    out = []
    for part, start in starts.items():
        rows = numbered.where(F.col("part") == part).orderBy("at").select("lang", "phrase").toPandas()
        if len(rows):
            phrases = [(lang, p.encode().split(b" ")) for lang, p in zip(rows["lang"], rows["phrase"])]
            out.append((numbered.sparkSession.sparkContext.broadcast(Trie(phrases)), start))
    return out


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
             most: int = MOST) -> tuple:
    """``(phrases, words)``: ``(lang, phrase, f)`` of the phrases of one to ``longest`` words that occur at
    least ``least`` times, and ``(lang, n)``, the number of all words."""
    send_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"))
    words = stored(rows.mapInArrow(_counted_words, "lang string, phrase string, f long")
                   .groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    level = words.where(F.col("f") >= least)
    found = []
    for length in range(1, longest + 1):
        numbered, starts = _numbered(level, most)
        found.append(numbered.select("lang", "phrase", "f"))
        if not starts or length == longest:
            break
        tries = _tries(numbered, starts)
        pairs = rows.mapInArrow(_counted_pairs(tries, length), "left long, right long, f long")
        counts = (pairs.groupBy("left", "right").agg(F.sum("f").alias("f")).where(F.col("f") >= least))
        counts = stored(counts, "pairs")
        for trie, _ in tries:
            trie.destroy()
        number = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])[F.col("part")] + F.col("at")
        named = numbered.select(number.alias("number"), "lang", "phrase")
        level = (
            counts.join(named.withColumnRenamed("number", "left"), "left")
            .join(named.select(F.col("number").alias("right"), F.substring_index("phrase", " ", -1).alias("last")), "right")
            .select("lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "f")
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, totals


def _parts(words: Column, least: int) -> Column:
    """All contiguous parts of at least ``least`` words, without the whole."""
    n = F.size(words)
    lengths = F.when(n > least, F.sequence(F.lit(least), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(lengths, lambda k: F.transform(
        F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice(words, i, k), " "))))


def scored(phrases: DataFrame, totals: DataFrame, top: int | None = TOP, share: int = 100) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` candidates of each language (None: all).

    A candidate goes if a longer one that holds its words has at least ``share`` percent of its count.
    """
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f"))
    own = phrases.withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1)
    inside = (own.select("lang", F.explode(F.array_distinct(_parts(F.col("words"), 2))).alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    cuts = own.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"))
    cuts = (
        cuts.join(counts.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
        .join(counts.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
        .join(totals, "lang")
    )
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    above = (wide["a"] * wide["n"]).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", "n", above.alias("above"),
                       (wide["l"] * wide["r"]).cast("decimal(38,0)").alias("below")).withColumn("score", F.expr("above div below"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c")).select("lang", "phrase", "c.*")
    kept = (lowest.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mined(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
          top: int | None = TOP, share: int = 100, most: int = MOST) -> DataFrame:
    """The collocations of every language: ``(lang, rank, phrase, a, l, r, n, score)``."""
    return scored(*frequent(docs, text, lang, longest, least, most), top, share)


def oracle(longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> str:
    """The same in SQL, by every phrase of every text."""
    grams = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS phrase, {k} AS k FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i "
        f"FROM pieces WHERE len(w) >= {k})" for k in range(1, longest + 1))
    return rf"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
counted AS (SELECT lang, phrase, k, count(*) AS f FROM ({grams}) GROUP BY 1, 2, 3),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY 1),
frequent AS (SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= {least}),
cuts AS (SELECT lang, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS c FROM frequent WHERE k > 1)),
scores AS (SELECT x.lang, x.phrase, x.a, x.c, l.f AS l, r.f AS r, t.n,
    ((1000::HUGEINT * x.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts x JOIN frequent l ON l.lang = x.lang AND l.phrase = x.lp JOIN frequent r ON r.lang = x.lang AND r.phrase = x.rp
  JOIN total t ON t.lang = x.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM frequent WHERE k > 2)) GROUP BY 1, 2),
kept AS (SELECT o.* FROM lowest o LEFT JOIN inside i ON i.lang = o.lang AND i.phrase = o.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 100 * o.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= {top}"""
