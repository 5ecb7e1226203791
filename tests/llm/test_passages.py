"""Collocations, the prefix trie, and repeated strings, against brute force."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from foretell.llm import collocations, prefix_trie, substring_dedup, suffixes

# suffix arrays


@pytest.mark.parametrize("small", [0, 12, 1000])
def test_suffix_arrays_and_common_prefixes(monkeypatch, small):
    monkeypatch.setattr(suffixes, "SMALL_BUCKETS", small)
    r = random.Random(small)
    for _ in range(200):
        n, k = r.randint(0, 60), r.choice([1, 2, 3, 10, 50])
        s = [r.randint(1, k) for _ in range(n)] + [0]
        sa = suffixes.suffix_array(np.array(s, np.int64))
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        plcp, before = suffixes.common_prefixes(np.array(s, np.int64), sa)
        for x, y in zip(sa, sa[1:]):
            shared = next(i for i in range(len(s)) if s[x + i : x + i + 1] != s[y + i : y + i + 1])
            assert plcp[y] == shared and before[y] == x
    assert suffixes.suffix_array(np.array([0])).tolist() == [0]


def test_repeated_starts_do_not_cross_bodies():
    r = random.Random(1)
    for _ in range(50):
        bodies = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 40))) for _ in range(r.randint(1, 8))]
        seen = Counter(b[i : i + 6] for b in bodies for i in range(len(b) - 5))
        want = {(k, i) for k, b in enumerate(bodies) for i in range(len(b) - 5) if seen[b[i : i + 6]] > 1}
        assert {(k, i) for k, first, last in suffixes.repeated_starts(bodies, 6) for i in range(first, last + 1)} == want


# repeated strings


def stripped(texts, length):
    data = [t.encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        yield len(b), len(b) - len(kept), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest()


def passages(seed, n=60):
    r = random.Random(seed)
    letters = "abcdefghij klmnop é"
    known = ["".join(r.choice(letters) for _ in range(r.randint(30, 120))) for _ in range(6)] + ["ab" * 60, "x" * 90]
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(known) if r.random() < 0.6 else "".join(r.choice(letters) for _ in range(r.randint(0, 80)))
            parts.append(p[r.randrange(20):] if r.random() < 0.3 else p)
        yield "".join(parts)


@pytest.mark.parametrize("settings", [{}, {"limit": 1}, {"limit": 2, "shard": 500}, {"limit": 1, "widths": (8, 1)}, {"limit": 0, "widths": (1,)}])
def test_repeated_strings_are_removed(spark, monkeypatch, settings):
    monkeypatch.setattr(substring_dedup, "STEP", 64)
    texts = list(passages(len(settings)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digests(df, length=40, gram=8, **settings).collect()}
    assert got == dict(enumerate(stripped(texts, 40)))
    assert any(g[1] for g in got.values()) and any(not g[1] for g in got.values())


def test_repeated_strings_of_odd_tables(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text", "source").withColumnRenamed("source", "key").collect()
    df = spark.createDataFrame(rows + [(None, "0123456789" * 60, "uid"), (None, "0123456789" * 60, "uid")], "doc_id long, text string, key string")
    want = stripped([r[1] or "" for r in df.collect()], 400)
    got = Counter(tuple(r) for r in substring_dedup.digests(df).collect())
    assert got == Counter((r[0], *w) for r, w in zip(df.collect(), want))
    assert substring_dedup.digests(no_docs).count() == 0


# collocations


def test_counted_words_are_no_objects():
    """A task that meets many different words holds columns of them."""
    texts = [" ".join(f"w{i}" for i in range(at, at + 2_000)) for at in range(0, 60_000, 2_000)]
    batches = [pa.RecordBatch.from_pydict({"text": [t, "W1 w1"], "lang": ["en", "fr"]}) for t in texts]
    tracemalloc.start()
    found = list(collocations._counted_words(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sums = Counter()
    for b in found:
        for lang, word, f in zip(*(c.to_pylist() for c in b.columns)):
            sums[lang, word] += f
    assert sums["fr", "w1"] == 60 and sums["en", "w7"] == 1 and len(sums) == 60_001
    assert peak < 4_000_000



def counted(rows, least, longest=5):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ",;:!?\n\x0b\x0c\r":
            text = text.replace(c, ".")
        for piece in text.split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        kept = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            cuts = [(1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items())
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(kept))]
    return out


def sentences(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "new", "york", "times", "é", "a b", "of", "x", "naïve", "one"]
    for i in range(n):
        yield "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ","]) for _ in range(r.randint(0, 40))), r.choice(["en", "de", None])


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_collocations(spark, monkeypatch, most):
    monkeypatch.setattr(collocations, "BLOCK", 500)
    monkeypatch.setattr(collocations, "HELD", 20)
    rows = [*sentences(most, 250), (None, "en"), ("", None), ("one of one of one of one of one", "en")]
    df = spark.createDataFrame([(t, lang, "x") for t, lang in rows], "text string, lang string, phrase string")
    got = collocations.mined(df, least=5, top=None, most=most).collect()
    assert sorted(tuple(r) for r in got) == sorted(counted(rows, 5))
    assert {len(r.phrase.split(" ")) for r in got} >= {2, 3}


def test_tops_exact_scores_and_empty_tables(spark, no_docs):
    assert collocations.mined(no_docs).count() == 0
    df = spark.createDataFrame([("a b c. a b. b c",) + ("en",)] * 3, "text string, lang string")
    assert [tuple(r) for r in collocations.mined(df, least=3, top=1).collect()] == counted([("a b c. a b. b c", "en")] * 3, 3)[:1]
    big = 3_000_000_000_000_000
    phrases = spark.createDataFrame([("en", "a", big), ("en", "b", big), ("en", "a b", big - 1)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 3 * big + 7)], "lang string, n long")
    assert collocations.scored(phrases, totals).first().score == 1000 * (big - 1) * (3 * big + 7) // (big * big)


# the prefix trie


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    convs = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(convs.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = sum(not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c, e in m if e))
        out.append((min(m)[0], len(p), min(members[p[:-1]])[0] if p else None, len(m), sum(len(q) == len(p) + 1 for q in below), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def talks(seed, n):
    r = random.Random(seed)
    for c in range(n):
        for turn in range(r.choice([0, 1, 2, 3, 7, 12, 40 if c % 50 == 3 else 2])):
            if r.random() < 0.95:
                yield c, turn if r.random() < 0.97 else None, r.choice(["user", "user", None]), r.choice(["hi", "hi", "ho", "é", None, "long " * 5])
    yield from ((c, 1, "user", "same") for c in range(1000, 1060))
    yield 7, 1, "user", "hi"
    yield 7, 1, "user", "hi"
    yield None, 1, "user", "nobody's"


@pytest.mark.parametrize("per_range, band", [(1_000_000, 32), (40, 3), (7, 1)])
def test_prefix_trie(spark, monkeypatch, per_range, band):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    rows = list(talks(per_range, 60))
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, depth int")
    assert Counter(tuple(r) for r in prefix_trie.trie(df, per_range).collect()) == brute_trie(rows)


def test_tries_of_nothing_and_of_one_talk(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    one = [(0, 1, "a", "bé"), (0, None, "ab", "")]
    assert Counter(tuple(r) for r in prefix_trie.trie(spark.createDataFrame(one, schema)).collect()) == brute_trie(one)
