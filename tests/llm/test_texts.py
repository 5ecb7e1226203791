import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from foretell.llm import bpe, fingerprints, mixing, neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


# fingerprints


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, above = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(above[j] + (x != y), above[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_distance_is_the_edit_distance():
    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(70))) for _ in range(2))
        assert fingerprints.distance(a, b) == plain_distance(a, b)


def slow_fingerprint(text):
    """The same definition, byte by byte."""
    data = text.encode()
    if not data:
        return "2::"
    m = (1 << 32) - 1
    hashes = []
    for i in range(len(data)):
        h = sum(int(fingerprints.BYTE[data[i - k]]) * int(fingerprints.PLACE[k]) for k in range(min(7, i + 1))) & m
        h ^= h >> 15
        h = h * 0x2C1B3C6D & m
        hashes.append(h ^ h >> 12)

    def ends(bits):
        return [i for i, h in enumerate(hashes) if h & (1 << bits) - 1 == (1 << bits) - 1]

    def signature(at):
        out, start = "", 0
        for end in [*at, len(data) - 1]:
            if start > end:
                continue
            total = 0
            for h in hashes[start : end + 1]:
                v = h * 0x85EBCA77 & m
                total += v ^ v >> 13
            total &= m
            total ^= total >> 16
            out += chr(fingerprints.ALPHABET[(total * 0x9E3779B1 & m) >> 26])
            start = end + 1
        return out

    bits = next(b for b in range(1, 32) if len(ends(b)) <= fingerprints.MOST)
    return f"{1 << bits}:{signature(ends(bits))}:{signature(ends(bits + 1))}"


def test_fingerprint_as_byte_by_byte():
    r = random.Random(2)
    for n in (1, 2, 6, 7, 30, 500, 3000):
        text = "".join(r.choice("abcdé \n") for _ in range(n))
        assert fingerprints.fingerprint(text) == slow_fingerprint(text)


def check_next(df):
    got = {}
    for r in fingerprints.with_next(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    rows = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    for i, r in enumerate(rows):
        text, following = r.text or "", rows[(i + 1) % len(rows)].text or ""
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        want = (len(text), sha(changed), fingerprints.fingerprint(text), fingerprints.fingerprint(changed))
        found = next(g for g in got[r.doc_id] if (g.n_chars, g.edited_sha256, g.fingerprint, g.edited_fingerprint) == want)
        assert found.near_edited == fingerprints.likeness(want[2], want[3])
        assert found.near_next == fingerprints.likeness(want[2], fingerprints.fingerprint(following))
    assert sum(map(len, got.values())) == len(rows)


def test_next_documents(many_docs, odd_docs, no_docs):
    check_next(many_docs[0])
    check_next(odd_docs)
    assert fingerprints.with_next(no_docs).count() == 0


@pytest.mark.parametrize("rows", [[(5, "only one")], [(None, "x"), (None, "x")], [(None, None)], [(1, "a b c"), (None, "later")]])
def test_few_documents(spark, rows):
    check_next(spark.createDataFrame(rows, "doc_id long, text string"))


def test_likeness():
    r = random.Random(3)
    text = " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(800))
    other = " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(800))
    a, b, c = map(fingerprints.fingerprint, (text, fingerprints.edited(text, other), other))
    assert fingerprints.likeness(a, a) == 1 and fingerprints.likeness(a, b) > 0.3 > fingerprints.likeness(a, c)
    assert fingerprints.fingerprints


# byte-level BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(bpe.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_as_the_library(library):
    c, r = bpe.codec(bpe.vocabulary_path(), bpe.split_pattern()), random.Random(4)
    texts = ["".join(r.choice("abc dé\n\t'sx1,.中𝄞 ") for _ in range(r.randrange(60))) for _ in range(500)]
    texts += ["a" * 3000, "ab" * 1500, "".join(r.choice("étaoin") for _ in range(700)), " " * 2000, "<|endoftext|>", ""]
    for t in texts:
        assert c.encode(t) == library.encode_ordinary(t)
        assert c.decode(c.encode(t)) == t.encode()


def test_heap_and_matrix_agree():
    c, r = bpe.codec(bpe.vocabulary_path(), bpe.split_pattern()), random.Random(5)
    for n in (2, 5, 17, 100, 500):
        raw = "".join(r.choice("theanion") for _ in range(n)).encode()
        c.known.clear()
        c._by_matrix(next(w for w in bpe.WIDTHS if w >= n), [(raw.decode(), raw)])
        assert c.known[raw.decode()] == c._by_heap(raw)


def test_a_memory_that_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 5)
    c = bpe.Codec(bpe.vocabulary_path(), bpe.split_pattern())
    texts = ["one two three", "four five six seven eight nine", "one two"]
    for t in texts:
        assert [c.decode(c.ids(parts)) for parts in c.cut([t, t])] == [t.encode()] * 2


def test_digests(odd_docs, no_docs, library):
    want = Counter()
    for r in odd_docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(r.text or "")] += 1
    assert Counter(tuple(r) for r in bpe.digests(odd_docs).collect()) == want
    assert bpe.digests(no_docs).count() == 0 and bpe.encoded(no_docs).count() == 0
    assert {r.doc_id: r.ids for r in bpe.encoded(odd_docs.where("doc_id < 6")).collect()}[3] == []


# near-duplicates


def shingle_set(text, size=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute_components(rows, share):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            if a is not None and rows[j][0] is not None and sets[i]:
                both = len(sets[i] & sets[j])
                if 100 * both >= share * (len(sets[i]) + len(sets[j]) - both) and both:
                    parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (a, _) in enumerate(rows):
        least[find(i)].append(a)
    out = Counter()
    for i, (a, _) in enumerate(rows):
        c = None if a is None else min(x for x in least[find(i)] if x is not None)
        out[a, len(sets[i]), c, a is None or a == c] += 1
    return out


@pytest.mark.parametrize("share", [85, 80, 100])
def test_links_as_by_brute_force(many_docs, share):
    df, texts = many_docs
    assert Counter(tuple(r) for r in neardup.linked(df, share=share).collect()) == brute_components(list(texts.items()), share)


def test_links_of_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert Counter(tuple(r) for r in neardup.linked(odd_docs).collect()) == brute_components(rows, 85)
    assert neardup.linked(no_docs).count() == 0 and neardup.deduplicated(no_docs).count() == 0


def test_chains_and_a_large_group_of_near_copies(spark):
    r = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):  # each differs from the one before in a few words, so that the ends are far apart
        base = list(base)
        base[(7 * i) % 120] = f"x{i}"
        rows.append((1000 - i, " ".join(base)))
    rows += [(2000 + i, " ".join(f"v{k}" for k in range(60)) + f" tail{r.randrange(20)}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(x) for x in neardup.linked(df).collect()) == brute_components(rows, 85)


def test_one_document_of_each_group_stays(many_docs, odd_docs):
    df, texts = many_docs
    kept = sorted(r.doc_id for r in neardup.deduplicated(df).collect())
    assert kept == sorted(k[0] for k in brute_components(list(texts.items()), 80) if k[3])
    assert neardup.deduplicated(odd_docs).columns == odd_docs.columns
    assert Counter(r.doc_id for r in neardup.deduplicated(odd_docs).collect()) == Counter([1, 2, 3, 4, 5, 6, 9, None])


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = " ".join(f"word{i}" for i in range(3000))
    whole = neardup.words_of([text])[0]
    monkeypatch.setattr(neardup, "BLOCK", 100)
    assert (neardup.words_of([text, "", text])[2] == whole).all() and len(whole) == 3000


def test_lanes_that_differ(spark):
    r = random.Random(7)
    rows = [tuple(r.choice([0, 1, 0x8000, 0x7FFF, 0xFFFF, r.randrange(1 << 16)]) for _ in range(64)) for _ in range(40)]
    import numpy as np

    packed = [np.array(row, np.uint64).reshape(16, 4) for row in rows]
    longs = [(p[:, 0] | p[:, 1] << np.uint64(16) | p[:, 2] << np.uint64(32) | p[:, 3] << np.uint64(48)).view(np.int64).tolist() for p in packed]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(longs)], ["c", *neardup.CHUNK_NAMES])
    got = df.alias("x").join(df.alias("y"), neardup.F.col("x.c") < neardup.F.col("y.c")).select(
        "x.c", "y.c", neardup._apart("x", "y")).collect()
    assert all(d == sum(a != b for a, b in zip(rows[i], rows[j])) for i, j, d in got)


# mixing


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        over = 0.0
        for s in sorted(open_, key=str):
            target[s] += left * weight[s] / total
            if target[s] >= 2 * sizes[s]:
                over += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
        left = over
    return target


def check_mix(df, tolerance):
    got = mixing.mixed(df).collect()
    rows = df.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter((r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in rows)
    target, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) <= 1e-6 * (1 + target[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= tolerance * t + 1e-6 for s, t in target.items() if sizes[s] > 500)
    return got


def test_mix(many_docs, odd_docs, no_docs):
    got = check_mix(many_docs[0], 0.02)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mixed(many_docs[0].repartition(3)).collect()), key=str)
    check_mix(odd_docs, 1)
    assert mixing.mixed(no_docs).count() == 0 and mixing.copied(no_docs).count() == 0


def test_the_mix_holds_what_is_taken(many_docs, odd_docs):
    for df in (many_docs[0], odd_docs.withColumn("_k", mixing.F.lit(1)).withColumn("copies", mixing.F.lit("x"))):
        copies = mixing.copied(df)
        assert copies.columns == df.columns
        want = Counter()
        for r in mixing.mixed(df).collect():
            want[r.doc_id, r.source, r["size"]] += r.copies
        got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in copies.collect())
        assert got == +want


def test_tilt_solves_the_dual(spark):
    df = spark.createDataFrame([(s, t) for s in (1.0, 10.0, 1e6) for t in (1e-6, 0.5, 1.0, 2.0)], "s double, t double")
    got = df.select((mixing.F.exp(mixing.tilt(mixing.F.lit(1.0), mixing.F.col("t"))) - mixing.F.col("t")).alias("d"), "t").collect()
    assert all(abs(r.d) <= 1e-9 * r.t for r in got)
