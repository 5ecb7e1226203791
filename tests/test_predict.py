"""The predictive operators against plain Python that scores everything."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.operators import evaluate as ev
from foretell.operators.batch import predict_batch
from foretell.operators.counts import log_sum_exp
from foretell.operators.predict import predict
from foretell.operators.rank import match, recommend
from foretell.operators.relate import relate
from foretell.operators.similarity import build_index, similarity, similarity_scores
from foretell.plans.engine import Engine

TOKENS = ["red", "blue", "big", "old", "new", "hot"]


def make(n=240, kinds=9, seed=3):
    """Rows with nulls, a hot value (a third of the rows) and classes of very different size."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a = "hot" if i % 3 == 0 else rnd.choice(["x", "y", "z", None])
        text = None if rnd.random() < 0.1 else " ".join(rnd.choice(TOKENS) for _ in range(rnd.randint(0, 4)))
        kind = None if i % 40 == 7 else f"c{int(kinds * rnd.random() ** 3)}"
        rows.append((i, a, rnd.choice([1, 2, None]), text, kind))
    return rows


COLUMNS = "id int, a string, n int, text string, kind string"


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def table(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    return S.attach(df, {"text": {"type": "Text", "analyzer": "whitespace"}}).cache()


def feats(row, fields):
    values = dict(zip(["id", "a", "n", "text", "kind"], row))
    out = set()
    for f in fields:
        if values[f] is not None:
            out |= {f"{f}:{t}" for t in values[f].split()} if f == "text" else {f"{f}={values[f]}"}
    return out


def brute(train, evidence, fields, k):
    """Best classes of one query: every class, every feature."""
    train = [(r[4], feats(r, fields)) for r in train if r[4] is not None]
    size = Counter(c for c, _ in train)
    h, scores = len(evidence), {}
    for c, n_c in size.items():
        s = math.log((n_c + 1) / (len(train) + len(size)))
        for f in evidence:
            s += math.log((sum(1 for d, fs in train if d == c and f in fs) + 1) / (n_c + 2))
        scores[c] = s
    top = max(scores.values())
    z = sum(math.exp(s - top) for s in scores.values())
    order = sorted(scores, key=lambda c: (-round(scores[c], 9), size[c] if h >= 2 else -size[c], c))
    return [(c, math.exp(scores[c] - top) / z) for c in order[:k]]


def brute_text(train, evidence, fields, k):
    train = [(set(r[3].split()), feats(r, fields)) for r in train if r[3] is not None]
    n, out = len(train), []
    size = Counter(t for ts, _ in train for t in ts)
    h = len(evidence)
    for c, n_c in size.items():
        s = math.log((n_c + 1) / (n - n_c + 1))
        for f in evidence:
            both = sum(1 for ts, fs in train if c in ts and f in fs)
            n_f = sum(1 for _, fs in train if f in fs)
            s += math.log((both + 1) / (n_c + 2)) - math.log((n_f - both + 1) / (n - n_c + 2))
        out.append((-round(s, 9), n_c if h >= 2 else -n_c, c, 1 / (1 + math.exp(-s))))
    return [(c, p) for _, _, c, p in sorted(out)[:k]]


def ranked(df):
    found = sorted(df.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in found] == list(range(1, len(found) + 1))
    return [(r["feature"], r["p"]) for r in found]


def same(got, want):
    assert [c for c, _ in got] == [c for c, _ in want]
    assert [p for _, p in got] == pytest.approx([p for _, p in want], abs=1e-12)


@pytest.mark.parametrize("where", [None, {"a": "hot"}, {"a": "hot", "text": "red old red never"}, {"a": "nope", "n": 2},
                                   {"a": None, "n": 1}])
def test_predict(table, rows, where):
    fields = list(where or {})
    values = {"id": 0, "a": None, "n": None, "text": None, "kind": None, **(where or {})}
    evidence = feats(tuple(values.values()), fields)
    got = ranked(predict(table, where, "kind", 100))
    same(got, brute(rows, evidence, fields, 100))
    assert sum(p for _, p in got) == pytest.approx(1)
    same(ranked(predict(table, where, "kind", 3)), got[:3])


@pytest.mark.parametrize("where", [None, {"a": "hot"}, {"a": "hot", "n": 2}])
def test_predict_text(table, rows, where):
    evidence = {f"{k}={v}" for k, v in (where or {}).items()}
    same(ranked(predict(table, where, "text", 10)), brute_text(rows, evidence, list(where or {}), 10))


def test_explanation(table, rows):
    found = predict(table, {"a": "hot", "text": "red"}, "kind", 2, explain=True).orderBy("rank").first()
    train = [(r[4], feats(r, ["a", "text"])) for r in rows if r[4] is not None]
    own = [fs for c, fs in train if c == found["feature"]]
    assert [w["feature"] for w in found["why"]] == ["prior", "a=hot", "text:red"]
    assert found["why"][0]["lift"] == pytest.approx((len(own) + 1) / (len(train) + len({c for c, _ in train})))
    for w in found["why"][1:]:
        on = (sum(w["feature"] in fs for fs in own) + 1) / (len(own) + 2)
        overall = (sum(w["feature"] in fs for _, fs in train) + 1) / (len(train) + 2)
        assert w["lift"] == pytest.approx(on / overall)


PATHS = [{}, {"few_classes": 0}, {"few_classes": 0, "head": 3}, {"few_classes": 0, "head": 1, "rows_per_salt": 5},
         {"rows_per_salt": 5}]


@pytest.mark.parametrize("fields, k, settings", [
    (["a", "text"], 4, PATHS[0]), (["n"], 2, PATHS[4]), (["a", "text"], 4, PATHS[1]), (["a", "n"], 20, PATHS[2]),
    (["n"], 2, PATHS[3])])
def test_batch_equals_scoring_every_pair(table, rows, settings, fields, k):
    train, asked = table.where("id % 4 <> 0"), table.where("id % 4 = 0")
    got = {}
    for r in predict_batch(train, asked, "id", fields, "kind", k, **settings).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["feature"], r["p"]))
    known = [r for r in rows if r[0] % 4]
    assert set(got) == {r[0] for r in rows if r[0] % 4 == 0}
    for r in rows:
        if r[0] % 4 == 0:
            same([(c, p) for _, c, p in sorted(got[r[0]])], brute(known, feats(r, fields), fields, k))


@pytest.mark.parametrize("settings", [PATHS[3], PATHS[4]])
def test_text_batch_equals_scoring_every_pair(table, rows, settings):
    fields, got = ["a", "n"], {}
    for r in predict_batch(table, table, "id", {f: f for f in fields}, "text", 4, **settings).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["feature"], r["p"]))
    for r in rows[::7]:
        same([(c, p) for _, c, p in sorted(got[r[0]])], brute_text(rows, feats(r, fields), fields, 4))


def test_long_evidence_does_not_underflow(spark):
    """Scores of thousands of features lie far below the smallest double."""
    words = " ".join(f"w{i}" for i in range(4000))
    df = spark.createDataFrame([(i, words if i % 2 else "z", "odd" if i % 2 else "even") for i in range(40)], "id int, t string, k string")
    df = S.attach(df, {"t": {"type": "Text", "analyzer": "whitespace"}})
    for settings in ({}, {"few_classes": 0}):
        found = predict_batch(df, df.where("id < 2"), "id", ["t"], "k", **settings).where("rank = 1").orderBy("id").collect()
        assert [(r["feature"], round(r["p"], 6)) for r in found] == [("even", found[0]["p"].__round__(6)), ("odd", 1.0)]
    assert predict(df, {"t": words}, "k").orderBy("rank").first()["p"] == pytest.approx(1.0)


def test_log_sum_exp(spark):
    df = spark.createDataFrame([(1, -1e5), (1, -1e5 + 1), (2, 800.0), (2, -800.0)], "g int, s double")
    found = {r["g"]: r["lse"] for r in log_sum_exp(df, ["g"], F.col("s")).collect()}
    assert found == pytest.approx({1: -1e5 + 1 + math.log(1 + math.exp(-1)), 2: 800.0})


def test_evaluate(table, rows):
    for test, keep in (({"id": {"$mod": [5, 0]}}, lambda r: r[0] % 5 == 0), ({"a": "x"}, lambda r: r[1] == "x")):
        found = ev.evaluate(table, test, {"a": {"$get": "a"}, "n": 1}, "kind", key="id").first()
        train = [r for r in rows if not keep(r)]
        asked = [r for r in rows if keep(r) and r[4] is not None]
        hits = sum(brute(train, feats(r, ["a"]) | {"n=1"}, ["a", "n"], 1)[0][0] == r[4] for r in asked)
        assert (found["test_samples"], found["train_samples"]) == (len(asked), len(train))
        assert found["accuracy"] == pytest.approx(hits / len(asked))


def test_quick_queries(table, rows):
    query, evaluation = ev.quick_queries(table, "kind", [F.col("id").desc()])
    assert query["where"] == dict(zip(["id", "a", "n", "text"], rows[-1][:4])) and query["predict"] == "kind"
    assert evaluation["evaluate"]["where"]["a"] == {"$get": "a"} and query["where"]["a"] == rows[-1][1]
    found = ev.quick_evaluate(table, "kind", ["id"]).first()
    assert found["test_samples"] == sum(r[4] is not None for r in rows[::10]) and found["train_samples"] == 216
    for df, target in ((table, "nope"), (table, "a.b"), (table.limit(0), "kind")):
        with pytest.raises(ValueError):
            ev.quick_predict(df, target, ["id"])


def test_relate(table, rows):
    found = relate(table, {"a": "hot"}, "text", None).collect()
    known = [(r[1] == "hot", set((r[3] or "").split())) for r in rows]
    assert {r["feature"] for r in found} == {f"text:{t}" for t in TOKENS}
    for r in found:
        t = r["feature"][5:]
        f, both = sum(t in ts for _, ts in known), sum(t in ts for c, ts in known if c)
        cond = sum(c for c, _ in known)
        assert tuple(r["fs"]) == (len(rows), f, cond, both, f - both)
        assert r["lift"] == pytest.approx(((both + 1) / (cond + 2)) / ((f + 1) / (len(rows) + 2)))
    best = relate(table, {"a": "hot"}, "text", 3).collect()
    assert [r["feature"] for r in best] == [r["feature"] for r in sorted(found, key=lambda r: (-round(r["mi"], 9), r["feature"]))[:3]]


@pytest.mark.parametrize("salt", [5, 100_000])
def test_similarity(table, rows, salt):
    known = {r[0]: feats(r, ["text", "a"]) for r in rows}
    n, df = len(rows), Counter(f for fs in known.values() for f in fs)
    idf = lambda f: math.log((n + 1) / (df[f] + 1)) + 1
    asked = {"text:red", "text:unknown", "a=x"}
    want = {}
    for key, fs in known.items():
        if fs & asked:
            norm = math.sqrt(sum(idf(f) ** 2 for f in fs) * sum(idf(f) ** 2 for f in asked))
            want[key] = sum(idf(f) ** 2 for f in fs & asked) / norm
    example = {"text": "red unknown", "a": "x"}
    got = {r["id"]: r["score"] for r in similarity_scores(table, example, "id", rows_per_salt=salt).collect()}
    assert got == pytest.approx(want)
    best = similarity(table, example, "id", 5).orderBy("rank").collect()
    assert [r["id"] for r in best] == sorted(want, key=lambda i: (-round(want[i], 9), i))[:5]
    assert similarity(table, {"text": ""}, "id").count() == 0
    late = F.col("id") % 3 == 1
    index = build_index(table.where(~late), ["text", "a"], "id", rows_per_salt=salt).append(table.where(late))
    assert {r["id"]: r["score"] for r in index.scores(example).collect()} == pytest.approx(want)
    assert [r["id"] for r in index.top(table, example, 5).orderBy("rank").collect()] == [r["id"] for r in best]
    assert index.scores({"text": "unknown"}).count() == 0
    with pytest.raises(ValueError):
        index.scores({"kind": "x"})
    first = build_index(table.where(~late), ["text"], "id", rows_per_salt=salt)
    whole = first.append(table.where(late))
    assert set(first.postings.inputFiles()) < set(whole.postings.inputFiles())  # what is sorted stays as it is


@pytest.fixture(scope="module")
def grocery(spark):
    """Impressions with two links; the answers below are worked out by hand."""
    e = Engine(spark)
    e.register("users", spark.createDataFrame([("u1", "veronica"), ("u2", "john")], "id string, name string"))
    e.register("products", spark.createDataFrame(
        [("p1", "rye bread", "food"), ("p2", "milk", "drink"), ("p3", "oat milk", "drink")], "id string, name string, kind string"),
        {"name": {"type": "Text", "analyzer": "whitespace"}})
    data = [("u1", "p1", True), ("u1", "p1", True), ("u1", "p2", False), ("u2", "p2", True), ("u2", "p2", True), ("u2", "p3", False)]
    e.register("impressions", spark.createDataFrame(data, "user string, product string, bought boolean"), {
        "user": {"type": "String", "link": "users.id"}, "product": {"type": "String", "link": "products.id"}})
    return e


def test_match_gives_linked_rows(grocery):
    found = grocery.match({"from": "impressions", "where": {"user.name": "veronica"}, "match": "product"})
    assert found.columns == ["id", "name", "kind", "p", "rank"]
    # sizes p1 2, p2 3, p3 1 of 6; with veronica 2, 1, 0
    score = {"p1": 3 * 3 / 4, "p2": 4 * 2 / 5, "p3": 2 * 1 / 3}
    want = sorted(((i, s / sum(score.values())) for i, s in score.items()), key=lambda x: -x[1])
    got = [(r["id"], r["p"]) for r in found.orderBy("rank").collect()]
    assert [i for i, _ in got] == ["p1", "p2", "p3"] and got == [(i, pytest.approx(p)) for i, p in want]


def test_recommend(grocery):
    q = {"from": "impressions", "recommend": "product", "goal": {"bought": True}}
    got = [(r["name"], r["p"]) for r in grocery.recommend(q).orderBy("rank").collect()]
    assert got == [("rye bread", pytest.approx(3 / 4)), ("milk", pytest.approx(3 / 5)), ("oat milk", pytest.approx(1 / 3))]
    q = {**q, "where": {"user.name": "john"}, "limit": 1, "select": ["id", "$p"]}
    found = grocery.recommend(q)
    # goal 4 of 6; p1 2/0, p2 2/1, p3 0/1; john 2 of the 4 and 1 of the 2
    odds = (5 / 3) * ((3 / 6) / (1 / 4)) * ((3 / 6) / (2 / 4))
    assert [tuple(r) for r in found.collect()] == [("p1", pytest.approx(odds / (1 + odds)))]


def test_linked_targets_and_generic_query(grocery):
    found = grocery.predict({"from": "impressions", "where": {"bought": True}, "predict": "product.kind"})
    assert {r["field"] for r in found.collect()} == {"product.kind"} and found.count() == 2
    tokens = grocery.predict({"from": "impressions", "where": {"bought": True}, "predict": "product.name"})
    assert {r["feature"] for r in tokens.collect()} == {"rye", "bread", "milk", "oat"}
    hits = grocery.query({"from": "products", "where": {"name": "milk"}, "get": "kind", "orderBy": "$p"})
    assert hits.orderBy("rank").first()["feature"] == "drink"
    plain = grocery.query({"from": "products", "where": {"kind": "drink"}, "get": "name", "orderBy": "id"})
    assert [r["name"] for r in plain.collect()] == ["milk", "oat milk"]


def test_evaluate_a_match(grocery):
    found = grocery.evaluate({"test": {"$index": {"$mod": [3, 0]}}, "evaluate": {
        "from": "impressions", "where": {"user": {"$get": "user"}}, "match": "product"}}, order_by=["user", "product", "bought"])
    assert found.first()["test_samples"] == 2


def test_match_and_recommend_without_links(table, rows):
    same(ranked(match(table, {"a": "hot"}, "kind", 5)), brute(rows, {"a=hot"}, ["a"], 5))
    n = sum(r[1] == "x" for r in rows)
    good = sum(r[1] == "x" and r[2] == 1 for r in rows)
    assert dict(ranked(recommend(table, "a", {"n": 1})))["x"] == pytest.approx((good + 1) / (n + 2))


def test_a_batch_tokenises_texts_once(table):
    """What is joined and counted are stored features; the plan of the answers has no text left."""
    found = predict_batch(table, table, "id", ["text"], "kind")
    assert "split(" not in found._jdf.queryExecution().toString()
    assert found.select("id").distinct().count() == table.count()
