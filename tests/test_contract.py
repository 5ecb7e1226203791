"""Parts of the query contract that the registered queries do not show."""

import pytest
from pyspark.sql import functions as F

from foretell import Engine
from foretell.operators.evaluate import evaluate
from foretell.operators.index import with_index


@pytest.fixture(scope="module")
def engine(spark):
    e = Engine(spark)
    e.register("shops", spark.createDataFrame([(1, "north", 7), (2, "south", 8)], "id int, side string, owner int"),
               {"owner": {"type": "Int", "link": "owners.id"}})
    e.register("owners", spark.createDataFrame([(7, "Ann"), (8, "Bo")], "id int, name string"))
    rows = [(i, (3, 1, 3, 2, 3, 1)[i % 6], "red" if i % 2 else "blue", i % 3 == 0) for i in range(60)]
    e.register("sales", spark.createDataFrame(rows, "id int, shop int, colour string, paid boolean"), {"shop": {"type": "Int", "link": "shops.id"}})
    return e


def test_hits_without_a_linked_row_are_left_out_before_the_limit(engine):
    hit = engine.match({"from": "sales", "where": {"colour": "blue"}, "match": "shop", "limit": 1}).collect()
    assert [(r.id, r["rank"]) for r in hit] == [(1, 1)] or [(r.id, r["rank"]) for r in hit] == [(2, 1)]
    best = engine.recommend({"from": "sales", "recommend": "shop", "goal": {"paid": True}, "limit": 1}).collect()
    assert len(best) == 1 and best[0]["rank"] == 1


def test_scores_reasons_and_linked_fields(engine):
    hits = engine.match({"from": "sales", "where": {"colour": "red"}, "match": "shop", "select": ["id", "$score", "owner.name", "$why"]}).collect()
    assert {r.id: r.owner__name for r in hits} == {1: "Ann", 2: "Bo"}
    assert all(0 < r.p < 1 and [w.feature for w in r.why] == ["prior", "colour=red"] for r in hits)
    found = engine.recommend({"from": "sales", "recommend": "shop", "goal": {"paid": True}, "where": {"colour": "red"}, "select": ["id", "$p", "$why"]}).collect()
    assert [w.feature for w in found[0].why][0] == "prior" and len(found[0].why) == 3
    assert engine.predict({"from": "sales", "predict": "colour", "select": ["feature", "$score"]}).columns == ["feature", "p"]
    assert engine.query({"from": "sales", "get": "colour", "orderBy": {"$desc": "$p"}, "select": ["feature", "$why"]}).count() == 2


def test_pages_and_no_limit(engine):
    every = engine.relate({"from": "sales", "where": {"paid": True}, "relate": "shop", "limit": None}).orderBy(F.desc("mi"), "feature")
    names = [r.feature for r in every.collect()]
    page = engine.relate({"from": "sales", "where": {"paid": True}, "relate": "shop", "offset": 1, "limit": 1}).collect()
    assert [(r.feature, r["rank"]) for r in page] == [(names[1], 2)]
    rest = engine.relate({"from": "sales", "where": {"paid": True}, "relate": "shop", "offset": 1, "limit": None}).collect()
    assert [r.feature for r in rest] == names[1:]
    for query in ({"predict": "colour"}, {"match": "shop"}):
        run = engine.predict if "predict" in query else engine.match
        assert sorted(r["rank"] for r in run({"from": "sales", "limit": None, **query}).collect()) == [1, 2]
    assert engine.similarity({"from": "sales", "similarity": {"colour": "red"}, "limit": None}, "id").count() == 30


def test_quick_queries_name_their_table(engine):
    query, hits = engine.quick_predict("sales", "colour", ["id"])
    assert query["from"] == "sales" and query["where"]["shop"] == 3 and hits.columns == ["p", "feature", "why"]
    query, result = engine.quick_evaluate("sales", "colour", ["id"])
    assert query["evaluate"]["from"] == "sales" and result.first().test_samples == 6


def test_evaluate_needs_no_unique_key(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (2, "b", "y"), (2, "a", "y"), (3, "b", "x")]
    df = spark.createDataFrame(rows * 10, "k int, f string, t string").withColumn("held", F.rand(3) < 2)
    both = df.withColumn("held", F.lit(False)).union(df.limit(4).withColumn("held", F.lit(True)))
    found = evaluate(both, {"held": True}, {"f": {"$get": "f"}}, "t", "k").first()
    assert (found.test_samples, found.train_samples) == (4, 60) and found.accuracy is not None


def test_more_ranges_than_shuffle_partitions(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    found = with_index(df, ["k"], buckets=37)
    assert found.where("k <> _index").count() == 0 and found.count() == 5000


def test_a_changed_table_keeps_its_name(spark, tmp_path):
    e = Engine(spark)
    e.create_table("t_located", spark.range(10).select(F.col("id").cast("int").alias("id")))
    e.delete_entries("t_located", {"id": {"$gte": 5}})
    assert [r.id for r in spark.table("t_located").orderBy("id").collect()] == [0, 1, 2, 3, 4]
    spark.sql("DROP TABLE t_located")


@pytest.mark.parametrize("analyzer, text, tokens", [
    ({"type": "language", "language": "hindi"}, "हिन्दी भाषा", ["हिन्दी", "भाषा"]),
    ({"type": "language", "language": "cjk"}, "机器学习 中", ["机器", "器学", "学习", "中"]),
])
def test_marks_and_letter_pairs(spark, analyzer, text, tokens):
    from foretell import schema as S
    from foretell.functions.analyzers import analyze

    a = S.Language(analyzer["language"], use_default_stop_words=False)
    assert spark.createDataFrame([(text,)], "t string").select(analyze("t", a).alias("x")).first().x == tokens
