import json

import pytest
from pyspark.sql import functions as F

from foretell.functions.predicates import condition
from foretell.operators import search as se
from foretell.operators import index
from foretell.operators.index import deep_page, page_ranges, with_index
from foretell.operators.skew import common_join, salted_join
from foretell.plans.engine import Engine


@pytest.fixture(scope="module")
def shop(spark):
    e = Engine(spark)
    e.register("users", spark.createDataFrame([(1, "ann", "fi"), (2, "bob", None)], "id int, name string, land string"))
    rows = [(1, 1, "rye bread", 2.5), (2, 1, "Bread roll", 1.0), (3, 2, None, 4.0), (4, 9, "milk", None), (5, None, "tea", 3.0)]
    e.register("orders", spark.createDataFrame(rows, "id int, user int, item string, price double"), {
        "user": {"type": "Int", "link": "users.id"}, "item": {"type": "Text", "analyzer": "standard"}})
    return e


@pytest.mark.parametrize("where, ids", [
    ({"item": "milk"}, [4]),
    ({"user": 1, "price": {"$gte": 2}}, [1]),
    ({"item": None}, [3]),
    ({"item": {"$match": "BREAD"}}, [1, 2]),
    ({"item": {"$match": "bread rye"}}, [1]),
    ({"$exists": "price"}, [1, 2, 3, 5]),
    ({"price": {"$exists": False}}, [4]),
    ({"price": {"$gt": 1.0, "$lt": 4.0}}, [1, 5]),
    ({"price": {"$lte": 1.0}}, [2]),
    ({"id": {"$mod": [2, 0]}}, [2, 4]),
    ({"id": {"$get": "user"}}, [1]),
    ({"user.name": "ann"}, [1, 2]),
    ({"user.land": None}, [3, 4, 5]),
    (None, [1, 2, 3, 4, 5]),
])
def test_where(shop, where, ids):
    found = shop.search({"from": "orders", "where": where, "select": ["id"], "orderBy": "id", "limit": 100})
    assert [r["id"] for r in found.collect()] == ids
    assert shop.total({"from": "orders", "where": where}).first()["total"] == len(ids)


def test_paging_and_order(shop):
    def ids(**q):
        return [r["id"] for r in shop.search({"from": "orders", "select": ["id"], **q}).collect()]

    assert ids(orderBy="id", offset=2, limit=2) == [3, 4]
    assert ids(orderBy=[{"$desc": "user.name"}, "id"], limit=3) == [3, 1, 2]


def test_unknown_names(shop, spark):
    for query in ({"from": "orders", "where": {"nope": 1}}, {"from": "orders", "where": {"item.x": 1}},
                  {"from": "orders", "where": {"user.nope": 1}}, {"from": "orders", "where": {"id": {"$no": 1}}},
                  {"from": "orders", "predict": "x"}, {"from": "orders", "where": {"$index": 1}}):
        with pytest.raises(ValueError):
            shop.search(query)


def test_hits_leave_out_nulls(shop):
    hits = [json.loads(r[0]) for r in se.to_hits(shop.table("orders").orderBy("id")).collect()]
    assert "item" not in hits[2] and hits[0] == {"id": 1, "user": 1, "item": "rye bread", "price": 2.5}


def test_expand_links(shop):
    found = shop.expand_links("orders")
    assert found.columns == ["id", "item", "price", "user", "user__id", "user__land", "user__name"]
    assert {r["id"]: r["user__name"] for r in found.collect()} == {1: "ann", 2: "ann", 3: "bob", 4: None, 5: None}


def test_filter_on_a_linked_field_reaches_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id % 3 as string) kind").write.parquet(str(tmp_path / "t"))
    e = Engine(spark)
    e.register("t", spark.read.parquet(str(tmp_path / "t")))
    e.register("o", spark.range(50).withColumnRenamed("id", "t"), {"t": {"type": "Int", "link": "t.id"}})
    plan = e.search({"from": "o", "where": {"t.kind": "1"}})._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kind,1)" in plan and "LeftOuter" not in plan


@pytest.mark.parametrize("rows, hot", [(0, 0), (7, 0), (5000, 0), (6000, 2000)])
def test_row_index(spark, rows, hot):
    """Positions are those of a global sort, also if one leading value holds a third of the rows."""
    df = spark.range(rows).select(
        F.when(F.col("id") < hot, "hot").otherwise(F.nullif(F.concat(F.lit("k"), F.pmod(F.hash("id"), F.lit(97))), F.lit("k3")))
        .alias("a"), F.hash("id").alias("b"), "id")
    got = with_index(df, ["a", "b", "id"], buckets=8).collect()
    want = sorted(got, key=lambda r: (r["a"] is not None, r["a"] or "", r["b"], r["id"]))
    assert [r["_index"] for r in want] == list(range(rows))
    cond = condition(df.withColumn("_index", F.lit(1)), {"$index": {"$mod": [3, 1]}})
    assert "_index" in str(cond)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_a_plain_join(spark, how):
    left = spark.range(3000).select(F.col("id").alias("q"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(0), F.col("id") % 3)).alias("v"))
    got = salted_join(left, right, "k", "q", rows_per_salt=100, how=how).select("k", "q", "v").collect()
    want = left.join(right, "k", how).select("k", "q", "v").collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 3000


def test_ten_thousand_ranges(spark):
    """More ranges than the driver has bounds for: the finer bounds come from a table."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7).alias("a"), F.xxhash64("id").alias("b"))
    want = sorted((r.a is not None, r.a or 0, r.b) for r in df.collect())
    got = with_index(df, ["a", "b"], buckets=10_000).collect()
    assert sorted((r["_index"], r.a is not None, r.a or 0, r.b) for r in got) == [(i, *w) for i, w in enumerate(want)]


@pytest.mark.parametrize("falling", [[False, False], [True, False], [False, True], [True, True]])
def test_deep_pages(spark, monkeypatch, falling):
    monkeypatch.setattr(index, "TOP", 8)
    df = spark.range(5_000).select(F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 11).alias("a"), "id")
    order = [F.col(c).desc() if down else F.col(c).asc() for c, down in zip(df.columns, falling)]
    whole = [tuple(r) for r in df.orderBy(*order).collect()]
    keys = [F.col("a"), F.col("id")]
    for offset, limit in ((0, 3), (2500, 10), (4995, 10), (4000, None), (6000, 10)):
        found = [tuple(r) for r in deep_page(df, keys, falling, offset, limit, few=20).collect()]
        assert found == whole[offset : None if limit is None else offset + limit]


def test_a_page_in_the_middle_sorts_few_rows(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("a"), "id")
    rows, skipped, left = page_ranges(df, [F.col("a"), F.col("id")], [True, False], 100_000, 10, few=100)
    assert left < 2_000 and rows.count() == left and skipped <= 100_000 < 100_010 <= skipped + left
    same, _, all_ = page_ranges(df.select(F.lit(1).alias("a")), [F.col("a")], [False], 100_000, 10, few=100)
    assert all_ == 200_000  # equal keys cannot be told apart


@pytest.mark.parametrize("falling", [[False, True], [True, False]])
def test_pages_of_odd_keys(spark, monkeypatch, falling):
    """Null, nan, zeros of both signs and a value that many rows share; the bounds are plain comparisons."""
    monkeypatch.setattr(index, "TOP", 2)
    odd = F.when(F.col("id") % 4 == 0, F.lit("nan").cast("double")).when(F.col("id") % 4 == 1, None).when(F.col("id") % 8 == 2, -0.0)
    df = spark.range(2_000).select(odd.otherwise(F.col("id") % 3 - 1.0).alias("a"), F.col("id").cast("string").alias("b"))
    order = [F.col(c).desc() if down else F.col(c).asc() for c, down in zip(df.columns, falling)]
    whole = [r["b"] for r in df.orderBy(*order).collect()]
    keys = [F.col("a"), F.col("b")]
    for offset in (0, 480, 505, 1_000, 1_400, 1_990):
        found = deep_page(df, keys, falling, offset, 10, few=30)
        assert [r["b"] for r in found.collect()] == whole[offset : offset + 10]
        rows, skipped, left = page_ranges(df, keys, falling, offset, 10, few=30)
        assert left < 200 and skipped <= offset < skipped + left
        assert "lambda" not in rows._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("most", [3, 1_000])
def test_common_join_is_a_plain_join(spark, how, exact, most):
    left = spark.range(3000).select(F.col("id").alias("q"), F.when(F.col("id") < 1000, 0).when(F.col("id") % 9 > 0, F.col("id") % 50).alias("k"))
    right = left.where("k < 40").groupBy("k").agg(F.count("*").alias("n"), F.max("q").alias("v"))
    got = common_join(left, right, "k", "n", "q", 100, how, exact, most)
    assert sorted(got.columns) == ["k", "q", "v"]
    want = left.join(right.drop("n"), "k", how).select("k", "q", "v").collect()
    assert sorted(map(str, got.select("k", "q", "v").collect())) == sorted(map(str, want))
