"""Stored tables and streaming ingest."""

import json

import pytest
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.plans import stored
from foretell.plans.engine import Engine
from foretell.plans.workspace import SETTING, fresh_path, shared_dir
from foretell.streaming import ingest
from foretell.streaming.ingest import ingest_stream, loaded, progress

SCHEMA = {"type": "table", "columns": {"id": {"type": "Int"}, "t": {"type": "Text", "nullable": True, "analyzer": "en"}}}


@pytest.fixture
def engine(spark):
    return Engine(spark)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def fresh(engine, name, n=10):
    engine.create_table(name, engine.spark.range(n).select("id", F.lit("x y").alias("t")), SCHEMA)
    return name


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get(SETTING)
    assert fresh_path(spark, "a").startswith(spark.conf.get(SETTING)) and fresh_path(spark, "a") != fresh_path(spark, "a")


def test_append_is_conformed_and_keeps_the_schema(engine):
    t = fresh(engine, "appended")
    assert engine.append(t, engine.spark.createDataFrame([("10",), ("11",)], "id string")) == 2
    assert ids(engine.table(t)) == list(range(12)) and engine.schema(t) == S.Table.from_json(SCHEMA)
    with pytest.raises(ValueError, match="nothing"):
        engine.append(t, engine.spark.range(0))
    with pytest.raises(ValueError, match="other"):
        engine.append(t, engine.spark.range(1).withColumnRenamed("id", "other"))
    with pytest.raises(Exception, match="is null"):
        engine.append(t, engine.spark.createDataFrame([(None, "a")], "id int, t string"))
    assert ids(engine.table(t)) == list(range(12))


def test_delete_copy_columns_optimize(engine):
    t = fresh(engine, "changed")
    assert ids(engine.delete_entries(t, {"id": {"$gte": 5}})) == [0, 1, 2, 3, 4]
    assert ids(engine.delete_entries(t, {"t": None})) == [0, 1, 2, 3, 4]
    assert ids(engine.copy_table(t, "copied")) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="copied"):
        engine.copy_table(t, "copied")
    engine.copy_table(t, "copied", replace=True)
    engine.create_column("copied", "n", {"type": "Int", "nullable": True})
    engine.create_column("copied", "b", {"type": "Boolean"}, True)
    assert {(r["n"], r["b"]) for r in engine.table("copied").collect()} == {(None, True)}
    engine.delete_column("copied", "t")
    with pytest.raises(ValueError):
        engine.delete_column("copied", "t")
    assert engine.table("copied").columns == ["id", "n", "b"]
    assert ids(engine.optimize_table("copied", files=1)) == [0, 1, 2, 3, 4]
    assert engine.table("copied").rdd.getNumPartitions() == 1
    assert ids(engine.table(t)) == [0, 1, 2, 3, 4]


def files_of(engine, t):
    return sorted(engine.spark.table(f"default.{t}").inputFiles())


def test_columns_change_without_rewriting(engine):
    t = fresh(engine, "columns")
    before = files_of(engine, t)
    engine.create_column(t, "note", {"type": "String", "nullable": True}, "it's \\ new")
    engine.create_column(t, "x", {"type": "Decimal"}, 1.5)
    engine.create_column(t, "flag", {"type": "Boolean", "nullable": True})
    engine.append(t, engine.spark.createDataFrame([(10, None, 2.5)], "id int, note string, x double"))
    assert {(r["note"], r["x"], r["flag"]) for r in engine.table(t).collect()} == {("it's \\ new", 1.5, None), (None, 2.5, None)}
    engine.delete_column(t, "note")
    engine.create_column(t, "note", {"type": "Int", "nullable": True})  # a name that was dropped comes back empty
    assert {r["note"] for r in engine.table(t).collect()} == {None} and engine.schema(t).columns["note"].type == "Int"
    engine.create_column(t, "id", {"type": "String"}, "same")  # replaced in its place
    assert engine.table(t).columns == ["id", "t", "x", "flag", "note"] and {r["id"] for r in engine.table(t).collect()} == {"same"}
    assert S.analyzer_of(engine.table(t), "t") == S.Alias("en")
    assert set(before) < set(files_of(engine, t))
    engine.optimize_table(t, files=1)
    assert engine.table(t).columns == ["id", "t", "x", "flag", "note"] and engine.table(t).count() == 11
    assert engine.schema(t).columns["x"].type == "Decimal"


def test_deleting_writes_places_alone(engine, monkeypatch):
    t = fresh(engine, "places", 1000)
    before = files_of(engine, t)
    assert ids(engine.delete_entries(t, {"id": {"$gte": 5}}, rewrite=False)) == list(range(5))
    assert files_of(engine, t) == before
    engine.append(t, engine.spark.range(5, 8))
    engine.delete_entries(t, {"id": 99}, rewrite=False)  # matches nothing
    assert len(engine._stored(t).state()["deleted"]) == 1
    monkeypatch.setattr(stored, "VECTORS", 1)
    assert ids(engine.delete_entries(t, {"id": {"$mod": [2, 0]}}, rewrite=False)) == [1, 3, 5, 7]
    assert len(engine._stored(t).state()["deleted"]) == 1
    engine.create_column(t, "n", {"type": "Int"}, 7)
    assert {(r["id"], r["n"]) for r in engine.table(t).collect()} == {(i, 7) for i in (1, 3, 5, 7)}
    assert ids(engine.copy_table(t, "places_copy", replace=True)) == [1, 3, 5, 7]
    assert ids(engine.optimize_table(t)) == [1, 3, 5, 7] and "deleted" not in engine._stored(t).state()
    assert engine.search({"from": t, "where": {"id": 3}, "select": ["id", "n"]}).first()["n"] == 7


def test_a_name_is_there_at_any_time(engine, monkeypatch):
    """Another schema takes the name over without dropping it."""
    t = fresh(engine, "taken")
    said = []
    run = engine.spark.sql
    monkeypatch.setattr(type(engine.spark), "sql", lambda self, text, *a, **b: said.append(text) or run(text, *a, **b))
    engine.create_table(t, engine.spark.createDataFrame([("a", 1.5)], "id string, v double"))
    engine.create_table(t, engine.spark.createDataFrame([(3, "z")], "id long, v string"))
    assert [tuple(r) for r in engine.table(t).collect()] == [(3, "z")] and engine.table(t).columns == ["id", "v"]
    assert not any("DROP" in x for x in said)


def test_quick_add_load_export(engine, tmp_path):
    (tmp_path / "goods.csv").write_text("id,name,price\n1,rye bread,2.5\n2,milk,1\n")
    engine.quick_add_table(str(tmp_path / "goods.csv"))
    assert {n: c.type for n, c in engine.schema("goods").columns.items()} == {"id": "Int", "name": "Text", "price": "Decimal"}
    (tmp_path / "more.ndjson").write_text('{"id": "3", "name": "tea", "price": 4}\n')
    assert engine.load_file("goods", str(tmp_path / "more.ndjson")) == 1
    engine.export_table("goods", str(tmp_path / "out"), gzip=True)
    assert ids(engine.spark.read.json(str(tmp_path / "out"))) == [1, 2, 3]
    found = engine.predict({"from": "goods", "where": {"name": "rye"}, "predict": "id"})
    assert found.orderBy("rank").first()["feature"] == "1"


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = [{"id": i, "t": None if i % 2 else "a b"} for i in range(6)]
    bad = ['{"id": "x", "t": "no number"}', '{"t": "no id"}', '{"id": 5', '{"id": 3000000000}']
    (source / "1.ndjson").write_text("\n".join([json.dumps(g) for g in good] + bad))
    paths = [str(tmp_path / n) for n in ("table", "rejected", "checkpoint")]

    def run():
        q = ingest_stream(spark, str(source), SCHEMA, *paths)
        q.awaitTermination()
        return progress(q)

    assert sum(p["rows"] for p in run()) == 10
    (source / "2.ndjson").write_text('{"id": 99}\n')
    run()
    run()
    table = loaded(spark, paths[0], SCHEMA)
    assert ids(table) == [0, 1, 2, 3, 4, 5, 99] and S.analyzer_of(table, "t") == S.Alias("en")
    rejected = spark.read.parquet(paths[1])
    assert sorted(str(r["errors"]) for r in rejected.collect()) == [
        "['_corrupt_record', 'id']", "['id']", "['id']", "['id']"]
    assert rejected.where("_corrupt_record is not null").first()["_corrupt_record"] == '{"id": 5'


def test_files_are_skipped_by_either_column(engine):
    df = engine.spark.range(20_000).select("id", F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"),
                                           F.when(F.col("id") % 97 > 0, F.pmod(F.hash("id"), F.lit(10_000))).alias("b"))
    engine.create_table("curved", df)
    found = engine.optimize_table("curved", files=16, cluster_by=["a", "b"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    edges = found.groupBy(F.input_file_name()).agg(*[f(c) for c in ("a", "b") for f in (F.min, F.max)]).collect()
    assert len(edges) == 16
    for low, high in ((1, 2), (3, 4)):  # a filter on one value skips a quarter of the files at least, on either column
        assert sum(e[low] <= 3_300 <= e[high] for e in edges) <= 12


def test_a_batch_shows_wholly_or_not_at_all(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    paths = [str(tmp_path / n) for n in ("table", "rejected", "checkpoint")]
    kept = []

    def run():
        q = ingest.ingest_stream(spark, str(source), SCHEMA, *paths, max_files=1)
        q.awaitTermination()

    def seen():
        return ids(ingest.loaded(spark, paths[0], SCHEMA)), sorted(r["id"] for r in ingest.rejects(spark, paths[0], SCHEMA).collect())

    assert seen() == ([], [])
    (source / "1.ndjson").write_text('{"id": 1}\n{"id": "x"}\n')
    run()
    assert seen() == ([1], ["x"])
    write = ingest._write

    def dies(rows, path):
        if "rejected" in path:
            raise RuntimeError("killed between the two writes")
        kept.append(path)
        return write(rows, path)

    (source / "2.ndjson").write_text('{"id": 2}\n{"id": "y"}\n')
    monkeypatch.setattr(ingest, "_write", dies)
    with pytest.raises(Exception):
        run()
    assert kept and spark.read.parquet(kept[0]).count() == 1 and seen() == ([1], ["x"])
    monkeypatch.setattr(ingest, "_write", write)
    run()
    assert seen() == ([1, 2], ["x", "y"])
    before = ingest.loaded(spark, paths[0], SCHEMA)
    assert ingest.compact_stream(spark, paths[0], SCHEMA, paths[1]) == 2 and ingest.compact_stream(spark, paths[0], SCHEMA, paths[1]) == 0
    (source / "3.ndjson").write_text('{"id": 3}\n')
    run()
    assert seen() == ([1, 2, 3], ["x", "y"]) and ids(before) == [1, 2]
    assert [(r["first"], r["last"], r["n_rows"], r["n_rejected"]) for r in ingest.log(spark, paths[0])] == [(0, 1, 2, 2), (2, 2, 1, 0)]
