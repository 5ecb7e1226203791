"""CSV with line breaks in quotes, in many tasks, against the reader that takes a file as a whole."""

import random
from collections import Counter

import pytest

from foretell.sources import files

WHOLE = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "PERMISSIVE", "enforceSchema": True}


def value(r):
    text = "".join(r.choice(["a", "b ", "é", ",", ";", "\n", '""', "\r\n", " "]) for _ in range(r.randint(0, 9)))
    return r.choice([f'"{text}"', "plain", "", '5" disk', "x y", '""', "7"])


@pytest.mark.parametrize("seed, sep, end", [(1, ",", "\n"), (2, ";", "\n"), (3, ",", "\r\n")])
def test_many_tasks_read_what_one_task_reads(spark, tmp_path, seed, sep, end):
    r = random.Random(seed)
    for name in ("one", "two"):
        rows = [sep.join(value(r) for _ in range(r.choice([3, 3, 3, 2, 4]))) for _ in range(r.choice([0, 300]) if name == "two" else 900)]
        (tmp_path / f"{name}.csv").write_bytes((sep.join(["id", '"te""xt"', "z"]) + end + end.join(rows) + r.choice(["", end])).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = Counter(tuple(x) for x in spark.read.options(**WHOLE, sep=sep).csv(str(tmp_path)).collect())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0b")
        df = files.read_csv(spark, str(tmp_path), delimiter=sep)
        got = Counter(tuple(x) for x in df.collect())
        splits = spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert df.columns == ["id", 'te"xt', "z"] and splits > 5
    assert got == want, list((got - want).items())[:5] + list((want - got).items())[:5]


def test_a_value_over_many_splits(spark, tmp_path):
    long = "\n".join(f"line {i}, with ; marks" for i in range(500))
    (tmp_path / "x.csv").write_text(f'a,b\n1,"{long}"\n2,"short"\n')
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500b")
        got = files.read_csv(spark, str(tmp_path / "x.csv")).orderBy("a").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in got] == [("1", long), ("2", "short")]
