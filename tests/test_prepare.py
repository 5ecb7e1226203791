"""Inference, conform, sources, conversion."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.operators import conform as co
from foretell.operators import infer as inf
from foretell.sources import files
from foretell.sources.convert import convert

HEADER = ["id", "part", "price", "remark"]
ROWS = [  # a part list: separators, quotes and a line break inside of values, two nulls
    (1, 'bolt, 5"', 0.25, None), (2, "nut; brass | 10", 12.0, "ships in\ntwo weeks"), (3, "washer's ring", 0.0, None), (4, "#4 screw", 99.5, "last one"),
]


def csv_text(sep=",", decimal=".", extra=""):
    def cell(v):
        text = "" if v is None else str(v).replace(".", decimal) if isinstance(v, float) else str(v)
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in sep + '"\n') and not isinstance(v, float) else text

    lines = [sep.join(HEADER)] + [sep.join(map(cell, row)) + (extra if i % 2 == 0 else "") for i, row in enumerate(ROWS)]
    return "\n".join(lines) + "\n"


def by_id(df):
    return [tuple(r) for r in df.select(*HEADER).orderBy("id").collect()]


PARTS = S.Table.from_json({"type": "table", "columns": {
    "id": {"type": "Int", "nullable": False}, "part": {"type": "Text", "nullable": False, "analyzer": "whitespace"},
    "price": {"type": "Decimal", "nullable": False}, "remark": {"type": "Text", "nullable": True, "analyzer": "en"}}})


@pytest.mark.parametrize("text, options", [
    (csv_text(), {}), (csv_text(";"), {"delimiter": ";"}), (csv_text(";", ","), {"delimiter": ";", "decimal": ","}),
    (csv_text(extra=",,"), {}),
])
def test_csv(spark, tmp_path, text, options):
    path = tmp_path / "parts.csv"
    path.write_text(text)
    df = co.conform(files.read(spark, str(path), **options), PARTS)
    assert by_id(df) == ROWS


def test_csv_gzip_and_user_options_win(spark, tmp_path):
    path = tmp_path / "parts.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write(csv_text())
    assert files.read(spark, str(path)).count() == 4
    assert files.read(spark, str(path), header=False).count() == 5


def test_json_and_ndjson(spark, tmp_path):
    records = [dict(zip(HEADER, r)) for r in ROWS]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "a.ndjson").write_text("\n".join(map(json.dumps, records)))
    with gzip.open(tmp_path / "a.ndjson.gz", "wt") as f:
        f.write("\n".join(map(json.dumps, records)))
    for name in ("a.json", "a.ndjson", "a.ndjson.gz"):
        assert by_id(co.conform(files.read(spark, str(tmp_path / name)), PARTS)) == ROWS


@pytest.mark.parametrize("path, fmt, expected", [
    ("x.csv.gz", None, "csv"), ("/a.b/t.NDJSON", None, "ndjson"), ("t.dat", "json", "json"), ("p/t.parquet", None, "parquet")])
def test_detect_format(path, fmt, expected):
    assert files.detect_format(path, fmt) == expected


@pytest.mark.parametrize("path", ["x.xlsx", "x", "x.gz"])
def test_unknown_format(path):
    with pytest.raises(ValueError):
        files.detect_format(path)


def test_ndjson_writes_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    files.write_ndjson(df, str(tmp_path / "o"), gzip=True)
    text = "".join(gzip.open(part, "rt").read() for part in (tmp_path / "o").glob("*.json.gz"))
    assert json.loads(text) == {"a": 1, "b": None}


def test_convert(spark, tmp_path):
    source = tmp_path / "parts.csv"
    source.write_text(csv_text())
    found = convert(spark, str(source), str(tmp_path / "out.ndjson"))
    assert {n: c.type for n, c in found.columns.items()} == {"id": "Int", "part": "Text", "price": "Decimal", "remark": "Text"}
    assert found.columns["remark"].nullable and not found.columns["id"].nullable
    assert by_id(spark.read.json(str(tmp_path / "out.ndjson"))) == ROWS
    changed = {"type": "table", "columns": {"price": {"type": "Int"}, "id": {"type": "String"}}}
    convert(spark, str(source), str(tmp_path / "out.csv"), schema=changed, functions=[lambda d: d.drop("remark")])
    again = files.read_csv(spark, str(tmp_path / "out.csv"))
    assert sorted((r["id"], r["price"]) for r in again.collect()) == [("1", "0"), ("2", "12"), ("3", "0"), ("4", "99")]
    assert again.columns == ["id", "part", "price"]


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


@pytest.mark.parametrize("values, kind, expected", [
    ([1, 2, 3], "bigint", "Int"), ([1, None], "int", "Int"), ([1.0, 2.5], "double", "Decimal"),
    ([2147483647, -2147483648], "bigint", "Int"), ([2147483648, 1], "bigint", "String"), ([-2147483649, 1], "bigint", "String"),
    (["1", "2"], "string", "Int"), (["2147483648"], "string", "String"), (["9" * 50, "1"], "string", "String"),
    (["1", "2.5", "1e3"], "string", "Decimal"), (["1d", "2"], "string", "Text"), (["true", "FALSE"], "string", "Boolean"),
    (["1", "0", "true"], "string", "Text"), (["good", "1", "bad"], "string", "Text"), ([" ", "", "  "], "string", "Text"),
    ([None, None], "string", "String"), ([None], "double", "String"), ([True, False], "boolean", "Boolean"),
    ([dt.date(2020, 1, 1)], "date", "String"), ([dt.datetime(2020, 1, 1)], "timestamp", "String"), ([b"x"], "binary", "String"),
])
def test_types(spark, values, kind, expected):
    assert inf.infer_types(column(spark, values, kind)) == {"c": expected}


def test_arrays_have_no_type(spark):
    with pytest.raises(S.SchemaError, match="c"):
        inf.infer_types(spark.createDataFrame([([1],)], "c array<int>"))


def test_sampling_does_not_decide_nulls(spark):
    df = spark.range(2000).select(F.nullif("id", F.lit(5)).alias("c"))
    assert inf.infer_schema(df, sample=10).columns["c"] == S.Column("Int", True)
    assert inf.sampled(df, 100).count() < 400


def test_all_rows_decide_the_analyzer(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 12_000, "a-b-c").otherwise("a;b;c").alias("c"))
    assert inf.infer_analyzer(df, "c") == S.Delimiter(";")


def shown(v):
    """The delimiter of one value, counted by hand."""
    v2, counts = v.strip(" "), []
    for d in inf.DELIMITERS:
        parts = v2.split(d)
        inner = d.join(p.lstrip(" ") if i == len(parts) - 1 and i else p.rstrip(" ") if not i and len(parts) > 1 else p.strip(" ") if i else p
                       for i, p in enumerate(parts))
        blanks = sum(1 for i, c in enumerate(inner) if c == " " and (i == 0 or inner[i - 1] != " "))
        counts.append(len(parts) - 1 if len(parts) > 1 and len(parts) - 1 >= blanks else 0)
    return inf.DELIMITERS[counts.index(max(counts))] if max(counts) else " " if " " in v else None


def test_delimiters_by_hand(spark):
    values = ["2024-01-05", "k1:v1;k2:v2", "x ,y, z", "one | two", "a b c-d", "tab\tsep\t1", "", "   ", "word", "9,5", "--", "a - b - c d", ";;a b c", "q: is it so"]
    got = column(spark, values, "string").select("c", inf.delimiter_of(F.col("c")).alias("d")).collect()
    assert [(r.c, r.d) for r in got] == [(v, shown(v)) for v in values]


LANGUAGES = {
    "english": ["The order was sent to the wrong house and it has not come back", "We do not know who is at the door"],
    "german": ["Die Schrauben sind in der Kiste unter dem Tisch", "Er hat das nicht gewusst und ist wieder gegangen"],
    "spanish": ["Los tornillos están en la caja que hay debajo de la mesa", "No sé quién es el que llama a la puerta"],
    "finnish": ["Ruuvit ovat siinä laatikossa joka on pöydän alla", "En tiedä kuka se on mutta hän ei ole täällä"],
    "russian": ["Мы не знаем, кто был у двери и что он хотел", "Болты лежат в коробке, которая стоит под столом"],
    "cjk": ["ねじは机の下の箱の中 にあります", "扉の前に 誰がいるのか"], "greek": ["οι βίδες είναι στο κουτί", "δεν ξέρω ποιος είναι"],
    "hindi": ["पेंच मेज के नीचे डिब्बे में हैं", "दरवाजे पर कौन है"], "persian": ["پیچ‌ها زیر میز است", "چه کسی پشت در است"],
}
NOT_LISTED = {  # languages without a list of stop words are not taken for a neighbour
    "bulgarian": ["Винтовете са в кутията, която е под масата", "Не знам кой е на вратата и какво иска да каже"],
    "romanian": ["Șuruburile sunt în cutia care este sub masă", "Nu știu cine este la ușă și ce vrea să spună"],
    "czech": ["Šrouby jsou v krabici, která je pod stolem", "Nevím, kdo je u dveří a co chce říct"],
    "catalan": ["Els cargols són a la caixa que hi ha sota la taula", "No sé qui és a la porta ni què vol dir amb això"],
    "galician": ["Os parafusos están na caixa que hai debaixo da mesa", "Non sei quen está na porta nin o que quere dicir"],
    "latvian": ["Skrūves ir kastē, kas atrodas zem galda", "Es nezinu, kas ir pie durvīm un ko viņš grib teikt"],
    "indonesian": ["Sekrup ada di dalam kotak yang ada di bawah meja", "Saya tidak tahu siapa yang ada di pintu"],
}


@pytest.mark.parametrize("values, expected", [(v, S.Alias(k)) for k, v in LANGUAGES.items()] + [(v, S.Alias("whitespace")) for v in NOT_LISTED.values()])
def test_languages(spark, values, expected):
    assert inf.infer_analyzer(column(spark, values, "string"), "c") == expected


@pytest.mark.parametrize("values, expected", [
    (["1992-01-02", "1995-11-30"], S.Delimiter("-")), (["click|home", "view|cart|2"], S.Delimiter("|")), (["r:1", "g:2", "b:3"], S.Delimiter(":")),
    (["x;y", "z;w"], S.Delimiter(";")), (["hot ring", "small bolt"], S.Alias("whitespace")), (["PROMO", "STANDARD"], None), ([" "], S.Alias("whitespace")),
])
def test_analyzers(spark, values, expected):
    assert inf.infer_analyzer(column(spark, values, "string"), "c") == expected


def test_empty_columns(spark, tmp_path):
    (tmp_path / "e.csv").write_text("note,amount,id\n ,,\n ,,\n ,,\n")
    found = inf.infer_schema(files.read_csv(spark, str(tmp_path / "e.csv")))
    assert found.columns["amount"] == S.Column("String", True)
    assert found.columns["note"] == S.Column("Text", False, analyzer=S.Alias("whitespace"))


def test_conform_values(spark):
    df = spark.createDataFrame([(345.99, "-345.33", float("nan"), "true", 7)], "a double, b string, c double, d string, e int")
    schema = S.Table({n: S.Column(t, True) for n, t in (("a", "Int"), ("b", "Int"), ("c", "Decimal"), ("d", "Boolean"), ("x", "Int"))})
    out = co.conform(df, schema)
    assert tuple(out.first()) == (345, -345, None, True, 7)
    assert tuple(co.conform(out, schema).first()) == tuple(out.first())
    assert co.schema_diff(df, schema) == {"only_in_data": ["e"], "only_in_schema": ["x"]}


@pytest.mark.parametrize("value", ["abc", "99999999999"])
def test_malformed_fails(spark, value):
    with pytest.raises(Exception, match="CAST"):
        co.conform(column(spark, [value], "string"), S.Table({"c": S.Column("Int")})).collect()


def test_nulls_in_a_strict_column(spark):
    df, strict = column(spark, [1, None], "int"), S.Table({"c": S.Column("Int")})
    with pytest.raises(ValueError, match="c"):
        co.check_not_null(df, strict)
    with pytest.raises(Exception, match="column `c` is null"):
        co.conform(df, strict).collect()
    assert co.conform(df, strict, check=False).count() == 2


def test_functions_run_after_dates_are_strings(spark):
    df = column(spark, [dt.date(2020, 1, 2), None], "date")
    out = co.apply_functions(df, [lambda d: d.withColumn("y", F.substring("c", 1, 4)), lambda d: d.withColumn("z", F.concat("y", F.lit("!")))])
    assert sorted(map(str, out.collect())) == ["Row(c='2020-01-02', y='2020', z='2020!')", "Row(c=None, y=None, z=None)"]
