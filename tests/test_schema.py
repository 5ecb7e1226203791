import pytest

from foretell import schema as S

ALIAS_FR = S.Alias("fr")


@pytest.mark.parametrize("obj", [
    "whitespace", "english",
    {"type": "language", "language": "english", "useDefaultStopWords": False, "customStopWords": [], "customKeyWords": []},
    {"type": "delimiter", "delimiter": ",", "trimWhitespace": True},
    {"type": "char-ngram", "minGram": 1, "maxGram": 2},
    {"type": "token-ngram", "source": "french", "minGram": 1, "maxGram": 2, "tokenSeparator": " "},
    {"type": "token-ngram", "source": {"type": "token-ngram", "source": "standard", "minGram": 1, "maxGram": 2,
                                       "tokenSeparator": " "}, "minGram": 2, "maxGram": 2, "tokenSeparator": "-"},
])
def test_analyzer_json_round_trip(obj):
    assert S.analyzer(obj).to_json() == obj
    assert S.analyzer(S.analyzer(obj).to_json()) == S.analyzer(obj)


@pytest.mark.parametrize("a, b, same", [
    (ALIAS_FR, S.Delimiter(","), False),
    (S.Delimiter(","), S.Delimiter(",", trim=False), False),
    (S.Language("fr", key_words=("pain",)), S.Language("french", key_words=["pain"]), True),
    (ALIAS_FR, S.Language("french"), True),
    (ALIAS_FR, S.Language("french", use_default_stop_words=True), False),
    (S.Alias("whitespace"), S.Delimiter(" "), True),
    (S.Alias("whitespace"), S.Delimiter(" ", trim=False), False),
])
def test_analyzer_equality(a, b, same):
    assert (a == b) is same


@pytest.mark.parametrize("make", [
    lambda: S.Alias("elvish"), lambda: S.CharNGram(0, 2), lambda: S.CharNGram(3, 2), lambda: S.Delimiter(""),
    lambda: S.analyzer({"type": "delimiter"}), lambda: S.analyzer({"type": "other"}),
    lambda: S.analyzer({"type": "char-ngram", "minGram": 1, "maxGram": 2, "x": 1}),
    lambda: S.Column.from_json({"analyzer": "fi"}), lambda: S.Column.from_json({"type": "array"}),
    lambda: S.Column.from_json({"type": "Text", "analyzer": "elvish"}),
    lambda: S.Column.from_json({"type": "String", "analyzer": "english"}),
    lambda: S.Column.from_json({"type": "Int", "link": "infinity"}),
    lambda: S.Column.from_json({"type": "Int", "nullable": "yes"}),
    lambda: S.Column.from_json({"type": "Int", "other": 1}),
    lambda: S.Table.from_json({"type": "table", "columns": {}}),
    lambda: S.Table.from_json({"columns": {"a": {"type": "Int"}}}),
    lambda: S.Database.from_json({"schema": {}, "other": 1}),
])
def test_rejected(make):
    with pytest.raises(S.SchemaError):
        make()


@pytest.mark.parametrize("name", ["a b", "a.b", "a\tb", "a\nb", "a/b", 'a"b', "$a", ""])
def test_names(name):
    column = {"type": "Int"}
    with pytest.raises(S.SchemaError):
        S.Table.from_json({"type": "table", "columns": {name: column}})
    with pytest.raises(S.SchemaError):
        S.Database.from_json({"schema": {name: {"type": "table", "columns": {"a": column}}}})
    with pytest.raises(S.SchemaError):
        S.Link("t", name)


def database():
    return S.Database.from_json({"schema": {
        "one": {"type": "table", "columns": {
            "to": {"type": "Int", "nullable": False, "link": "two.id"}, "b": {"type": "Text", "nullable": True,
                                                                            "analyzer": "fi"}}},
        "two": {"type": "table", "columns": {"id": {"type": "Int"}, "a": {"type": "Decimal"}}},
    }})


def test_database():
    d = database()
    d.check_links()
    assert S.Database.from_json(d.to_json()) == d
    assert d.reachable("one") == ["b", "to", "to.a", "to.id"]
    assert d.tables["one"].columns["b"].analyzer == S.Alias("finnish")
    broken = S.Database({"one": d.tables["one"]})
    with pytest.raises(S.SchemaError, match="one.to"):
        broken.check_links()


def test_metadata_survives_filter_select_and_files(spark, tmp_path):
    df = S.attach(spark.createDataFrame([(1, "x y")], "to int, b string"), database().tables["one"])
    df.where("to > 0").select("b", "to").write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert S.analyzer_of(back, "b") == S.Alias("fi") and S.link_of(back, "to") == S.Link("two", "id")
