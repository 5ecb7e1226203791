import pytest
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.analyzers import analyze, default_stop_words, tokens

NAIVE = "Ça va, l'été à Åbo?"


def run(spark, text, analyzer):
    return spark.createDataFrame([(text,)], "t string").select(analyze("t", analyzer).alias("x")).first()["x"]


def grams(items, lo, hi, sep=""):
    return [sep.join(items[i:i + n]) for n in range(lo, hi + 1) for i in range(len(items) - n + 1)]


@pytest.mark.parametrize("text, analyzer, expected", [
    ("  a\tb \n c ", "whitespace", ["a", "b", "c"]),
    ("", "whitespace", []),
    (None, "standard", None),
    (NAIVE, "standard", ["ça", "va", "l", "été", "à", "åbo"]),
    ("x.y|z", S.Delimiter("."), ["x", "y|z"]),
    ("a | b||c", S.Delimiter("|"), ["a", "b", "c"]),
    ("a | b||c", S.Delimiter("|", trim=False), ["a ", " b", "c"]),
    (r"a\Eb\Ec", S.Delimiter(r"\E"), ["a", "b", "c"]),
    ("The cat and THE dog", S.Language("en", stop_words=("and",), key_words=("Cat",)), ["the", "the", "dog"]),
    ("abc", S.CharNGram(1, 2), ["a", "b", "c", "ab", "bc"]),
    ("a", S.CharNGram(2, 3), []),
    ("", S.CharNGram(1, 2), []),
    ("été😀!", S.CharNGram(2, 5), grams("été😀!", 2, 5)),
    ("a b c", S.TokenNGram("whitespace", 2, 3, "_"), ["a_b", "b_c", "a_b_c"]),
    ("a b c", S.TokenNGram(S.TokenNGram("whitespace", 1, 2), 2, 2, "+"), grams(["a", "b", "c", "a b", "b c"], 2, 2, "+")),
])
def test_tokens(spark, text, analyzer, expected):
    assert run(spark, text, analyzer) == expected


def test_default_stop_words(spark):
    assert run(spark, "this is the cat", S.Language("en", use_default_stop_words=True)) == ["cat"]
    assert "ja" in default_stop_words("finnish")
    with pytest.raises(ValueError, match="thai"):
        run(spark, "x", S.Language("th", use_default_stop_words=True))


def test_token_table(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, None), (3, "")], "id int, t string")
    assert sorted(map(tuple, tokens(df, "id", "t", "whitespace").collect())) == [(1, "a"), (1, "b")]


def test_long_text_is_whole_and_linear(spark):
    words = [f"w{i}" for i in range(30_000)]
    df = spark.createDataFrame([(" ".join(words),)], "t string")
    n = df.select(F.size(analyze("t", S.TokenNGram("whitespace", 1, 2))).alias("n"),
                  F.size(analyze("t", S.CharNGram(3, 3))).alias("c"), F.length("t").alias("l")).first()
    assert n["n"] == 59_999 and n["c"] == n["l"] - 2


@pytest.mark.parametrize("name", ["whitespace", *sorted(set(S.LANGUAGES.values()))])
def test_equal_analyzers_give_equal_tokens(spark, name):
    other = S.Delimiter(" ") if name == "whitespace" else S.Language(name)
    assert S.Alias(name) == other
    for text in ("  a\tb \n c ", NAIVE, "東京 タワー abc x", ""):
        assert run(spark, text, S.Alias(name)) == run(spark, text, other)


def test_cjk_by_alias_gives_pairs_of_letters(spark):
    assert run(spark, "東京タワー x", "cjk") == ["東京", "京タ", "タワ", "ワー", "x"]


def test_rare_tokens_are_not_summed_before_the_shuffle(spark, tmp_path):
    from foretell.plans import registry

    rows = [(1, "The cat the cat"), (2, "the cat"), (3, "a"), (4, ""), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.tok_token_ngram(spark, str(tmp_path))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    plan = found._jdf.queryExecution().executedPlan().toString() if "Exchange" not in plan else plan
    assert plan.index("partial_count") < plan.index("Exchange")
    assert sorted(map(tuple, found.collect())) == [
        ("a", 1, 3), ("cat", 2, 1), ("cat_the", 1, 1), ("the", 2, 1), ("the_cat", 2, 1)]
