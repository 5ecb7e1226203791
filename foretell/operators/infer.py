"""Schema inference as aggregations: exact over all rows unless a sample is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell import schema as S
from foretell.functions.analyzers import STOP_WORD_LANGUAGES, default_stop_words, words
from foretell.operators.conform import is_null

# ---- fixed values --------------------------------------------------------------------
DELIMITERS = "-,;:|\t"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
TRUTH = ("true", "false")
SCRIPTS = {  # languages told by their letters; the others are told by their stop words
    "cjk": r"[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]",
    "greek": r"[^\p{IsGreek}]",
    "armenian": r"[^\p{IsArmenian}]",
    "thai": r"[^\p{IsThai}]",
    "hindi": r"[^\p{IsDevanagari}]",
    "persian": r"[^پچژگ]",
    "arabic": r"[^\p{IsArabic}]",
}
LETTERS = r"[^\p{L}]"
ALPHABETS = {  # letters of the languages told by stop words, besides a to z
    "danish": "æøåéü", "dutch": "éëïöüèêó", "english": "éï", "finnish": "äöå", "french": "àâæçéèêëîïôœùûüÿ", "german": "äöüß",
    "hungarian": "áéíóöőúüű", "italian": "àèéìíîòóùú", "norwegian": "æøåéòôèü", "portuguese": "áâãàçéêíóôõúü", "russian": "а-яё",
    "spanish": "áéíñóúü", "swedish": "åäöéü", "turkish": "çğıöşüâîûi̇",
}
NEEDED = {"russian": "ыэё", "portuguese": "ãõç"}  # letters that a neighbour with the same alphabet does not use
# --------------------------------------------------------------------------------------
MIN_SCRIPT_SHARE = 0.5
MIN_PERSIAN_SHARE = 0.01  # of Arabic letters; these four letters are not used in Arabic
MIN_STOP_WORD_SHARE = 0.12
MIN_LEAD = 1.15  # stop words of the best language by those of the next
MAX_FOREIGN_SHARE = 0.01  # of letters that the language does not use
MIN_NEEDED_SHARE = 0.005

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FIXED = {T.BooleanType: S.BOOLEAN, T.FloatType: S.DECIMAL, T.DoubleType: S.DECIMAL, T.DecimalType: S.DECIMAL}
_AS_STRING = (T.TimestampType, T.TimestampNTZType, T.DateType, T.DayTimeIntervalType, T.YearMonthIntervalType,
              T.BinaryType, T.NullType)


def sampled(df: DataFrame, size: int, seed: int = 7) -> DataFrame:
    """About ``size`` rows, each drawn with the same chance; only where the caller asks for a sample."""
    rows = df.count()
    return df if rows <= size else df.sample(size / rows, seed)


def _int_or_string(low: Column, high: Column) -> Column:
    return F.when((low >= S.INT_MIN) & (high <= S.INT_MAX), S.INT).otherwise(S.STRING)


def _type(df: DataFrame, name: str) -> Column:
    """Schema type of a column as an aggregate expression."""
    kind, c = df.schema[name].dataType, F.col(name)
    filled = F.count_if(~is_null(df, name))
    if isinstance(kind, _WHOLE):
        inferred = _int_or_string(F.min(c), F.max(c))
    elif type(kind) in _FIXED:
        inferred = F.lit(_FIXED[type(kind)])
    elif isinstance(kind, _AS_STRING):
        inferred = F.lit(S.STRING)
    elif isinstance(kind, T.StringType):
        number = F.trim(c).try_cast("decimal(38,0)")
        whole = F.count_if(c.rlike(WHOLE_NUMBER))
        inferred = (
            # digits beyond decimal(38,0) give no number; they are out of range all the same
            F.when(whole == filled, F.when(F.count(number) == filled, _int_or_string(F.min(number), F.max(number)))
                   .otherwise(S.STRING))
            .when(F.count_if(c.rlike(NUMBER)) == filled, S.DECIMAL)
            .when(F.count_if(F.lower(F.trim(c)).isin(*TRUTH)) == filled, S.BOOLEAN)
            .otherwise(S.TEXT)
        )
    else:
        raise S.SchemaError(f"column {name!r} has type {kind.simpleString()}, which no schema type covers")
    return F.when(filled == 0, S.STRING).otherwise(inferred)


def column_profile(df: DataFrame) -> DataFrame:
    """``(column, type, nullable, n_rows, n_null)`` of every column from one aggregation."""
    entries = [
        F.struct(
            F.lit(name).alias("column"), _type(df, name).alias("type"),
            (F.count_if(is_null(df, name)) > 0).alias("nullable"),
            F.count("*").alias("n_rows"), F.count_if(is_null(df, name)).alias("n_null"),
        )
        for name in df.columns
    ]
    return df.agg(F.array(*entries).alias("c")).select(F.inline("c"))


def infer_types(df: DataFrame, sample: int | None = None) -> dict:
    df = sampled(df, sample) if sample else df
    return {r["column"]: r["type"] for r in column_profile(df).collect()}  # one row per column


def delimiter_of(value: Column) -> Column:
    """The delimiter that a value shows, a space if only that, or null.

    Blanks next to a delimiter belong to it.  A delimiter counts if it occurs at least as
    often as the other blanks; of several the most frequent, then the first in the list.
    """
    v = F.btrim(value, F.lit(" "))
    counts = []
    for d in DELIMITERS:
        tight = F.regexp_replace(v, f" *[{d}] *", d.replace("\\", "\\\\"))
        n = F.length(tight) - F.length(F.replace(tight, F.lit(d), F.lit("")))
        counts.append(F.when((n > 0) & (n >= F.regexp_count(tight, F.lit(" +"))), n).otherwise(F.lit(0)))
    most = F.greatest(*counts)
    first = F.coalesce(*[F.when((n > 0) & (n == most), F.lit(d)) for d, n in zip(DELIMITERS, counts)])
    return F.coalesce(first, F.when(F.contains(value, F.lit(" ")), F.lit(" ")))


def delimiter_counts(df: DataFrame, column: str, sample: int | None = None) -> DataFrame:
    """``(delimiter, n)``: how many values show each delimiter (null: none)."""
    values = df.select(F.col(column).cast("string").alias("v")).where(F.col("v").isNotNull())
    values = sampled(values, sample) if sample else values
    return values.groupBy(delimiter_of(F.col("v")).alias("delimiter")).agg(F.count("*").alias("n"))


def infer_delimiter(df: DataFrame, column: str, sample: int | None = None) -> str | None:
    """The most common delimiter; ties go to the first in character order."""
    best = (
        delimiter_counts(df, column, sample)
        .orderBy(F.col("n").desc(), F.col("delimiter").asc_nulls_last()).limit(1).first()
    )
    return best["delimiter"] if best else None


def stop_word_table(spark) -> DataFrame:
    """``(word, lang)`` of all built-in lists: fixed size, some 2500 rows."""
    rows = [(w.lower(), lang) for lang in STOP_WORD_LANGUAGES for w in set(default_stop_words(lang))]
    return spark.createDataFrame(rows, "word string, lang string")


def language_hits(df: DataFrame, column: str, keys: list = ()) -> DataFrame:
    """``(*keys, lang, hits)``: stop words of each language; only they leave the scan's tasks."""
    found = df.select(*keys, F.explode(words(F.col(column))).alias("word"))
    stop = F.broadcast(stop_word_table(df.sparkSession))
    return found.join(stop, "word").groupBy(*keys, "lang").agg(F.count("*").alias("hits"))


def infer_language(df: DataFrame, column: str) -> str | None:
    """The language of a text column, or None if nothing stands out."""
    c = F.col(column)
    measures = [F.sum(F.length(F.regexp_replace(c, rule, ""))).alias(name) for name, rule in SCRIPTS.items()]
    row = df.agg(
        F.sum(F.length(F.regexp_replace(c, LETTERS, ""))).alias("letters"), F.sum(F.size(words(c))).alias("words"),
        *measures,
    ).first()
    if not row["letters"]:
        return None
    share = {name: (row[name] or 0) / row["letters"] for name in SCRIPTS}
    if share["arabic"] > MIN_SCRIPT_SHARE:
        return "persian" if share["persian"] > MIN_PERSIAN_SHARE else "arabic"
    for name in ("cjk", "greek", "armenian", "thai", "hindi"):
        if share[name] > MIN_SCRIPT_SHARE:
            return name
    best = language_hits(df, column).orderBy(F.col("hits").desc(), "lang").limit(2).collect()
    if not best or best[0]["hits"] < MIN_STOP_WORD_SHARE * row["words"]:
        return None
    if len(best) > 1 and best[0]["hits"] < MIN_LEAD * best[1]["hits"]:
        return None
    lang = best[0]["lang"]
    lower = F.regexp_replace(F.lower(c), LETTERS, "")
    latin = "" if lang == "russian" else "a-z"
    needed = NEEDED.get(lang, "")
    letters = df.agg(
        F.sum(F.length(F.regexp_replace(lower, f"[{latin}{ALPHABETS[lang]}]", ""))).alias("foreign"),
        F.sum(F.length(lower) - F.length(F.regexp_replace(lower, f"[{needed or ALPHABETS[lang]}]", ""))).alias("needed"),
    ).first()
    if letters["foreign"] > MAX_FOREIGN_SHARE * row["letters"]:
        return None
    if needed and letters["needed"] < MIN_NEEDED_SHARE * row["letters"]:
        return None
    return lang


def infer_analyzer(df: DataFrame, column: str, sample: int | None = None) -> S.Analyzer | None:
    """The delimiter that most values show; where that is a space, the language, else white space."""
    values = df.select(column).where(F.col(column).isNotNull())
    values = sampled(values, sample) if sample else values
    delimiter = infer_delimiter(values, column)
    if delimiter is None:
        return None
    if delimiter != " ":
        return S.Delimiter(delimiter)
    return S.Alias(infer_language(values, column) or "whitespace")


def infer_column(df: DataFrame, column: str, sample: int | None = None) -> S.Column:
    return infer_schema(df.select(column), analyzer_sample=sample).columns[column]


def infer_schema(df: DataFrame, sample: int | None = None, analyzer_sample: int | None = None) -> S.Table:
    """Types and nulls from one aggregation, then one pass per text column for its analyzer.

    All rows decide, unless the caller asks for a sample: ``sample`` rows for the types
    (nulls always come from all rows), ``analyzer_sample`` values for the analyzers.
    """
    profile = {r["column"]: r for r in column_profile(df).collect()}
    types = infer_types(df, sample) if sample else {n: r["type"] for n, r in profile.items()}
    columns = {}
    for name in df.columns:
        kind, found = types[name], None
        if kind == S.TEXT:
            found = infer_analyzer(df, name, analyzer_sample)
            kind = S.TEXT if found else S.STRING
        columns[name] = S.Column(kind, profile[name]["nullable"], analyzer=found)
    return S.Table(columns)
