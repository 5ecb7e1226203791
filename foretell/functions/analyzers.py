"""Text analyzers as native expressions: ``Column -> array<string>``."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell import schema as S

# fixed values: token pattern, white space to trim, languages with a Spark stop word list
WORD = r"([\p{L}\p{N}\p{M}]+)"
BLANKS = " \t\r\n"
STOP_WORD_LANGUAGES = (
    "danish", "dutch", "english", "finnish", "french", "german", "hungarian",
    "italian", "norwegian", "portuguese", "russian", "spanish", "swedish", "turkish",
)


def default_stop_words(language: str) -> list:
    if language not in STOP_WORD_LANGUAGES:
        raise ValueError(f"there is no default stop word list for {language!r}")
    return StopWordsRemover.loadDefaultStopWords(language)


def _not_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t != "")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used.

    Inside a lambda Spark would compute an outer expression again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _grams(items: Column, lo: int, hi: int, separator: str) -> Column:
    """All windows of lo..hi items, joined; a size beyond the length gives none.

    Each window starts at an item and takes the others by position, so the work is linear in the length.
    """

    def of_size(x, n):
        if n == 1:
            return x
        starts = F.slice(x, F.lit(1), F.greatest(F.size(x) - (n - 1), F.lit(0)))
        return F.transform(starts, lambda t, i: F.concat_ws(separator, t, *[F.get(x, i + j) for j in range(1, n)]))

    whole = F.coalesce(items, F.array().cast("array<string>"))
    return once(whole, lambda x: F.concat(*[of_size(x, n) for n in range(lo, hi + 1)]))


def _letter_pairs(tokens: Column) -> Column:
    """Adjacent pairs of letters of each token, as these scripts do not divide words; one letter stays."""
    def pairs(t):
        return F.when(F.length(t) < 2, F.array(t)).otherwise(
            F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, F.lit(2))))

    return F.flatten(F.transform(tokens, pairs))


def analyze(text: Column | str, analyzer) -> Column:
    """Tokens of ``text``, in order and with repetitions; null stays null."""
    text = F.col(text) if isinstance(text, str) else text
    a = S.analyzer(analyzer)
    # equal analyzers give equal tokens
    if a == S.Alias("whitespace"):
        return _not_empty(F.split(text, r"\s+"))
    if isinstance(a, S.Alias):
        if a.name == "standard":
            return words(text)
        a = S.Language(a.name)
    if isinstance(a, S.Delimiter):
        quoted = r"\Q" + a.delimiter.replace(r"\E", r"\E\\E\Q") + r"\E"
        parts = F.split(text, quoted)
        if a.trim:
            parts = F.transform(parts, lambda t: F.btrim(t, F.lit(BLANKS)))
        return _not_empty(parts)
    if isinstance(a, S.Language):
        drop = [w.lower() for w in (*a.stop_words, *a.key_words)]
        if a.use_default_stop_words:
            drop += default_stop_words(a.language)
        found = _letter_pairs(words(text)) if a.language == "cjk" else words(text)
        return F.filter(found, lambda t: ~t.isin(drop)) if drop else found
    if isinstance(a, S.CharNGram):
        return _grams(_not_empty(F.split(text, "")), a.lo, a.hi, "")
    if isinstance(a, S.TokenNGram):
        return _grams(analyze(text, a.source), a.lo, a.hi, a.separator)
    raise TypeError(f"not an analyzer: {analyzer!r}")


def tokens(df: DataFrame, key: str, column: str, analyzer=None) -> DataFrame:
    """Token table ``(key, token)``: the distinct tokens of each row."""
    a = analyzer if analyzer is not None else S.analyzer_of(df, column)
    return df.select(key, F.explode(F.array_distinct(analyze(column, a))).alias("token"))
