"""Table schemas: column types, text analyzers, links and their JSON form.

This is small driver-side support code.  The operators read what they need (the
analyzer and the link of a column) from the metadata of the DataFrame's fields,
which :func:`attach` writes.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---- fixed values: type names, int32 bounds, name rule, languages -------------------
BOOLEAN, DECIMAL, INT, STRING, TEXT = "Boolean", "Decimal", "Int", "String", "Text"
INT_MIN, INT_MAX = -2147483648, 2147483647
NAME_RULE = re.compile(r'[^/".$\s]+')
LANGUAGES = {
    "ar": "arabic", "bg": "bulgarian", "ca": "catalan", "cjk": "cjk", "cs": "czech",
    "da": "danish", "de": "german", "el": "greek", "en": "english", "es": "spanish",
    "eu": "basque", "fa": "persian", "fi": "finnish", "fr": "french", "ga": "irish",
    "gl": "galician", "hi": "hindi", "hu": "hungarian", "hy": "armenian",
    "id": "indonesian", "it": "italian", "lv": "latvian", "nl": "dutch",
    "no": "norwegian", "pt": "portuguese", "pt-br": "brazilian", "ro": "romanian",
    "ru": "russian", "sv": "swedish", "th": "thai", "tr": "turkish",
}
# -------------------------------------------------------------------------------------

SPARK_TYPES = {
    BOOLEAN: T.BooleanType(),
    DECIMAL: T.DoubleType(),
    INT: T.IntegerType(),
    STRING: T.StringType(),
    TEXT: T.StringType(),
}


class SchemaError(ValueError):
    """A schema, name or link that breaks the rules of the data model."""


def _only(obj, allowed: set, what: str) -> None:
    if not isinstance(obj, dict):
        raise SchemaError(f"{what} must be an object, got {obj!r}")
    extra = sorted(set(obj) - allowed)
    if extra:
        raise SchemaError(f"unknown properties of {what}: {extra}")


def check_name(name: str, what: str) -> str:
    if not isinstance(name, str) or not NAME_RULE.fullmatch(name):
        raise SchemaError(f"invalid {what} name {name!r}: no whitespace and none of / \" . $")
    return name


# ------------------------------------------------------------------------- analyzers


class Analyzer:
    """How a Text column is split into features.  Equal analyzers give equal tokens."""

    def identity(self) -> tuple:
        raise NotImplementedError

    def to_json(self):
        raise NotImplementedError

    def __eq__(self, other):
        return isinstance(other, Analyzer) and self.identity() == other.identity()

    def __hash__(self):
        return hash(self.identity())


@dataclass(frozen=True, eq=False)
class Alias(Analyzer):
    """``standard``, ``whitespace`` or the name (or ISO code) of a language."""

    name: str

    def __post_init__(self):
        if not isinstance(self.name, str):
            raise SchemaError("an analyzer alias is a string")
        name = self.name.lower().strip()
        name = LANGUAGES.get(name, name)
        if name not in {"standard", "whitespace", *LANGUAGES.values()}:
            raise SchemaError(f"unsupported analyzer alias {self.name!r}")
        object.__setattr__(self, "name", name)

    def identity(self):
        if self.name == "whitespace":
            return Delimiter(" ").identity()
        if self.name == "standard":
            return ("standard",)
        return Language(self.name).identity()

    def to_json(self):
        return self.name


@dataclass(frozen=True, eq=False)
class Language(Analyzer):
    """Words of a language without stop words and without key words."""

    language: str
    use_default_stop_words: bool = False
    stop_words: tuple = ()
    key_words: tuple = ()

    def __post_init__(self):
        name = self.language.lower().strip()
        name = LANGUAGES.get(name, name)
        if name not in LANGUAGES.values():
            raise SchemaError(f"unsupported language {self.language!r}")
        object.__setattr__(self, "language", name)
        object.__setattr__(self, "stop_words", tuple(self.stop_words))
        object.__setattr__(self, "key_words", tuple(self.key_words))

    def identity(self):
        return ("language", self.language, self.use_default_stop_words, self.stop_words, self.key_words)

    def to_json(self):
        return {
            "type": "language",
            "language": self.language,
            "useDefaultStopWords": self.use_default_stop_words,
            "customStopWords": list(self.stop_words),
            "customKeyWords": list(self.key_words),
        }


@dataclass(frozen=True, eq=False)
class Delimiter(Analyzer):
    delimiter: str
    trim: bool = True

    def __post_init__(self):
        if not isinstance(self.delimiter, str) or not self.delimiter:
            raise SchemaError("a delimiter is a non-empty string")

    def identity(self):
        return ("delimiter", self.delimiter, self.trim)

    def to_json(self):
        return {"type": "delimiter", "delimiter": self.delimiter, "trimWhitespace": self.trim}


def _check_gram(lo, hi):
    if not (isinstance(lo, int) and isinstance(hi, int)) or lo < 1 or hi < lo:
        raise SchemaError(f"n-gram sizes must satisfy 1 <= min <= max, got {lo!r}, {hi!r}")


@dataclass(frozen=True, eq=False)
class CharNGram(Analyzer):
    lo: int
    hi: int

    def __post_init__(self):
        _check_gram(self.lo, self.hi)

    def identity(self):
        return ("char-ngram", self.lo, self.hi)

    def to_json(self):
        return {"type": "char-ngram", "minGram": self.lo, "maxGram": self.hi}


@dataclass(frozen=True, eq=False)
class TokenNGram(Analyzer):
    source: Analyzer
    lo: int
    hi: int
    separator: str = " "

    def __post_init__(self):
        _check_gram(self.lo, self.hi)
        object.__setattr__(self, "source", analyzer(self.source))

    def identity(self):
        return ("token-ngram", self.source.identity(), self.lo, self.hi, self.separator)

    def to_json(self):
        return {
            "type": "token-ngram",
            "source": self.source.to_json(),
            "minGram": self.lo,
            "maxGram": self.hi,
            "tokenSeparator": self.separator,
        }


# JSON property -> constructor argument of every analyzer type
_ANALYZER_JSON = {
    "language": (Language, {"language": "language", "useDefaultStopWords": "use_default_stop_words",
                            "customStopWords": "stop_words", "customKeyWords": "key_words"}),
    "delimiter": (Delimiter, {"delimiter": "delimiter", "trimWhitespace": "trim"}),
    "char-ngram": (CharNGram, {"minGram": "lo", "maxGram": "hi"}),
    "token-ngram": (TokenNGram, {"source": "source", "minGram": "lo", "maxGram": "hi",
                                 "tokenSeparator": "separator"}),
}


def analyzer(obj) -> Analyzer:
    """An analyzer from its JSON form (a string alias or an object), or the analyzer itself."""
    if isinstance(obj, Analyzer):
        return obj
    if isinstance(obj, str):
        return Alias(obj)
    if not isinstance(obj, dict) or obj.get("type") not in _ANALYZER_JSON:
        raise SchemaError(f"not an analyzer: {obj!r}")
    make, names = _ANALYZER_JSON[obj["type"]]
    _only(obj, {"type", *names}, f"{obj['type']} analyzer")
    try:
        return make(**{names[k]: v for k, v in obj.items() if k != "type"})
    except TypeError as missing:
        raise SchemaError(f"incomplete {obj['type']} analyzer: {missing}") from missing


# ---------------------------------------------------------- columns, tables, database


@dataclass(frozen=True)
class Link:
    """Foreign key: the column holds values of ``table.column``."""

    table: str
    column: str

    def __post_init__(self):
        check_name(self.table, "table")
        check_name(self.column, "column")

    @classmethod
    def parse(cls, obj) -> "Link":
        if isinstance(obj, Link):
            return obj
        parts = obj.split(".") if isinstance(obj, str) else []
        if len(parts) != 2:
            raise SchemaError(f"a link has the form table.column, got {obj!r}")
        return cls(*parts)

    def to_json(self):
        return f"{self.table}.{self.column}"


@dataclass(frozen=True)
class Column:
    type: str
    nullable: bool = False
    link: Link | None = None
    analyzer: Analyzer | None = None

    def __post_init__(self):
        if self.type not in SPARK_TYPES:
            raise SchemaError(f"unknown data type {self.type!r}, expected one of {sorted(SPARK_TYPES)}")
        if not isinstance(self.nullable, bool):
            raise SchemaError("nullable is true or false")
        if self.link is not None:
            object.__setattr__(self, "link", Link.parse(self.link))
        if self.analyzer is not None:
            if self.type != TEXT:
                raise SchemaError(f"{self.type} does not support an analyzer")
            object.__setattr__(self, "analyzer", analyzer(self.analyzer))

    @classmethod
    def from_json(cls, obj) -> "Column":
        _only(obj, {"type", "nullable", "link", "analyzer"}, "column")
        if "type" not in obj:
            raise SchemaError("a column needs a type")
        return cls(obj["type"], obj.get("nullable", False), obj.get("link"), obj.get("analyzer"))

    def to_json(self) -> dict:
        out = {"type": self.type, "nullable": self.nullable}
        if self.link:
            out["link"] = self.link.to_json()
        if self.analyzer:
            out["analyzer"] = self.analyzer.to_json()
        return out

    def metadata(self) -> dict:
        out = {"type": self.type, "nullable": self.nullable}
        if self.link:
            out["link"] = self.link.to_json()
        if self.analyzer:
            out["analyzer"] = json.dumps(self.analyzer.to_json())
        return out


@dataclass(frozen=True)
class Table:
    columns: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.columns:
            raise SchemaError("a table has at least one column")
        for name in self.columns:
            check_name(name, "column")

    @classmethod
    def from_json(cls, obj) -> "Table":
        _only(obj, {"type", "columns"}, "table")
        if obj.get("type") != "table" or not isinstance(obj.get("columns"), dict):
            raise SchemaError("a table schema has type 'table' and an object of columns")
        return cls({name: Column.from_json(c) for name, c in obj["columns"].items()})

    def to_json(self) -> dict:
        return {"type": "table", "columns": {n: c.to_json() for n, c in self.columns.items()}}

    @property
    def links(self) -> dict:
        return {n: c.link for n, c in self.columns.items() if c.link}

    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(n, SPARK_TYPES[c.type], c.nullable, c.metadata()) for n, c in self.columns.items()]
        )


@dataclass(frozen=True)
class Database:
    tables: dict = field(default_factory=dict)

    def __post_init__(self):
        for name in self.tables:
            check_name(name, "table")

    @classmethod
    def from_json(cls, obj) -> "Database":
        _only(obj, {"schema"}, "database")
        if not isinstance(obj.get("schema"), dict):
            raise SchemaError("a database schema is an object of tables under 'schema'")
        return cls({name: Table.from_json(t) for name, t in obj["schema"].items()})

    def to_json(self) -> dict:
        return {"schema": {n: t.to_json() for n, t in self.tables.items()}}

    def check_links(self) -> None:
        for table, schema in self.tables.items():
            for column, link in schema.links.items():
                if link.table not in self.tables or link.column not in self.tables[link.table].columns:
                    raise SchemaError(f"{table}.{column} links to {link.to_json()}, which does not exist")

    def reachable(self, table: str) -> list:
        """Own columns, then ``link column.field`` for every linked table, each part sorted."""
        own = self.tables[table]
        linked = [
            f"{name}.{column}"
            for name, link in sorted(own.links.items())
            for column in sorted(self.tables[link.table].columns)
        ]
        return sorted(own.columns) + linked


# ------------------------------------------------------------------ DataFrame metadata


def attach(df: DataFrame, schema: Table | dict) -> DataFrame:
    """Write type, analyzer and link of each column into the field metadata of ``df``."""
    columns = schema.columns if isinstance(schema, Table) else {n: Column.from_json(c) for n, c in schema.items()}
    for name, column in columns.items():
        if name in df.columns:
            df = df.withMetadata(name, column.metadata())
    return df


def analyzer_of(df: DataFrame, name: str) -> Analyzer | None:
    found = df.schema[name].metadata.get("analyzer")
    return analyzer(json.loads(found)) if found else None


def link_of(df: DataFrame, name: str) -> Link | None:
    if name not in df.columns:
        raise ValueError(f"no column {name!r}, there are {df.columns}")
    found = df.schema[name].metadata.get("link")
    return Link.parse(found) if found else None
