"""foretell: predictive queries and table preparation on Spark."""

from foretell.plans.engine import Engine
from foretell.schema import (
    Alias, CharNGram, Column, Database, Delimiter, Language, Link, SchemaError, Table, TokenNGram,
)

__all__ = [
    "Alias", "CharNGram", "Column", "Database", "Delimiter", "Engine", "Language", "Link", "SchemaError", "Table",
    "TokenNGram",
]
