"""``where`` propositions as Spark conditions.

A proposition is a plain dict.  Fields come first (``{"id": {"$gte": 5}}``) or the
operator does (``{"$exists": "name"}``); several entries form a conjunction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.analyzers import analyze

INDEX = "_index"

_COMPARE = {
    "$gte": lambda c, v: c >= v,
    "$gt": lambda c, v: c > v,
    "$lte": lambda c, v: c <= v,
    "$lt": lambda c, v: c < v,
}


def column_name(path: str) -> str:
    """Result column of a field: ``$index`` is the row position, a dot follows a link."""
    return INDEX if path == "$index" else path.replace(".", "__")


def paths(where: dict | None) -> list:
    """All fields a proposition mentions, those it compares with included."""
    found = []
    for name, value in (where or {}).items():
        if name == "$exists":
            found.append(value)
            continue
        found.append(name)
        if isinstance(value, dict):
            inner = [value, *value.values()]
            found += [v["$get"] for v in inner if isinstance(v, dict) and "$get" in v]
    return found


def match_all(df: DataFrame, path: str, text: str) -> Column:
    """Every token of the analysed ``text`` occurs among the tokens of the field."""
    name = column_name(path)
    a = S.analyzer_of(df, name) or S.Alias("standard")
    wanted = F.array_distinct(analyze(F.lit(text), a))
    return F.size(F.array_except(wanted, analyze(F.col(name), a))) == 0


def _value(v) -> Column:
    if isinstance(v, dict):
        if set(v) != {"$get"}:
            raise ValueError(f"unsupported value {v!r}")
        return F.col(column_name(v["$get"]))
    return F.lit(v)


def proposition(df: DataFrame, path: str, value) -> Column:
    c = F.col(column_name(path))
    if path == "$exists":
        return F.col(column_name(value)).isNotNull()
    if value is None:
        return c.isNull()
    if not isinstance(value, dict) or set(value) == {"$get"}:
        return c == _value(value)
    parts = []
    for op, v in value.items():
        if op in _COMPARE:
            parts.append(_COMPARE[op](c, _value(v)))
        elif op == "$match":
            parts.append(match_all(df, path, v))
        elif op == "$mod":
            divisor, remainder = v
            parts.append(F.pmod(c, F.lit(divisor)) == remainder)
        elif op == "$exists":
            parts.append(c.isNotNull() if v else c.isNull())
        else:
            raise ValueError(f"unsupported operator {op!r} on {path!r}")
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def condition(df: DataFrame, where: dict | None) -> Column:
    """The conjunction as one condition; link paths must be bound to columns of ``df``."""
    parts = [proposition(df, path, value) for path, value in (where or {}).items()]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)
