"""SQL that must give the rows of the registered queries, for DuckDB.

The predictive statements are the textbook form: every (query, class, feature) triple is
scored.  The Spark operators never form those triples, so this is an independent check.
"""

from __future__ import annotations

from pyspark import SparkContext


from foretell.functions.analyzers import STOP_WORD_LANGUAGES, default_stop_words
from foretell.operators.infer import DELIMITERS

WS = r"list_filter(string_split_regex({0}, '\s+'), lambda t: t <> '')"
STD = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}\p{{M}}]+')"


def words(column: str) -> str:
    return STD.format(column)


def stop_words(language: str) -> list:
    """Spark's default list, as the operators load it; needs a running session."""
    return sorted({w.strip().lower() for w in default_stop_words(language)} - {""})


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def value(path: str, expr: str | None = None) -> str:
    """Features of a plain field."""
    e = expr or path
    return f"CASE WHEN {e} IS NULL THEN CAST([] AS VARCHAR[]) ELSE ['{path}=' || CAST({e} AS VARCHAR)] END"


def tokens(path: str, form: str, expr: str | None = None) -> str:
    """Features of a text field."""
    split = form.format(expr or path)
    return f"list_transform(list_distinct({split}), lambda t: '{path}:' || t)"


def features(*parts: str) -> str:
    return "(" + " || ".join(f"({p})" for p in parts) + ")"


def ranked(score: str = "s", size: str = "size", h: str = "h", name: str = "c", over: str = "") -> str:
    return (f"CAST(row_number() OVER ({over} ORDER BY round({score}, 9) DESC, "
            f"CASE WHEN {h} >= 2 THEN -{size} ELSE {size} END DESC, {name}) AS INTEGER)")


def predict_sql(train: str, evidence: list, target: str, limit: int = 10) -> str:
    """CTEs ending in ``answer(c, size, h, s, p, rank)``; ``train`` selects (c, f)."""
    listed = ", ".join(quoted(e) for e in evidence)
    return f"""
WITH rows_ AS (SELECT * FROM ({train}) WHERE c IS NOT NULL),
ev AS (SELECT unnest(CAST([{listed}] AS VARCHAR[])) AS t),
cls AS (SELECT c, count(*) AS size FROM rows_ GROUP BY c),
tot AS (SELECT count(*) AS k, sum(size) AS n FROM cls),
seen AS (SELECT c, t, count(*) AS n FROM rows_, ev WHERE list_contains(f, t) GROUP BY c, t),
part_ AS (SELECT cls.c, cls.size, ev.t, coalesce(seen.n, 0) AS n
          FROM cls CROSS JOIN ev LEFT JOIN seen ON seen.c = cls.c AND seen.t = ev.t),
add_ AS (SELECT c, sum(ln((n + 1.0E0) / (size + 2.0E0))) AS a FROM part_ GROUP BY c),
scored AS (SELECT cls.c, cls.size, {len(evidence)} AS h,
                  ln((cls.size + 1.0E0) / (tot.n + tot.k)) + coalesce(add_.a, 0) AS s
           FROM cls CROSS JOIN tot LEFT JOIN add_ ON add_.c = cls.c),
soft AS (SELECT *, exp(s - max(s) OVER ()) AS e FROM scored),
answer AS (SELECT c, size, h, s, e / sum(e) OVER () AS p, {ranked()} AS rank FROM soft QUALIFY rank <= {limit})
"""


def predict_text_sql(rows_: str, evidence: list, limit: int) -> str:
    """Yes/no model of every token; ``rows_`` selects (cs, f) with the tokens of a row."""
    listed = ", ".join(quoted(e) for e in evidence)
    return f"""
WITH rows_ AS (SELECT * FROM ({rows_}) WHERE cs IS NOT NULL),
ev AS (SELECT unnest(CAST([{listed}] AS VARCHAR[])) AS t),
each_ AS (SELECT unnest(cs) AS c, f FROM rows_),
cls AS (SELECT c, count(*) AS size, (SELECT count(*) FROM rows_) AS n FROM each_ GROUP BY c),
nf AS (SELECT t, (SELECT count(*) FROM rows_ WHERE list_contains(f, t)) AS nf FROM ev),
seen AS (SELECT c, t, count(*) AS k FROM each_, ev WHERE list_contains(f, t) GROUP BY c, t),
part_ AS (SELECT cls.c, cls.size, cls.n, nf.nf, coalesce(seen.k, 0) AS k
          FROM cls CROSS JOIN nf LEFT JOIN seen ON seen.c = cls.c AND seen.t = nf.t),
add_ AS (SELECT c, sum(ln((k + 1.0E0) / (size + 2.0E0)) - ln((nf - k + 1.0E0) / (n - size + 2.0E0))) AS a
         FROM part_ GROUP BY c),
scored AS (SELECT cls.c, cls.size, {len(evidence)} AS h,
                  ln((cls.size + 1.0E0) / (cls.n - cls.size + 1.0E0)) + coalesce(add_.a, 0) AS s
           FROM cls LEFT JOIN add_ ON add_.c = cls.c),
answer AS (SELECT c, 1.0E0 / (1.0E0 + exp(-s)) AS p, {ranked()} AS rank FROM scored QUALIFY rank <= {limit})
"""


def batch_sql(train: str, asked: str, k: int) -> str:
    """CTEs ending in ``answer(qid, c, p, rank)``; ``train`` selects (c, f), ``asked`` (qid, f)."""
    return f"""
WITH rows_ AS (SELECT * FROM ({train}) WHERE c IS NOT NULL),
asked_ AS ({asked}),
evid AS (SELECT qid, unnest(f) AS t FROM asked_),
cls AS (SELECT c, count(*) AS size FROM rows_ GROUP BY c),
tot AS (SELECT count(*) AS k, sum(size) AS n FROM cls),
seen AS (SELECT c, t, count(*) AS n FROM (SELECT c, unnest(f) AS t FROM rows_) GROUP BY c, t),
add_ AS (SELECT evid.qid, cls.c, sum(ln((coalesce(seen.n, 0) + 1.0E0) / (cls.size + 2.0E0))) AS a
         FROM evid CROSS JOIN cls LEFT JOIN seen ON seen.c = cls.c AND seen.t = evid.t GROUP BY evid.qid, cls.c),
scored AS (SELECT asked_.qid, cls.c, cls.size, len(asked_.f) AS h,
                  ln((cls.size + 1.0E0) / (tot.n + tot.k)) + coalesce(add_.a, 0) AS s
           FROM asked_ CROSS JOIN cls CROSS JOIN tot LEFT JOIN add_ ON add_.qid = asked_.qid AND add_.c = cls.c),
soft AS (SELECT *, exp(s - max(s) OVER (PARTITION BY qid)) AS e FROM scored),
answer AS (SELECT qid, c, e / sum(e) OVER (PARTITION BY qid) AS p, {ranked(over='PARTITION BY qid')} AS rank
           FROM soft QUALIFY rank <= {k})
"""


def batch_text_sql(train: str, asked: str, k: int) -> str:
    """The same for the tokens of a text field; ``train`` selects (cs, f)."""
    return f"""
WITH rows_ AS (SELECT * FROM ({train}) WHERE cs IS NOT NULL),
asked_ AS ({asked}),
evid AS (SELECT qid, unnest(f) AS t FROM asked_),
each_ AS (SELECT unnest(cs) AS c, f FROM rows_),
cls AS (SELECT c, count(*) AS size, (SELECT count(*) FROM rows_) AS n FROM each_ GROUP BY c),
nf AS (SELECT t, count(*) AS nf FROM (SELECT unnest(f) AS t FROM rows_) GROUP BY t),
seen AS (SELECT c, t, count(*) AS k FROM (SELECT c, unnest(f) AS t FROM each_) GROUP BY c, t),
add_ AS (SELECT evid.qid, cls.c,
                sum(ln((coalesce(seen.k, 0) + 1.0E0) / (cls.size + 2.0E0))
                    - ln((coalesce(nf.nf, 0) - coalesce(seen.k, 0) + 1.0E0) / (cls.n - cls.size + 2.0E0))) AS a
         FROM evid CROSS JOIN cls LEFT JOIN seen ON seen.c = cls.c AND seen.t = evid.t
         LEFT JOIN nf ON nf.t = evid.t GROUP BY evid.qid, cls.c),
scored AS (SELECT asked_.qid, cls.c, cls.size, len(asked_.f) AS h,
                  ln((cls.size + 1.0E0) / (cls.n - cls.size + 1.0E0)) + coalesce(add_.a, 0) AS s
           FROM asked_ CROSS JOIN cls LEFT JOIN add_ ON add_.qid = asked_.qid AND add_.c = cls.c),
answer AS (SELECT qid, c, 1.0E0 / (1.0E0 + exp(-s)) AS p, {ranked(over='PARTITION BY qid')} AS rank
           FROM scored QUALIFY rank <= {k})
"""


def evaluate_sql(answer: str, actual: str, train: str) -> str:
    """Accuracy of ``answer`` against ``actual(qid, cs)``; ``train`` counts the training rows."""
    return f"""{answer}
SELECT round(sum(CASE WHEN list_contains(a.cs, w.c) THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE), 6) AS accuracy,
       count(*) AS test_samples, ({train}) AS train_samples
FROM ({actual}) a LEFT JOIN answer w ON w.qid = a.qid"""


def relate_sql(rows_: str, limit: int | None) -> str:
    """``rows_`` selects (cond, f)."""
    cell = "({0} + 0.5E0)"
    a, b = cell.format("f_on_cond"), cell.format("f_on_not_cond")
    c, d = cell.format("(cond - f_on_cond)"), cell.format("(n - cond - f_on_not_cond)")
    t = "(n + 2.0E0)"

    def term(x, row, column):
        return f"{x} / {t} * ln({x} * {t} / (({row}) * ({column})))"

    mi = " + ".join([term(a, f"{a} + {b}", f"{a} + {c}"), term(b, f"{a} + {b}", f"{b} + {d}"),
                     term(c, f"{c} + {d}", f"{a} + {c}"), term(d, f"{c} + {d}", f"{b} + {d}")])
    cut = f"QUALIFY row_number() OVER (ORDER BY round(mi, 9) DESC, feature) <= {limit}" if limit else ""
    return f"""
WITH rows_ AS ({rows_}),
tot AS (SELECT count(*) AS n, count(*) FILTER (cond) AS cond FROM rows_),
cnt AS (SELECT feature, count(*) AS f, count(*) FILTER (c) AS f_on_cond, count(*) FILTER (NOT c) AS f_on_not_cond
        FROM (SELECT cond AS c, unnest(f) AS feature FROM rows_) GROUP BY feature),
m AS (SELECT cnt.*, tot.n, tot.cond, {mi} AS mi FROM cnt CROSS JOIN tot)
SELECT feature, n, f, cond, f_on_cond, f_on_not_cond, round((f + 1.0E0) / (n + 2.0E0), 6) AS p,
       round((f_on_cond + 1.0E0) / (cond + 2.0E0), 6) AS p_on_cond,
       round((f_on_not_cond + 1.0E0) / (n - cond + 2.0E0), 6) AS p_on_not_cond,
       round(((f_on_cond + 1.0E0) / (cond + 2.0E0)) / ((f + 1.0E0) / (n + 2.0E0)), 6) AS lift, round(mi, 8) AS mi
FROM m {cut}"""


def similarity_sql(asked: list, parts: str) -> str:
    """CTE ``scores(doc_id, score)`` over ``documents``."""
    listed = ", ".join(quoted(a) for a in asked)
    return f"""
WITH d AS (SELECT doc_id, {parts} AS f FROM documents),
post AS (SELECT doc_id, unnest(f) AS t FROM d),
dfs AS (SELECT t, count(*) AS df FROM post GROUP BY t),
q AS (SELECT unnest([{listed}]) AS t),
n AS (SELECT count(*) AS n FROM documents),
qn AS (SELECT sqrt(sum(pow(ln((n + 1.0E0) / (coalesce(df, 0) + 1.0E0)) + 1, 2))) AS qn
       FROM q CROSS JOIN n LEFT JOIN dfs ON dfs.t = q.t),
w AS (SELECT doc_id, post.t, pow(ln((n + 1.0E0) / (df + 1.0E0)) + 1, 2) AS w
      FROM post JOIN dfs ON dfs.t = post.t CROSS JOIN n),
scores AS (SELECT doc_id, sum(CASE WHEN t IN (SELECT t FROM q) THEN w END) / (any_value(qn) * sqrt(sum(w))) AS score
           FROM w CROSS JOIN qn GROUP BY doc_id HAVING sum(CASE WHEN t IN (SELECT t FROM q) THEN w END) > 0)
"""


def recommend_rate_sql(rows_: str, limit: int) -> str:
    """CTE ``answer(x, p, rank)``; ``rows_`` selects (x, goal)."""
    return f"""
WITH r AS (SELECT x, (count(*) FILTER (goal) + 1.0E0) / (count(*) + 2.0E0) AS p FROM ({rows_}) WHERE x IS NOT NULL
           GROUP BY x),
answer AS (SELECT *, CAST(row_number() OVER (ORDER BY round(p, 9) DESC, CAST(x AS VARCHAR)) AS INTEGER) AS rank FROM r
           QUALIFY rank <= {limit})
"""


def token_counts(source: str, key: str, listed: str) -> str:
    return f"""SELECT token, count(*) AS n, min({key}) AS first_key
FROM (SELECT {key}, unnest(list_distinct({listed})) AS token FROM {source}) GROUP BY token"""


def char_grams(column: str, lo: int, hi: int) -> str:
    sizes = [
        f"CASE WHEN length({column}) >= {n} THEN list_transform(range(1, length({column}) - {n} + 2), "
        f"lambda i: substring({column}, i, {n})) ELSE [] END"
        for n in range(lo, hi + 1)
    ]
    return "(" + " || ".join(sizes) + ")"


def token_grams(listed: str, lo: int, hi: int, separator: str) -> str:
    sizes = [
        f"CASE WHEN len({listed}) >= {n} THEN list_transform(range(1, len({listed}) - {n} + 2), "
        f"lambda i: array_to_string(({listed})[i:i + {n - 1}], '{separator}')) ELSE [] END"
        for n in range(lo, hi + 1)
    ]
    return "(" + " || ".join(sizes) + ")"


NULLED = "(SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)"
PART_TRAIN = f"SELECT p_type AS c, {features(tokens('p_name', WS), value('p_brand'))} AS f FROM part"
MIXED = """(SELECT event_id, ts, value, event_type, event_id * 1000000 AS big, CAST(user_id AS VARCHAR) AS int_text,
 event_id || '0000000000' AS big_text, event_id || '.5' AS decimal_text,
 CASE WHEN user_id > 75 THEN 'true' ELSE 'False' END AS bool_text, user_id > 75 AS flag,
 nullif(event_type, 'click') AS some_null, CAST(NULL AS VARCHAR) AS all_null,
 CASE WHEN user_id > 75 THEN CAST('nan' AS DOUBLE) ELSE value END AS some_nan FROM events)"""


def whole_type(column: str) -> str:
    return f"CASE WHEN min({column}) >= -2147483648 AND max({column}) <= 2147483647 THEN 'Int' ELSE 'String' END"


def text_type(column: str) -> str:
    return rf"""CASE WHEN count({column}) = 0 THEN 'String'
 WHEN count(*) FILTER (regexp_full_match({column}, '[+-]?\d+')) = count({column})
 THEN CASE WHEN min(try_cast({column} AS HUGEINT)) >= -2147483648 AND max(try_cast({column} AS HUGEINT)) <= 2147483647
      THEN 'Int' ELSE 'String' END
 WHEN count(*) FILTER (regexp_full_match({column}, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?')) = count({column})
 THEN 'Decimal'
 WHEN count(*) FILTER (lower({column}) IN ('true', 'false')) = count({column}) THEN 'Boolean' ELSE 'Text' END"""


def profile_sql(source: str, columns: dict) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {kind} AS type FROM {source} HAVING count(*) > 0" for name, kind in columns.items()
    )


def delimiter_sql(source: str, column: str) -> str:
    """``(delimiter, n)`` of the values of a column."""
    tight = ", ".join(f"regexp_replace(trim(v), ' *[{d}] *', '{d}', 'g') AS t{i}" for i, d in enumerate(DELIMITERS))
    n = "length(t{0}) - length(replace(t{0}, '{1}', ''))"
    counts = ", ".join(
        f"CASE WHEN {n.format(i, d)} > 0 AND {n.format(i, d)} >= len(regexp_extract_all(t{i}, ' +')) THEN {n.format(i, d)} ELSE 0 END AS n{i}"
        for i, d in enumerate(DELIMITERS))
    most = "greatest(" + ", ".join(f"n{i}" for i in range(len(DELIMITERS))) + ")"
    first = " ".join(f"WHEN n{i} > 0 AND n{i} = {most} THEN '{d}'" for i, d in enumerate(DELIMITERS))
    return (f"SELECT CASE {first} WHEN contains(v, ' ') THEN ' ' END AS delimiter, count(*) AS n FROM (SELECT v, {counts} FROM "
            f"(SELECT v, {tight} FROM (SELECT {column} AS v FROM {source} WHERE {column} IS NOT NULL))) GROUP BY 1")


def schema_of_text_sql(source: str, column: str) -> str:
    """Schema row of a text column; its values show no language."""
    best = f"(SELECT delimiter FROM ({delimiter_sql(source, column)}) ORDER BY n DESC, delimiter NULLS LAST LIMIT 1)"
    return (f"SELECT '{column}' AS \"column\", CASE WHEN k = 'Text' AND d IS NULL THEN 'String' ELSE k END AS type, nullable, "
            f"CASE WHEN k = 'Text' AND d = ' ' THEN 'whitespace' WHEN k = 'Text' THEN d END AS analyzer FROM ("
            f"SELECT {text_type(column)} AS k, count(*) FILTER ({column} IS NULL) > 0 AS nullable, {best} AS d FROM {source})")


def _dropped(drop) -> str:
    return f"list_filter({words('text')}, lambda t: t NOT IN ({', '.join(quoted(w) for w in drop)}))"


def _with_stop_words() -> dict:
    o = {"tok_language_default": token_counts("documents", "doc_id", _dropped(stop_words("english")))}
    pairs = ", ".join(f"({quoted(w)}, '{lang}')" for lang in STOP_WORD_LANGUAGES for w in stop_words(lang))
    o["infer_language"] = f"""
WITH stop(word, lang) AS (VALUES {pairs}),
t AS (SELECT doc_id, unnest({words('text')}) AS word FROM documents),
h AS (SELECT doc_id, stop.lang, count(*) AS hits FROM t JOIN stop ON stop.word = t.word GROUP BY doc_id, stop.lang)
SELECT doc_id, lang AS language, hits FROM h
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, lang DESC) = 1"""
    return o


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}

    # scan, search, links, order
    o["scan_parquet"] = "SELECT * FROM customer"
    o["table_size"] = "SELECT count(*) AS size FROM lineitem"
    o["query_page"] = "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10 OFFSET 20"
    o["deep_page"] = ("SELECT l_extendedprice, l_orderkey, l_linenumber, l_partkey FROM lineitem "
                      "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10 OFFSET (SELECT count(*) // 2 FROM lineitem)")
    o["query_all"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
    o["search_total"] = "SELECT count(*) AS total FROM orders WHERE o_orderstatus = 'F'"
    o["search_eq_and"] = ("SELECT p_partkey, p_name, p_brand, p_type FROM part "
                          "WHERE p_brand = 'Brand#2' AND p_type = 'PROMO'")
    o["search_match"] = (f"SELECT doc_id, lang, source FROM documents "
                         f"WHERE list_has_all({words('text')}, ['the', 'and'])")
    o["search_exists"] = f"SELECT o_orderkey, status FROM {NULLED} WHERE status IS NOT NULL"
    o["search_null"] = f"SELECT o_orderkey, o_orderpriority FROM {NULLED} WHERE status IS NULL"
    o["search_gte"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 250000"
    o["search_range"] = ("SELECT l_orderkey, l_quantity, l_discount FROM lineitem "
                         "WHERE l_quantity > 10 AND l_quantity <= 20 AND l_discount < 0.05E0")
    o["search_get"] = ("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey "
                       "WHERE l_quantity >= p_size")
    o["search_link"] = ("SELECT o_orderkey, c_name AS o_custkey__c_name, c_mktsegment AS o_custkey__c_mktsegment "
                        "FROM orders JOIN customer ON o_custkey = c_custkey "
                        "WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F'")
    o["select_link"] = ("SELECT o_orderkey, c_name AS o_custkey__c_name, c_nationkey AS o_custkey__c_nationkey "
                        "FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
    o["expand_links"] = ("SELECT orders.*, c_acctbal AS o_custkey__c_acctbal, c_custkey AS o_custkey__c_custkey, "
                         "c_mktsegment AS o_custkey__c_mktsegment, c_name AS o_custkey__c_name, "
                         "c_nationkey AS o_custkey__c_nationkey "
                         "FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
    o["row_index"] = ("SELECT o_orderkey, o_orderpriority, "
                      "row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS _index FROM orders")
    o["index_mod_split"] = ("SELECT * FROM (SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) - 1 "
                            "AS _index FROM events) WHERE _index % 10 = 0 AND _index >= 100")
    o["hits_json"] = ("SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS seg, "
                      "CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 2 ELSE 3 END AS BIGINT) AS n_fields FROM customer")

    # tokens
    def token_table(source, key, listed):
        return f"SELECT {key}, unnest(list_distinct({listed})) AS token FROM {source}"

    o["tok_whitespace"] = token_table("documents", "doc_id", WS.format("text"))
    o["tok_standard"] = token_table("documents", "doc_id", words("text"))
    o["tok_delimiter"] = token_table(
        "orders", "o_orderkey",
        "list_filter(list_transform(string_split(o_orderpriority, '-'), lambda t: trim(t)), lambda t: t <> '')")
    o["tok_delimiter_untrimmed"] = token_table(
        "documents", "doc_id", "list_filter(string_split(text, '.'), lambda t: t <> '')")
    o["tok_cjk"] = token_table("documents", "doc_id", (
        f"flatten(list_transform({words('text')}, lambda w: CASE WHEN length(w) < 2 THEN [w] "
        "ELSE list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) END))"))
    o["tok_language"] = token_table("documents", "doc_id", _dropped(["the", "and", "of", "is", "worthless"]))
    o["tok_char_ngram"] = token_counts("part", "p_partkey", char_grams("p_name", 2, 4))
    o["tok_char_ngram_accents"] = token_counts("documents", "doc_id", char_grams("text", 3, 3))
    o["tok_token_ngram"] = token_counts(f"(SELECT doc_id, {words('text')} AS w FROM documents)", "doc_id",
                                        token_grams("w", 1, 2, "_"))
    inner = token_grams(WS.format("p_name"), 1, 2, " ")
    o["tok_nested_ngram"] = token_table(f"(SELECT p_partkey, {inner} AS g FROM part)", "p_partkey",
                                        token_grams("g", 2, 2, "+"))

    # inference
    o["infer_types"] = profile_sql(MIXED, {
        "event_id": whole_type("event_id"), "ts": "'String'", "value": "'Decimal'",
        "event_type": text_type("event_type"), "big": whole_type("big"), "int_text": text_type("int_text"),
        "big_text": text_type("big_text"), "decimal_text": text_type("decimal_text"),
        "bool_text": text_type("bool_text"), "flag": "'Boolean'", "some_null": text_type("some_null"),
        "all_null": text_type("all_null"), "some_nan": "'Decimal'",
    })
    nulls = {c: f"{c} IS NULL" for c in ("event_id", "ts", "event_type", "big", "int_text", "big_text", "decimal_text",
                                         "bool_text", "flag", "some_null", "all_null")}
    nulls |= {c: f"{c} IS NULL OR isnan({c})" for c in ("value", "some_nan")}
    o["infer_nullability"] = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({n}) > 0 AS nullable, count(*) AS n_rows, "
        f"count(*) FILTER ({n}) AS n_null FROM {MIXED}" for c, n in nulls.items())
    o["infer_int_range"] = profile_sql(
        "(SELECT l_orderkey, l_linenumber, l_orderkey + 2147483647 AS above, -l_orderkey - 2147483648 AS below "
        "FROM lineitem)",
        {c: whole_type(c) for c in ("l_orderkey", "l_linenumber", "above", "below")})
    if SparkContext._active_spark_context is not None:  # the lists come from the running session
        o |= _with_stop_words()

    o["infer_delimiter"] = delimiter_sql("orders", "o_orderpriority")
    o["infer_schema"] = "\nUNION ALL ".join(
        [f"SELECT '{c}' AS \"column\", {kind} AS type, count(*) FILTER ({c} IS NULL) > 0 AS nullable, CAST(NULL AS VARCHAR) AS analyzer FROM part"
         for c, kind in (("p_partkey", whole_type("p_partkey")), ("p_size", whole_type("p_size")), ("p_retailprice", "'Decimal'"))]
        + [schema_of_text_sql("part", c) for c in ("p_name", "p_brand", "p_type")])

    kinds = {"l_linenumber": "Int", "l_quantity": "Decimal", "l_returnflag": "Text", "l_shipdate": "Text"}
    o["infer_sample"] = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS type" for c, k in kinds.items())
    o["comma_decimals"] = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, round(p_retailprice, 6) AS price FROM part"
    o["read_json"] = "SELECT c_custkey, c_name, c_acctbal, c_nationkey FROM customer"
    o["convert_file"] = ("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS DOUBLE) AS p_size, "
                         "CAST(trunc(p_retailprice) AS BIGINT) AS p_retailprice FROM part")
    o["null_counts"] = ("SELECT 'c_custkey' AS \"column\", count(*) FILTER (c_custkey IS NULL) AS nulls FROM customer UNION ALL "
                        "SELECT 'c_mktsegment', count(*) FILTER (c_mktsegment = 'MACHINERY') FROM customer UNION ALL "
                        "SELECT 'c_acctbal', count(*) FILTER (c_acctbal < 0) FROM customer")
    o["schema_diff"] = ("SELECT 'only_in_data' AS side, column_name AS \"column\" FROM (DESCRIBE part) "
                        "WHERE column_name NOT IN ('p_partkey', 'p_name') UNION ALL SELECT 'only_in_schema', 'p_colour'")

    # conform
    o["conform_int"] = ("SELECT l_orderkey, CAST(trunc(-l_extendedprice) AS INTEGER) AS negated, "
                        "CAST(trunc(l_quantity) AS INTEGER) AS text FROM lineitem")
    o["conform_string"] = ("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
                           "o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, "
                           "CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders")
    o["conform_double"] = ("SELECT o_orderkey, o_totalprice AS text, CAST(o_custkey AS DOUBLE) AS whole FROM orders")
    o["conform_bool"] = ("SELECT doc_id, quality = 1 AS quality, toxic = 1 AS toxic, toxic = 1 AS word FROM labels")
    o["conform_nan"] = ("SELECT event_id, round(CASE WHEN event_type <> 'click' THEN value END, 6) AS value FROM events")
    o["datetimes_to_string"] = "SELECT l_orderkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem"
    o["apply_functions"] = ("SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, "
                            "CAST(year(o_orderdate) AS VARCHAR) AS year, "
                            "CAST(year(o_orderdate) AS VARCHAR) || '/' || o_orderpriority AS label FROM orders")

    # tables and streaming
    o["append"] = "SELECT * FROM orders"
    o["delete_entries"] = ("SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders "
                           "WHERE NOT (o_orderstatus = 'F' AND o_totalprice >= 100000)")
    o["delete_places"] = f"SELECT * FROM ({o['delete_entries']}) WHERE o_orderkey % 7 <> 0"
    o["copy_table"] = "SELECT * FROM customer"
    o["create_column"] = "SELECT * REPLACE ('ANY' AS c_mktsegment), CAST(NULL AS DOUBLE) AS score FROM customer"
    o["delete_column"] = "SELECT * EXCLUDE (c_acctbal) FROM customer"
    o["optimize_table_curve"] = "SELECT * FROM orders"
    o["optimize_table"] = "SELECT * FROM lineitem"
    o["load_file"] = ("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, "
                      "o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority "
                      "FROM orders")
    o["quick_add_table"] = ("SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, "
                            "CAST(c_nationkey AS INTEGER) AS c_nationkey, round(c_acctbal, 6) AS c_acctbal, "
                            "c_mktsegment FROM customer")
    o["stream_ingest"] = ("SELECT CAST(event_id AS INTEGER) AS event_id, CAST(ts AS VARCHAR) AS ts, "
                          "CAST(user_id AS INTEGER) AS user_id, event_type, value, props FROM events")

    # prediction
    out = "SELECT '{0}' AS field, CAST(c AS VARCHAR) AS feature, round(p, 6) AS p, rank FROM answer"
    part_evidence = ["p_brand=Brand#2", "p_name:small", "p_name:ring"]
    o["feature_pairs"] = f"""SELECT feature, c AS class, count(*) AS n
FROM (SELECT c, unnest(f) AS feature FROM ({PART_TRAIN})) GROUP BY feature, c"""
    o["predict_field"] = predict_sql(PART_TRAIN, part_evidence, "p_type") + out.format("p_type")
    o["predict_prior"] = predict_sql("SELECT o_orderpriority AS c, CAST([] AS VARCHAR[]) AS f FROM orders", [],
                                     "o_orderpriority") + out.format("o_orderpriority")
    o["predict_text"] = predict_text_sql(
        f"SELECT list_distinct({WS.format('p_name')}) AS cs, {value('p_brand')} AS f FROM part",
        ["p_brand=Brand#2"], 20) + out.format("p_name")
    order_features = features(value("o_orderpriority"), value("o_orderstatus"))
    order_evidence = ["o_orderpriority=1-URGENT", "o_orderstatus=F"]
    o["predict_linked"] = predict_sql(
        f"SELECT c_mktsegment AS c, {order_features} AS f FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
        order_evidence, "") + out.format("o_custkey.c_mktsegment")
    o["predict_language"] = predict_sql(
        f"SELECT lang AS c, {tokens('text', STD)} AS f FROM documents",
        [f"text:{w}" for w in ("the", "quick", "and", "la", "casa")], "lang") + out.format("lang")
    o["predict_offset"] = (predict_sql(PART_TRAIN, part_evidence, "p_type", 5)
                           + "SELECT round(p, 6) AS p, c AS feature FROM answer WHERE rank > 2")

    def batch(key):
        return f"SELECT qid AS {key}, CAST(c AS VARCHAR) AS feature, round(p, 6) AS p, rank FROM answer"

    part_asked = PART_TRAIN.replace("p_type AS c", "p_partkey AS qid")
    o["predict_batch_rows"] = batch_sql(PART_TRAIN, part_asked, 10) + batch("p_partkey")
    o["top_hit"] = (batch_sql(PART_TRAIN, part_asked, 1)
                    + "SELECT qid AS p_partkey, c AS feature, round(p, 6) AS p FROM answer")
    event_features = features(value("event_type"), value("props"))
    o["predict_batch_users"] = batch_sql(
        f"SELECT CAST(user_id AS VARCHAR) AS c, {event_features} AS f FROM events",
        f"SELECT event_id AS qid, {event_features} AS f FROM events", 5) + batch("event_id")
    name_features = features(value("p_brand"), value("p_type"))
    name_train = f"SELECT list_distinct({WS.format('p_name')}) AS cs, {name_features} AS f"
    o["predict_batch_text"] = batch_text_sql(
        name_train + " FROM part", f"SELECT p_partkey AS qid, {name_features} AS f FROM part", 5) + batch("p_partkey")
    text_features = tokens("text", STD)
    o["predict_batch_documents"] = batch_sql(
        f"SELECT lang AS c, {text_features} AS f FROM documents",
        f"SELECT doc_id AS qid, {text_features} AS f FROM documents", 10) + batch("doc_id")

    o["match_link"] = predict_sql(
        f"SELECT CAST(o_custkey AS VARCHAR) AS c, {order_features} AS f FROM orders", order_evidence, "") + (
        "SELECT customer.*, round(p, 9) AS p, rank FROM answer JOIN customer ON c = CAST(c_custkey AS VARCHAR)")
    listed_customers = "(SELECT * FROM customer WHERE c_custkey % 3 <> 0)"
    o["match_dangling"] = predict_sql(
        f"SELECT CAST(o_custkey AS VARCHAR) AS c, {order_features} AS f FROM orders", order_evidence, "", 1_000_000_000) + (
        f", kept AS (SELECT *, row_number() OVER (ORDER BY rank) AS place FROM answer JOIN {listed_customers} "
        "ON c = CAST(c_custkey AS VARCHAR)) SELECT c_custkey, round(p, 9) AS score, c_nationkey FROM kept WHERE place BETWEEN 2 AND 5")
    o["recommend_dangling"] = recommend_rate_sql("SELECT o_custkey AS x, o_orderstatus = 'F' AS goal FROM orders", 1_000_000_000) + (
        f", kept AS (SELECT * FROM answer JOIN {listed_customers} ON x = c_custkey QUALIFY row_number() OVER (ORDER BY rank) <= 5), "
        "rate AS (SELECT (count(*) FILTER (o_orderstatus = 'F') + 1.0E0) / (count(*) + 2.0E0) AS rate FROM orders WHERE o_custkey IS NOT NULL) "
        "SELECT c_custkey, round(p, 6) AS p, position, round(CASE position WHEN 0 THEN rate ELSE p / rate END, 6) AS lift "
        "FROM kept CROSS JOIN rate CROSS JOIN (SELECT CAST(unnest([0, 1]) AS INTEGER) AS position)")
    o["match_value"] = predict_sql(
        "SELECT CAST(user_id AS VARCHAR) AS c, CASE WHEN event_type = 'click' THEN ['a'] ELSE CAST([] AS VARCHAR[]) END "
        "|| CASE WHEN value >= 50 THEN ['b'] ELSE CAST([] AS VARCHAR[]) END AS f FROM events", ["a", "b"], "") + (
        "SELECT c AS feature, round(p, 9) AS p, rank FROM answer")
    o["recommend_link"] = recommend_rate_sql("SELECT o_custkey AS x, o_orderstatus = 'F' AS goal FROM orders", 10) + (
        "SELECT customer.*, round(p, 6) AS p, rank FROM answer JOIN customer ON x = c_custkey")
    o["recommend_linked_goal"] = recommend_rate_sql(
        "SELECT l_suppkey AS x, coalesce(p_type = 'PROMO', false) AS goal FROM lineitem "
        "LEFT JOIN part ON l_partkey = p_partkey", 10) + (
        "SELECT CAST(x AS VARCHAR) AS feature, round(p, 6) AS p, rank FROM answer")
    o["recommend_where"] = """
WITH r AS (SELECT CAST(c_nationkey AS VARCHAR) AS x, o_orderstatus = 'F' AS g, o_orderpriority = '1-URGENT' AS a,
                  coalesce(c_mktsegment = 'BUILDING', false) AS b
           FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IS NOT NULL),
t AS (SELECT count(*) FILTER (g) AS ng, count(*) FILTER (NOT g) AS nb, count(*) FILTER (g AND a) AS ga,
             count(*) FILTER (NOT g AND a) AS ba, count(*) FILTER (g AND b) AS gb, count(*) FILTER (NOT g AND b) AS bb
      FROM r),
x AS (SELECT x, count(*) FILTER (g) AS gx, count(*) FILTER (NOT g) AS bx FROM r GROUP BY x),
s AS (SELECT x, ln((ng + 1.0E0) / (nb + 1.0E0)) + ln((gx + 1.0E0) / (ng + 2.0E0)) - ln((bx + 1.0E0) / (nb + 2.0E0))
             + ln((ga + 1.0E0) / (ng + 2.0E0)) - ln((ba + 1.0E0) / (nb + 2.0E0))
             + ln((gb + 1.0E0) / (ng + 2.0E0)) - ln((bb + 1.0E0) / (nb + 2.0E0)) AS s FROM x CROSS JOIN t),
p AS (SELECT x AS feature, 1.0E0 / (1.0E0 + exp(-s)) AS p FROM s)
SELECT feature, round(p, 6) AS p, CAST(row_number() OVER (ORDER BY round(p, 9) DESC, feature) AS INTEGER) AS rank FROM p"""

    o["relate_text"] = relate_sql(
        f"SELECT p_type = 'PROMO' AS cond, {tokens('p_name', WS)} AS f FROM part", 10)
    related = relate_sql(f"SELECT p_type = 'PROMO' AS cond, {tokens('p_name', WS)} AS f FROM part", None)
    o["relate_page"] = related[: related.index("SELECT feature, n, f")] + (
        "SELECT feature, CAST(row_number() OVER (ORDER BY round(mi, 9) DESC, feature) AS INTEGER) AS rank, round(mi, 9) AS mi "
        "FROM m QUALIFY rank BETWEEN 3 AND 6")
    o["relate_exists"] = relate_sql(
        f"SELECT status IS NOT NULL AS cond, {value('o_orderpriority')} AS f FROM {NULLED}", None)
    o["relate_documents"] = relate_sql(f"SELECT lang = 'fr' AS cond, {text_features} AS f FROM documents", None)
    o["similarity_top"] = similarity_sql(
        [f"text:{w}" for w in ("worthless", "and", "the", "tionever", "of", "heran")], text_features) + (
        "SELECT doc_id, lang, source, round(score, 6) AS score, "
        "CAST(row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS rank "
        "FROM scores JOIN documents USING (doc_id) QUALIFY rank <= 10")
    o["similarity_indexed"] = o["similarity_top"]
    o["similarity_all"] = similarity_sql(
        ["text:the", "text:and", "text:la", "text:que", "lang=es"], features(text_features, value("lang"))) + (
        "SELECT doc_id, round(score, 6) AS score FROM scores")

    o["generic_query"] = predict_sql(
        f"SELECT p_brand AS c, {features(tokens('p_name', WS), value('p_type'))} AS f FROM part",
        ["p_type=PROMO", "p_name:hot"], "", 12) + out.format("p_brand")
    o["generic_query_desc"] = predict_sql(
        f"SELECT p_brand AS c, {features(tokens('p_name', WS), value('p_type'))} AS f FROM part",
        ["p_type=PROMO", "p_name:hot"], "", 1_000_000_000) + out.format("p_brand")
    o["generic_search"] = (f"SELECT p_partkey, p_name FROM part WHERE list_contains({WS.format('p_name')}, 'hot') "
                           "ORDER BY p_retailprice, p_partkey LIMIT 15")

    held = "p_partkey % 10 = 0"
    o["evaluate_mod"] = evaluate_sql(
        batch_sql(f"{PART_TRAIN} WHERE NOT ({held})", f"{part_asked} WHERE {held}", 1),
        f"SELECT p_partkey AS qid, [p_type] AS cs FROM part WHERE {held}",
        f"SELECT count(*) FROM part WHERE NOT ({held})")
    o["evaluate_lines"] = (
        "WITH t AS (SELECT l_linestatus, l_tax, l_returnflag AS c, l_linenumber = 2 AS held FROM lineitem), "
        "cls AS (SELECT c, count(*) AS size FROM t WHERE NOT held GROUP BY c), tot AS (SELECT count(*) AS k, sum(size) AS n FROM cls), "
        "q AS (SELECT DISTINCT l_linestatus AS a, l_tax AS b FROM t WHERE held), "
        "s AS (SELECT a, b, cls.c, size, ln((size + 1.0E0) / (n + k)) "
        "+ ln(((SELECT count(*) FROM t WHERE NOT held AND t.c = cls.c AND l_linestatus = a) + 1.0E0) / (size + 2.0E0)) "
        "+ ln(((SELECT count(*) FROM t WHERE NOT held AND t.c = cls.c AND l_tax = b) + 1.0E0) / (size + 2.0E0)) AS s FROM q CROSS JOIN cls CROSS JOIN tot), "
        "w AS (SELECT a, b, c FROM s QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY round(s, 9) DESC, -size DESC, c) = 1) "
        "SELECT round(count(*) FILTER (t.c = w.c) / CAST(count(*) AS DOUBLE), 6) AS accuracy, count(*) AS test_samples, "
        "(SELECT count(*) FROM t WHERE NOT held) AS train_samples FROM t JOIN w ON a = l_linestatus AND b = l_tax WHERE held")
    docs = ("(SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)")
    o["evaluate_documents"] = evaluate_sql(
        batch_sql(f"SELECT lang AS c, {text_features} AS f FROM {docs} WHERE i % 4 <> 0",
                  f"SELECT i AS qid, {text_features} AS f FROM {docs} WHERE i % 4 = 0", 1),
        f"SELECT i AS qid, [lang] AS cs FROM {docs} WHERE i % 4 = 0",
        f"SELECT count(*) FROM {docs} WHERE i % 4 <> 0")
    parts = "(SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)"
    o["evaluate_text"] = evaluate_sql(
        batch_text_sql(f"{name_train} FROM {parts} WHERE i % 10 <> 0",
                       f"SELECT i AS qid, {name_features} AS f FROM {parts} WHERE i % 10 = 0", 1),
        f"SELECT i AS qid, {WS.format('p_name')} AS cs FROM {parts} WHERE i % 10 = 0",
        f"SELECT count(*) FROM {parts} WHERE i % 10 <> 0")
    def folds(n: int, one) -> str:
        return " UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS fold, * FROM ({one(i)})" for i in range(n))

    o["cross_validate"] = folds(5, lambda f: evaluate_sql(
        batch_text_sql(f"{name_train} FROM {parts} WHERE i % 5 <> {f}", f"SELECT i AS qid, {name_features} AS f FROM {parts} WHERE i % 5 = {f}", 1),
        f"SELECT i AS qid, {WS.format('p_name')} AS cs FROM {parts} WHERE i % 5 = {f}",
        f"SELECT count(*) FROM {parts} WHERE i % 5 <> {f}"))
    numbered = "(SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events)"
    o["cross_validate_users"] = folds(2, lambda f: evaluate_sql(
        batch_sql(f"SELECT CAST(user_id AS VARCHAR) AS c, {event_features} AS f FROM {numbered} WHERE i % 2 <> {f}",
                  f"SELECT i AS qid, {event_features} AS f FROM {numbered} WHERE i % 2 = {f}", 1),
        f"SELECT i AS qid, [CAST(user_id AS VARCHAR)] AS cs FROM {numbered} WHERE i % 2 = {f}",
        f"SELECT count(*) FROM {numbered} WHERE i % 2 <> {f}"))
    every = features(value("p_partkey"), tokens("p_name", WS), value("p_brand"), value("p_size"),
                     value("p_retailprice"))
    first = "(SELECT * FROM part ORDER BY p_partkey LIMIT 1)"
    o["quick_predict"] = batch_sql(f"SELECT p_type AS c, {every} AS f FROM part",
                                   f"SELECT p_partkey AS qid, {every} AS f FROM {first}", 10) + out.format("p_type")
    o["quick_evaluate"] = evaluate_sql(
        batch_sql(f"SELECT p_type AS c, {every} AS f FROM {parts} WHERE i % 10 <> 0",
                  f"SELECT i AS qid, {every} AS f FROM {parts} WHERE i % 10 = 0", 1),
        f"SELECT i AS qid, [p_type] AS cs FROM {parts} WHERE i % 10 = 0",
        f"SELECT count(*) FROM {parts} WHERE i % 10 <> 0")
    o["explain_prediction"] = predict_sql(PART_TRAIN, part_evidence, "p_type") + """
, fall AS (SELECT t, sum(n) AS nf FROM part_ GROUP BY t)
SELECT answer.c AS feature, CAST(0 AS INTEGER) AS position, 'prior' AS evidence,
       round((answer.size + 1.0E0) / (tot.n + tot.k), 6) AS lift FROM answer CROSS JOIN tot
UNION ALL
SELECT answer.c, CAST(list_position(['p_brand=Brand#2', 'p_name:small', 'p_name:ring'], part_.t) AS INTEGER), part_.t,
       round(((part_.n + 1.0E0) / (part_.size + 2.0E0)) / ((fall.nf + 1.0E0) / (tot.n + 2.0E0)), 6)
FROM answer JOIN part_ ON part_.c = answer.c JOIN fall ON fall.t = part_.t CROSS JOIN tot"""
    return o
