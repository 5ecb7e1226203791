"""The registered queries: every operator applied to whole tables.

``QUERIES`` maps a name to a function ``(spark, folder) -> DataFrame``; ``oracles.py``
holds the SQL that must give the same rows.  Floats are rounded to six digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions import analyzers as an
from foretell.operators import conform as co
from foretell.operators import evaluate as ev
from foretell.operators import infer as inf
from foretell.operators import rank
from foretell.operators import search as se
from foretell.operators.batch import predict_batch
from foretell.operators.counts import feature_counts
from foretell.operators.index import with_index
from foretell.functions.features import classes, row_features
from foretell.operators.predict import predict
from foretell.operators.relate import relate
from foretell.operators.similarity import build_index, similarity_scores
from foretell.plans.engine import Engine
from foretell.plans.workspace import fresh_path
from foretell.sources import files
from foretell.sources.convert import convert
from foretell.streaming.ingest import ingest_stream, loaded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TEXT = {"type": "Text", "analyzer": "standard"}
NAME = {"type": "Text", "analyzer": "whitespace"}
SCHEMAS = {
    "part": {"p_name": NAME},
    "documents": {"text": TEXT},
    "orders": {"o_custkey": {"type": "Int", "link": "customer.c_custkey"}},
    "customer": {"c_nationkey": {"type": "Int", "link": "nation.n_nationkey"}},
    "lineitem": {"l_partkey": {"type": "Int", "link": "part.p_partkey"}},
}


def query(f):
    QUERIES[f.__name__] = f
    return f


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return S.attach(df, SCHEMAS.get(name, {}))


def engine(spark: SparkSession, folder: str, *names: str) -> Engine:
    e = Engine(spark)
    for name in names:
        e.register(name, load(spark, folder, name))
    return e


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ------------------------------------------------------------- scan, search, links, order


@query
def scan_parquet(spark, folder):
    return files.read(spark, f"{folder}/customer.parquet")


@query
def table_size(spark, folder):
    return se.table_size(load(spark, folder, "lineitem"))


@query
def query_page(spark, folder):
    return engine(spark, folder, "customer").search(
        {"from": "customer", "orderBy": [{"$desc": "c_acctbal"}, "c_custkey"], "offset": 20, "limit": 10}
    )


@query
def deep_page(spark, folder):
    """Ten hits in the middle of all lines, in a falling and a rising order."""
    lines = load(spark, folder, "lineitem")
    fields = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]
    return se.search(lines, None, fields, [{"$desc": "l_extendedprice"}, *fields[1:]], lines.count() // 2, 10)


@query
def query_all(spark, folder):
    return engine(spark, folder, "orders").all_entries("orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query
def search_total(spark, folder):
    return engine(spark, folder, "orders").total({"from": "orders", "where": {"o_orderstatus": "F"}})


@query
def search_eq_and(spark, folder):
    where = {"p_brand": "Brand#2", "p_type": "PROMO"}
    return se.search(load(spark, folder, "part"), where, ["p_partkey", "p_name", "p_brand", "p_type"], limit=None)


@query
def search_match(spark, folder):
    where = {"text": {"$match": "The and"}}
    return se.search(load(spark, folder, "documents"), where, ["doc_id", "lang", "source"], limit=None)


def _with_nulls(spark, folder):
    return load(spark, folder, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))


@query
def search_exists(spark, folder):
    return se.search(_with_nulls(spark, folder), {"$exists": "status"}, ["o_orderkey", "status"], limit=None)


@query
def search_null(spark, folder):
    return se.search(_with_nulls(spark, folder), {"status": None}, ["o_orderkey", "o_orderpriority"], limit=None)


@query
def search_gte(spark, folder):
    where = {"o_totalprice": {"$gte": 250000.0}}
    return se.search(load(spark, folder, "orders"), where, ["o_orderkey", "o_totalprice"], limit=None)


@query
def search_range(spark, folder):
    where = {"l_quantity": {"$gt": 10.0, "$lte": 20.0}, "l_discount": {"$lt": 0.05}}
    return se.search(load(spark, folder, "lineitem"), where, ["l_orderkey", "l_quantity", "l_discount"], limit=None)


@query
def search_get(spark, folder):
    """``$get`` compares with another field of the row."""
    tables = {"part": load(spark, folder, "part")}
    where = {"l_quantity": {"$gte": {"$get": "l_partkey.p_size"}}}
    return se.search(load(spark, folder, "lineitem"), where, ["l_orderkey", "l_partkey", "l_quantity"], limit=None,
                     tables=tables)


@query
def search_link(spark, folder):
    return engine(spark, folder, "orders", "customer").search({
        "from": "orders", "where": {"o_custkey.c_mktsegment": "BUILDING", "o_orderstatus": "F"},
        "select": ["o_orderkey", "o_custkey.c_name", "o_custkey.c_mktsegment"], "limit": None,
    })


@query
def select_link(spark, folder):
    tables = {"customer": load(spark, folder, "customer")}
    return se.select(load(spark, folder, "orders"), ["o_orderkey", "o_custkey.c_name", "o_custkey.c_nationkey"], tables)


@query
def expand_links(spark, folder):
    return engine(spark, folder, "orders", "customer").expand_links("orders")


@query
def row_index(spark, folder):
    """A leading key with five values: ranges are cut by the whole key."""
    indexed = with_index(load(spark, folder, "orders"), ["o_orderpriority", "o_orderkey"])
    return indexed.select("o_orderkey", "o_orderpriority", "_index")


@query
def index_mod_split(spark, folder):
    indexed = with_index(load(spark, folder, "events"), ["ts", "event_id"])
    where = {"$index": {"$mod": [10, 0], "$gte": 100}}
    return se.search(indexed, where, ["event_id", "user_id", "$index"], limit=None)


@query
def hits_json(spark, folder):
    customer = load(spark, folder, "customer").withColumn("seg", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    hits = se.to_hits(customer.select("c_custkey", "c_name", "seg"))
    return hits.select(
        F.get_json_object("hit", "$.c_custkey").cast("long").alias("c_custkey"),
        F.get_json_object("hit", "$.seg").alias("seg"),
        F.size(F.json_object_keys("hit")).cast("long").alias("n_fields"),
    )


@query
def top_hit(spark, folder):
    """The most probable answer of every row of a batch."""
    part = load(spark, folder, "part")
    ranked = predict_batch(part, part, "p_partkey", ["p_name", "p_brand"], "p_type", k=3)
    return rounded(se.top(ranked), "p").select("p_partkey", "feature", "p")


# -------------------------------------------------------------------------------- tokens


def _token_counts(df, key, column, analyzer, rare=False):
    """How many rows hold each token, and the smallest key among them.

    ``rare``: most tokens stand in one row only.  Then they are shuffled as they are; tables of sums before
    the shuffle would grow with the rows of a task and spare little.
    """
    found = an.tokens(df, key, column, analyzer)
    if rare:
        found = found.repartition("token")
    return found.groupBy("token").agg(F.count("*").alias("n"), F.min(key).alias("first_key"))


@query
def tok_whitespace(spark, folder):
    return an.tokens(load(spark, folder, "documents"), "doc_id", "text", "whitespace")


@query
def tok_standard(spark, folder):
    return an.tokens(load(spark, folder, "documents"), "doc_id", "text")


@query
def tok_delimiter(spark, folder):
    return an.tokens(load(spark, folder, "orders"), "o_orderkey", "o_orderpriority", S.Delimiter("-"))


@query
def tok_delimiter_untrimmed(spark, folder):
    return an.tokens(load(spark, folder, "documents"), "doc_id", "text", S.Delimiter(".", trim=False))


@query
def tok_cjk(spark, folder):
    """A language named by its alias, as inference gives it."""
    return an.tokens(load(spark, folder, "documents"), "doc_id", "text", "cjk")


@query
def tok_language(spark, folder):
    words = S.Language("en", stop_words=("the", "and", "of", "is"), key_words=("worthless",))
    return an.tokens(load(spark, folder, "documents"), "doc_id", "text", words)


@query
def tok_language_default(spark, folder):
    words = S.Language("en", use_default_stop_words=True)
    return _token_counts(load(spark, folder, "documents"), "doc_id", "text", words)


@query
def tok_char_ngram(spark, folder):
    return _token_counts(load(spark, folder, "part"), "p_partkey", "p_name", S.CharNGram(2, 4))


@query
def tok_char_ngram_accents(spark, folder):
    return _token_counts(load(spark, folder, "documents"), "doc_id", "text", S.CharNGram(3, 3))


@query
def tok_token_ngram(spark, folder):
    grams = S.TokenNGram("standard", 1, 2, "_")
    return _token_counts(load(spark, folder, "documents"), "doc_id", "text", grams, rare=True)


@query
def tok_nested_ngram(spark, folder):
    nested = S.TokenNGram(S.TokenNGram("whitespace", 1, 2), 2, 2, "+")
    return an.tokens(load(spark, folder, "part"), "p_partkey", "p_name", nested)


# ----------------------------------------------------------------------------- inference


def _mixed(spark, folder):
    """String and number columns of every kind inference tells apart."""
    return load(spark, folder, "events").select(
        "event_id", "ts", "value", "event_type",
        (F.col("event_id") * 1_000_000).alias("big"),
        F.col("user_id").cast("string").alias("int_text"),
        F.concat(F.col("event_id"), F.lit("0000000000")).alias("big_text"),
        F.concat(F.col("event_id"), F.lit(".5")).alias("decimal_text"),
        F.when(F.col("user_id") > 75, "true").otherwise("False").alias("bool_text"),
        (F.col("user_id") > 75).alias("flag"),
        F.nullif("event_type", F.lit("click")).alias("some_null"),
        F.lit(None).cast("string").alias("all_null"),
        F.when(F.col("user_id") > 75, F.lit("nan").cast("double")).otherwise(F.col("value")).alias("some_nan"),
    )


@query
def infer_types(spark, folder):
    return inf.column_profile(_mixed(spark, folder)).select("column", "type")


@query
def infer_nullability(spark, folder):
    return inf.column_profile(_mixed(spark, folder)).select("column", "nullable", "n_rows", "n_null")


@query
def infer_int_range(spark, folder):
    line = load(spark, folder, "lineitem")
    return inf.column_profile(line.select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") + 2147483647).alias("above"),
        (-F.col("l_orderkey") - 2147483648).alias("below"),
    )).select("column", "type")


@query
def infer_delimiter(spark, folder):
    return inf.delimiter_counts(load(spark, folder, "orders"), "o_orderpriority")


@query
def infer_language(spark, folder):
    """The language with most stop words for every document."""
    hits = inf.language_hits(load(spark, folder, "documents"), "text", ["doc_id"])
    best = hits.groupBy("doc_id").agg(F.max(F.struct("hits", "lang")).alias("b"))
    return best.select("doc_id", F.col("b.lang").alias("language"), F.col("b.hits").alias("hits"))


@query
def infer_schema(spark, folder):
    found = inf.infer_schema(co.datetimes_to_string(load(spark, folder, "part")))
    rows = [(n, c.type, c.nullable, str(c.analyzer.to_json()) if c.analyzer else None) for n, c in found.columns.items()]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean, analyzer string")


@query
def infer_sample(spark, folder):
    """Types from a thousand rows; nothing in these columns depends on which."""
    line = load(spark, folder, "lineitem").select("l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    found = inf.infer_types(co.datetimes_to_string(line), sample=1000)
    return spark.createDataFrame(list(found.items()), "column string, type string")


@query
def comma_decimals(spark, folder):
    """Prices written with a comma, behind semicolons, and read as numbers."""
    path = fresh_path(spark, "comma")
    part = load(spark, folder, "part").select("p_partkey", "p_name", F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("price"))
    files.write_csv(part, path, sep=";")
    return rounded(files.read_csv(spark, path, delimiter=";", decimal=","), "price")


@query
def read_json(spark, folder):
    """Arrays of records, a file for each nation."""
    path = fresh_path(spark, "arrays")
    row = F.struct("c_custkey", "c_name", "c_acctbal")
    arrays = load(spark, folder, "customer").groupBy("c_nationkey").agg(F.to_json(F.collect_list(row)).alias("value"))
    arrays.write.partitionBy("c_nationkey").text(path)
    return files.read_json(spark, path).select("c_custkey", "c_name", "c_acctbal", "c_nationkey")


@query
def convert_file(spark, folder):
    """Parquet to NDJSON under a schema, read again."""
    path = fresh_path(spark, "converted")
    convert(spark, f"{folder}/part.parquet", path, out_format="ndjson", schema=_schema(
        p_partkey=S.STRING, p_name=S.STRING, p_brand=S.STRING, p_type=S.STRING, p_size=S.DECIMAL, p_retailprice=S.INT))
    return files.read(spark, path, "ndjson")


# ------------------------------------------------------------------------------- conform


@query
def null_counts(spark, folder):
    """What the check of non-nullable columns counts."""
    customer = load(spark, folder, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY"))).withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")))
    return co.null_counts(customer, S.Table({n: S.Column(t) for n, t in (
        ("c_custkey", S.INT), ("c_mktsegment", S.STRING), ("c_acctbal", S.DECIMAL))}))


@query
def schema_diff(spark, folder):
    found = co.schema_diff(load(spark, folder, "part"), _schema(p_partkey=S.INT, p_name=S.STRING, p_colour=S.STRING))
    return spark.createDataFrame([(side, c) for side, cs in found.items() for c in cs], "side string, column string")


def _schema(**types):
    return S.Table({n: S.Column(t, nullable=True) for n, t in types.items()})


@query
def conform_int(spark, folder):
    line = load(spark, folder, "lineitem").select(
        "l_orderkey", (-F.col("l_extendedprice")).alias("negated"), F.col("l_quantity").cast("string").alias("text"))
    return co.conform(line, _schema(negated=S.INT, text=S.INT))


@query
def conform_string(spark, folder):
    return co.conform(load(spark, folder, "orders"),
                      _schema(o_orderkey=S.STRING, o_custkey=S.STRING, o_totalprice=S.STRING, o_orderdate=S.STRING))


@query
def conform_double(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("text"), F.col("o_custkey").alias("whole"))
    return co.conform(orders, _schema(text=S.DECIMAL, whole=S.DECIMAL))


@query
def conform_bool(spark, folder):
    labels = load(spark, folder, "labels").withColumn("word", F.when(F.col("toxic") == 1, "true").otherwise("false"))
    return co.conform(labels, _schema(quality=S.BOOLEAN, toxic=S.BOOLEAN, word=S.BOOLEAN))


@query
def conform_nan(spark, folder):
    events = load(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "click", F.lit("nan").cast("double")).otherwise(F.col("value"))
        .alias("value"))
    return rounded(co.conform(events, _schema(value=S.DECIMAL)), "value")


@query
def datetimes_to_string(spark, folder):
    return co.datetimes_to_string(load(spark, folder, "lineitem").select("l_orderkey", "l_shipdate"))


@query
def apply_functions(spark, folder):
    functions = [
        lambda df: df.withColumn("year", F.substring("o_orderdate", 1, 4)),
        lambda df: df.withColumn("label", F.concat_ws("/", "year", "o_orderpriority")),
    ]
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return co.apply_functions(orders, functions)


# ------------------------------------------------------------------- tables and streaming


def _stored(spark, folder, name, schema=None):
    e = Engine(spark)
    table = f"{name}_{fresh_path(spark, 't')[-12:]}"
    return e, table, load(spark, folder, name)


@query
def append(spark, folder):
    e, t, orders = _stored(spark, folder, "orders")
    final = F.col("o_orderstatus") == "F"
    e.create_table(t, orders.where(final))
    e.append(t, orders.where(~final))
    return e.table(t)


@query
def delete_entries(spark, folder):
    e, t, orders = _stored(spark, folder, "orders")
    e.create_table(t, orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))))
    return e.delete_entries(t, {"o_orderstatus": "F", "o_totalprice": {"$gte": 100000.0}})


@query
def delete_places(spark, folder):
    """The same deletion by the places of the rows, and then another one."""
    e, t, orders = _stored(spark, folder, "orders")
    e.create_table(t, orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))))
    e.delete_entries(t, {"o_orderstatus": "F", "o_totalprice": {"$gte": 100000.0}}, rewrite=False)
    return e.delete_entries(t, {"o_orderkey": {"$mod": [7, 0]}}, rewrite=False)


@query
def copy_table(spark, folder):
    e, t, customer = _stored(spark, folder, "customer")
    e.create_table(t, customer)
    return e.copy_table(t, t + "_copy")


@query
def create_column(spark, folder):
    e, t, customer = _stored(spark, folder, "customer")
    e.create_table(t, customer)
    e.create_column(t, "score", {"type": "Decimal", "nullable": True})
    return e.create_column(t, "c_mktsegment", {"type": "String"}, "ANY")


@query
def delete_column(spark, folder):
    e, t, customer = _stored(spark, folder, "customer")
    e.create_table(t, customer)
    return e.delete_column(t, "c_acctbal")


@query
def optimize_table(spark, folder):
    e, t, line = _stored(spark, folder, "lineitem")
    e.create_table(t, line)
    return e.optimize_table(t, cluster_by=["l_shipdate"])


@query
def optimize_table_curve(spark, folder):
    """Clustered by two columns at once; the rows are the same."""
    e, t, orders = _stored(spark, folder, "orders")
    e.create_table(t, orders)
    return e.optimize_table(t, cluster_by=["o_orderdate", "o_totalprice"])


@query
def load_file(spark, folder):
    """Export to NDJSON and load the files into a table under its schema."""
    e, t, orders = _stored(spark, folder, "orders")
    path = fresh_path(spark, "export")
    schema = _schema(o_orderkey=S.INT, o_custkey=S.INT, o_orderstatus=S.STRING, o_totalprice=S.DECIMAL,
                     o_orderdate=S.STRING, o_orderpriority=S.STRING)
    e.register("whole", co.conform(co.datetimes_to_string(orders), schema))
    e.export_table("whole", path, gzip=True)
    e.create_table(t, e.table("whole").limit(0))
    e.load_file(t, path, "ndjson")
    return e.table(t)


@query
def quick_add_table(spark, folder):
    e, t, customer = _stored(spark, folder, "customer")
    path = fresh_path(spark, "csv")
    files.write_csv(customer, path)
    return rounded(e.quick_add_table(path, t, "csv"), "c_acctbal")


@query
def stream_ingest(spark, folder):
    source = fresh_path(spark, "source")
    schema = _schema(event_id=S.INT, ts=S.STRING, user_id=S.INT, event_type=S.STRING, value=S.DECIMAL, props=S.STRING)
    files.write_ndjson(co.datetimes_to_string(load(spark, folder, "events")), source)
    target = fresh_path(spark, "events")
    stream = ingest_stream(spark, source, schema, target, fresh_path(spark, "rejected"), fresh_path(spark, "progress"))
    stream.awaitTermination()
    return loaded(spark, target, schema)


# ---------------------------------------------------------------------------- prediction

PART_QUERY = {"p_brand": "Brand#2", "p_name": "small ring"}


@query
def feature_pairs(spark, folder):
    part = load(spark, folder, "part")
    return feature_counts(part, classes(part, "p_type"), row_features(part, ["p_name", "p_brand"]))


@query
def predict_field(spark, folder):
    e = engine(spark, folder, "part")
    return rounded(e.predict({"from": "part", "where": PART_QUERY, "predict": "p_type"}), "p")


@query
def predict_prior(spark, folder):
    return rounded(predict(load(spark, folder, "orders"), None, "o_orderpriority"), "p")


@query
def predict_text(spark, folder):
    return rounded(predict(load(spark, folder, "part"), {"p_brand": "Brand#2"}, "p_name", limit=20), "p")


@query
def predict_linked(spark, folder):
    e = engine(spark, folder, "orders", "customer")
    where = {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"}
    return rounded(e.predict({"from": "orders", "where": where, "predict": "o_custkey.c_mktsegment"}), "p")


@query
def predict_language(spark, folder):
    where = {"text": "the quick and la casa"}
    return rounded(predict(load(spark, folder, "documents"), where, "lang"), "p")


@query
def predict_offset(spark, folder):
    e = engine(spark, folder, "part")
    return rounded(e.predict({"from": "part", "where": PART_QUERY, "predict": "p_type", "offset": 2, "limit": 3,
                              "select": ["$p", "feature"]}), "p")


@query
def predict_batch_rows(spark, folder):
    part = load(spark, folder, "part")
    return rounded(predict_batch(part, part, "p_partkey", ["p_name", "p_brand"], "p_type"), "p")


@query
def predict_batch_users(spark, folder):
    events = load(spark, folder, "events")
    return rounded(predict_batch(events, events, "event_id", ["event_type", "props"], "user_id", k=5), "p")


@query
def predict_batch_text(spark, folder):
    part = load(spark, folder, "part")
    return rounded(predict_batch(part, part, "p_partkey", ["p_brand", "p_type"], "p_name", k=5), "p")


@query
def predict_batch_documents(spark, folder):
    documents = load(spark, folder, "documents")
    return rounded(predict_batch(documents, documents, "doc_id", ["text"], "lang"), "p")


@query
def match_link(spark, folder):
    e = engine(spark, folder, "orders", "customer")
    where = {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"}
    return rounded(e.match({"from": "orders", "where": where, "match": "o_custkey"}), "p", digits=9)


def _some_customers(spark, folder):
    """Orders linked to a customer table that lacks every third of their customers."""
    e = engine(spark, folder, "orders")
    e.register("customer", load(spark, folder, "customer").where("c_custkey % 3 <> 0"))
    return e


@query
def match_dangling(spark, folder):
    where = {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"}
    found = _some_customers(spark, folder).match(
        {"from": "orders", "where": where, "match": "o_custkey", "limit": 4, "offset": 1, "select": ["c_custkey", "$score", "c_nationkey"]})
    return rounded(found.withColumnRenamed("p", "score"), "score", digits=9)


@query
def recommend_dangling(spark, folder):
    found = _some_customers(spark, folder).recommend(
        {"from": "orders", "recommend": "o_custkey", "goal": {"o_orderstatus": "F"}, "limit": 5, "select": ["c_custkey", "$p", "$why"]})
    why = found.select("c_custkey", "p", F.posexplode("why").alias("position", "w"))
    return rounded(why.select("c_custkey", "p", "position", F.col("w.lift").alias("lift")), "p", "lift")


@query
def match_value(spark, folder):
    where = {"event_type": "click", "value": {"$gte": 50.0}}
    return rounded(rank.match(load(spark, folder, "events"), where, "user_id"), "p", digits=9)


@query
def recommend_link(spark, folder):
    e = engine(spark, folder, "orders", "customer")
    return rounded(e.recommend({"from": "orders", "recommend": "o_custkey", "goal": {"o_orderstatus": "F"}}), "p")


@query
def recommend_linked_goal(spark, folder):
    tables = {"part": load(spark, folder, "part")}
    return rounded(rank.recommend(load(spark, folder, "lineitem"), "l_suppkey", {"l_partkey.p_type": "PROMO"},
                                  tables=tables), "p")


@query
def recommend_where(spark, folder):
    tables = {"customer": load(spark, folder, "customer")}
    return rounded(rank.recommend(load(spark, folder, "orders"), "o_custkey.c_nationkey", {"o_orderstatus": "F"},
                                  {"o_orderpriority": "1-URGENT", "o_custkey.c_mktsegment": "BUILDING"}, 25, tables), "p")


def _flat_relations(df):
    return rounded(df.select("feature", "fs.*", "ps.*", "lift", "mi"), "p", "p_on_cond", "p_on_not_cond", "lift",
                   ).withColumn("mi", F.round("mi", 8))


@query
def relate_text(spark, folder):
    return _flat_relations(relate(load(spark, folder, "part"), {"p_type": "PROMO"}, "p_name", 10))


@query
def relate_page(spark, folder):
    e = engine(spark, folder, "part")
    found = e.relate({"from": "part", "where": {"p_type": "PROMO"}, "relate": "p_name", "offset": 2, "limit": 4})
    return rounded(found.select("feature", "rank", "mi"), "mi", digits=9)


@query
def relate_exists(spark, folder):
    orders = _with_nulls(spark, folder)
    return _flat_relations(relate(orders, {"$exists": "status"}, "o_orderpriority", None))


@query
def relate_documents(spark, folder):
    return _flat_relations(relate(load(spark, folder, "documents"), {"lang": "fr"}, "text", None))


@query
def similarity_top(spark, folder):
    e = engine(spark, folder, "documents")
    found = e.similarity({"from": "documents", "similarity": {"text": "worthless and the tionever of heran"}}, "doc_id")
    return rounded(found, "score").select("doc_id", "lang", "source", "score", "rank")


@query
def similarity_indexed(spark, folder):
    """An index over two thirds of the documents, extended by the others; the same hits as ``similarity_top``."""
    documents = load(spark, folder, "documents")
    late = F.pmod("doc_id", F.lit(3)) == 1
    index = build_index(documents.where(~late), ["text"], "doc_id").append(documents.where(late))
    found = index.top(documents, {"text": "worthless and the tionever of heran"})
    return rounded(found, "score").select("doc_id", "lang", "source", "score", "rank")


@query
def similarity_all(spark, folder):
    example = {"text": "The and la que", "lang": "es"}
    return rounded(similarity_scores(load(spark, folder, "documents"), example, "doc_id"), "score")


@query
def generic_query(spark, folder):
    e = engine(spark, folder, "part")
    return rounded(e.query({"from": "part", "where": {"p_type": "PROMO", "p_name": "hot"}, "get": "p_brand",
                            "orderBy": "$p", "limit": 12}), "p")


@query
def generic_query_desc(spark, folder):
    e = engine(spark, folder, "part")
    return rounded(e.query({"from": "part", "where": {"p_type": "PROMO", "p_name": "hot"}, "get": "p_brand",
                            "orderBy": {"$desc": "$p"}, "limit": None}), "p")


@query
def generic_search(spark, folder):
    e = engine(spark, folder, "part")
    return e.query({"from": "part", "where": {"p_name": {"$match": "hot"}}, "orderBy": ["p_retailprice", "p_partkey"],
                    "select": ["p_partkey", "p_name"], "limit": 15})


@query
def evaluate_mod(spark, folder):
    e = engine(spark, folder, "part")
    return rounded(e.evaluate({
        "test": {"p_partkey": {"$mod": [10, 0]}},
        "evaluate": {"from": "part", "where": {"p_name": {"$get": "p_name"}, "p_brand": {"$get": "p_brand"}},
                     "predict": "p_type"},
    }, key="p_partkey"), "accuracy")


@query
def evaluate_lines(spark, folder):
    """Test rows without a unique key."""
    e = engine(spark, folder, "lineitem")
    return rounded(e.evaluate({
        "test": {"l_linenumber": 2},
        "evaluate": {"from": "lineitem", "where": {"l_linestatus": {"$get": "l_linestatus"}, "l_tax": {"$get": "l_tax"}},
                     "predict": "l_returnflag"},
    }, key="l_orderkey"), "accuracy")


@query
def evaluate_documents(spark, folder):
    return rounded(ev.evaluate(load(spark, folder, "documents"), {"$index": {"$mod": [4, 0]}},
                               {"text": {"$get": "text"}}, "lang", order_by=["doc_id"]), "accuracy")


@query
def evaluate_text(spark, folder):
    return rounded(ev.evaluate(load(spark, folder, "part"), {"$index": {"$mod": [10, 0]}},
                               {"p_brand": {"$get": "p_brand"}, "p_type": {"$get": "p_type"}}, "p_name",
                               order_by=["p_partkey"]), "accuracy")


@query
def cross_validate(spark, folder):
    """Five folds at once; a Text target."""
    return rounded(ev.cross_validate(load(spark, folder, "part"), 5, {"p_brand": {"$get": "p_brand"}, "p_type": {"$get": "p_type"}},
                                     "p_name", ["p_partkey"]), "accuracy")


@query
def cross_validate_users(spark, folder):
    """Two folds with many classes."""
    events = load(spark, folder, "events")
    return rounded(ev.cross_validate(events, 2, {"event_type": {"$get": "event_type"}, "props": {"$get": "props"}}, "user_id",
                                     ["event_id"]), "accuracy")


@query
def quick_predict(spark, folder):
    return rounded(ev.quick_predict(load(spark, folder, "part"), "p_type", ["p_partkey"]), "p")


@query
def quick_evaluate(spark, folder):
    _, found = engine(spark, folder, "part").quick_evaluate("part", "p_type", ["p_partkey"])
    return rounded(found, "accuracy")


@query
def explain_prediction(spark, folder):
    found = predict(load(spark, folder, "part"), PART_QUERY, "p_type", explain=True)
    why = found.select("feature", F.posexplode("why").alias("position", "w"))
    return rounded(why.select("feature", "position", F.col("w.feature").alias("evidence"), F.col("w.lift").alias("lift")),
                   "lift")
