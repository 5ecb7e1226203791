"""Named tables and the queries over them.

``Engine`` holds names, schemas and links; every query is handed to a function of
``foretell.operators`` and comes back as a DataFrame.  Stored tables (see ``plans.stored``) are
Parquet tables of the Spark catalog; no data is overwritten while it is read.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foretell import schema as S
from foretell.functions.predicates import column_name, condition, paths
from foretell.operators import evaluate as ev
from foretell.operators import rank, search as se
from foretell.operators.conform import apply_functions, conform
from foretell.operators.index import curve_position
from foretell.operators.infer import infer_schema
from foretell.operators.links import bind, expand_links
from foretell.operators.predict import predict
from foretell.operators.relate import relate
from foretell.operators.similarity import similarity
from foretell.plans.stored import StoredTable
from foretell.sources import files

RESULT_FIELDS = {"$p": "p", "$score": "score", "$why": "why"}  # fixed values


def delete_entries(df: DataFrame, where: dict, tables: dict | None = None) -> DataFrame:
    """The rows that do not satisfy ``where``; a null condition keeps its row."""
    bound = bind(df, paths(where), tables)
    return bound.where(~F.coalesce(condition(bound, where), F.lit(False))).select(*df.columns)


def create_column(df: DataFrame, name: str, column, default=None) -> DataFrame:
    """Adds or replaces a column holding ``default`` (null if none is given)."""
    S.check_name(name, "column")
    column = column if isinstance(column, S.Column) else S.Column.from_json(column)
    value = F.lit(default).cast(S.SPARK_TYPES[column.type])
    return S.attach(df.withColumn(name, value), S.Table({name: column}))


def delete_column(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise ValueError(f"no column {name!r}, there are {df.columns}")
    return df.drop(name)


def compact(df: DataFrame, files: int | None = None, cluster_by: list | None = None) -> DataFrame:
    """The same rows in fewer, larger partitions, by default of the size AQE aims at.

    ``cluster_by`` one column sorts by it; several columns go by a space-filling curve, so that files
    can be skipped by a filter on any of them.
    """
    if cluster_by and len(cluster_by) > 1:
        placed = df.withColumn("_curve", curve_position(df, cluster_by))
        ranged = placed.repartitionByRange(files, "_curve") if files else placed.repartitionByRange("_curve")
        return ranged.sortWithinPartitions("_curve", *cluster_by).drop("_curve")
    if cluster_by:
        ranged = df.repartitionByRange(files, *cluster_by) if files else df.repartitionByRange(*cluster_by)
        return ranged.sortWithinPartitions(*cluster_by)
    return df.repartition(files) if files else df.hint("rebalance")


class Engine:
    def __init__(self, spark: SparkSession, database: str = "default"):
        self.spark, self.database = spark, database
        self._frames: dict = {}
        self._schemas: dict = {}

    # ------------------------------------------------------------------------- tables

    def register(self, name: str, df: DataFrame, schema=None) -> DataFrame:
        """Names a DataFrame; ``schema`` (all or some columns) adds analyzers and links."""
        S.check_name(name, "table")
        if schema is not None:
            df = S.attach(df, schema)
            self._schemas[name] = schema
        self._frames[name] = df
        return df

    def table(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        return self._stored(name).read()

    def _stored(self, name: str) -> StoredTable:
        return StoredTable(self.spark, self._catalog_name(name))

    @property
    def tables(self) -> dict:
        return _Tables(self)

    def schema(self, name: str) -> S.Table:
        df = self.table(name)
        columns = {}
        for f in df.schema.fields:
            m = f.metadata
            if "type" not in m:
                raise S.SchemaError(f"column {name}.{f.name} has no schema")
            columns[f.name] = S.Column(m["type"], m["nullable"], m.get("link"), S.analyzer_of(df, f.name))
        return S.Table(columns)

    def _catalog_name(self, name: str) -> str:
        return f"`{self.database}`.`{S.check_name(name, 'table')}`"

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a new version of a table and points the name to it."""
        self._stored(name).write(df)
        self._frames.pop(name, None)
        return self.table(name)

    def create_table(self, name: str, df: DataFrame, schema=None) -> DataFrame:
        return self._store(name, conform(df, schema) if schema is not None else df)

    def append(self, name: str, df: DataFrame) -> int:
        """Adds entries under the schema of the table; all or nothing.  Returns their number."""
        stored = self._stored(name)
        current = stored.read()
        missing = [c for c in df.columns if c not in current.columns]
        if missing:
            raise ValueError(f"table {name!r} has no columns {missing}")
        if all("type" in f.metadata for f in current.schema.fields):
            df = conform(df, self.schema(name))
        absent = [F.lit(None).cast(current.schema[c].dataType).alias(c) for c in current.columns if c not in df.columns]
        seen = Observation()
        rows = df.select("*", *absent).select(
            *[F.col(c).cast(current.schema[c].dataType).alias(c) for c in current.columns]
        ).observe(seen, F.count("*").alias("n"))
        stored.add_rows(rows)
        loaded = seen.get["n"]
        if not loaded:
            raise ValueError(f"nothing was loaded into {name!r}")
        return loaded

    def load_file(self, name: str, path: str, fmt: str | None = None, functions=(), **options) -> int:
        return self.append(name, apply_functions(files.read(self.spark, path, fmt, **options), functions))

    def quick_add_table(self, path: str, name: str | None = None, fmt: str | None = None, **options) -> DataFrame:
        """Read, infer, create and load in one call; the name defaults to that of the file."""
        df = apply_functions(files.read(self.spark, path, fmt, **options), ())
        return self.create_table(name or files.table_name(path), df, infer_schema(df))

    def quick_add_query(self, url: str, query: str, name: str, **options) -> DataFrame:
        """The same for the result of a query on an external database."""
        df = apply_functions(files.read_sql(self.spark, url, query, **options), ())
        return self.create_table(name, df, infer_schema(df))

    def export_table(self, name: str, path: str, gzip: bool = False) -> None:
        files.write_ndjson(self.table(name), path, gzip)

    def delete_entries(self, name: str, where: dict, rewrite: bool = True) -> DataFrame:
        """Deletes the rows that satisfy ``where``.

        With ``rewrite`` the others become a new version, which readers of the catalog see too.  Without it
        only the places of the deleted rows are written, which readers through an engine leave out.
        """
        if rewrite:
            return self._store(name, delete_entries(self.table(name), where, self.tables))
        stored = self._stored(name)
        rows = stored.read(places=True)
        bound = bind(rows, paths(where), self.tables)
        stored.delete(bound.where(F.coalesce(condition(bound, where), F.lit(False))))
        return self.table(name)

    def copy_table(self, source: str, target: str, replace: bool = False) -> DataFrame:
        if not replace and self.spark.catalog.tableExists(self._catalog_name(target)):
            raise ValueError(f"table {target!r} exists")
        return self._store(target, self.table(source))

    def create_column(self, name: str, column: str, schema, default=None) -> DataFrame:
        """Adds or replaces a column without rewriting the table."""
        field = create_column(self.table(name).limit(0), column, schema, default).schema[column]
        self._stored(name).add_column(field, default)
        return self.table(name)

    def delete_column(self, name: str, column: str) -> DataFrame:
        """Drops a column without rewriting the table."""
        self._stored(name).drop_column(column)
        return self.table(name)

    def optimize_table(self, name: str, files: int | None = None, cluster_by: list | None = None) -> DataFrame:
        """Rewrites a table into fewer, larger files and computes its statistics."""
        stored = self._store(name, compact(self.table(name), files, cluster_by))  # without deleted rows
        self.spark.sql(f"ANALYZE TABLE {self._catalog_name(name)} COMPUTE STATISTICS FOR ALL COLUMNS")
        return stored

    # ------------------------------------------------------------------------ queries

    def _source(self, query: dict, allowed: set) -> DataFrame:
        unknown = set(query) - allowed - {"from", "where", "select", "offset", "limit"}
        if unknown:
            raise ValueError(f"unknown query properties {sorted(unknown)}")
        return self.table(query["from"])

    def _finish(self, result: DataFrame, query: dict) -> DataFrame:
        """``offset`` on ranked hits and the ``select`` list with its pseudo-columns and linked fields."""
        if query.get("offset") and "rank" in result.columns:
            result = result.where(F.col("rank") > query["offset"])
        if query.get("select"):
            linked = [f for f in query["select"] if "." in f]
            result = bind(result, linked, self.tables) if linked else result
            fields = RESULT_FIELDS if "score" in result.columns else {**RESULT_FIELDS, "$score": "p"}
            result = result.select(*[fields.get(f, column_name(f)) for f in query["select"]])
        return result

    @staticmethod
    def _upto(query: dict) -> int | None:
        """Hits to rank; a null limit asks for all."""
        limit = query.get("limit", 10)
        return None if limit is None else limit + query.get("offset", 0)

    @staticmethod
    def _explain(query: dict) -> bool:
        return "$why" in (query.get("select") or [])

    def search(self, query: dict) -> DataFrame:
        df = self._source(query, {"orderBy"})
        return se.search(df, query.get("where"), query.get("select"), query.get("orderBy"),
                         query.get("offset", 0), query.get("limit", 10), self.tables)

    def total(self, query: dict) -> DataFrame:
        return se.total(self.table(query["from"]), query.get("where"), self.tables)

    def predict(self, query: dict) -> DataFrame:
        df = self._source(query, {"predict"})
        return self._finish(predict(df, query.get("where"), query["predict"], self._upto(query), self.tables,
                                    self._explain(query)), query)

    def match(self, query: dict) -> DataFrame:
        df = self._source(query, {"match"})
        return self._finish(rank.match(df, query.get("where"), query["match"], self._upto(query), self.tables,
                                       self._explain(query)), query)

    def recommend(self, query: dict) -> DataFrame:
        df = self._source(query, {"recommend", "goal"})
        return self._finish(rank.recommend(df, query["recommend"], query["goal"], query.get("where"),
                                           self._upto(query), self.tables, self._explain(query)), query)

    def similarity(self, query: dict, key: str) -> DataFrame:
        df = self._source(query, {"similarity"})
        return self._finish(similarity(df, query["similarity"], key, self._upto(query), self.tables), query)

    def relate(self, query: dict) -> DataFrame:
        df = self._source(query, {"relate"})
        found = relate(df, query.get("where"), query["relate"], self._upto(query), self.tables)
        if "rank" not in found.columns and query.get("offset"):
            found = found.orderBy(F.desc("mi"), "feature").offset(query["offset"])
        return self._finish(found, query)

    def evaluate(self, query: dict, key: str | None = None, order_by: list | None = None) -> DataFrame:
        inner = query["evaluate"]
        df = self._source(inner, {"predict", "match"})
        target = inner.get("predict") or inner["match"]
        return ev.evaluate(df, query["test"], inner.get("where", {}), target, key, order_by, self.tables)

    def query(self, query: dict) -> DataFrame:
        """Generic query: with ``get`` and ``orderBy: $p`` a prediction of ``get``, else a search."""
        df = self._source(query, {"get", "orderBy"})
        if query.get("get") and query.get("orderBy") in ("$p", {"$desc": "$p"}):
            return self._finish(predict(df, query.get("where"), query["get"], self._upto(query), self.tables,
                                        self._explain(query)), query)
        fields = query.get("select") or ([query["get"]] if query.get("get") else None)
        return se.search(df, query.get("where"), fields, query.get("orderBy"), query.get("offset", 0),
                         query.get("limit", 10), self.tables)

    def quick_predict(self, name: str, target: str, order_by: list) -> tuple:
        """``(query, result)``: an example query from the first row of a table, and its hits."""
        query, _ = ev.quick_queries(self.table(name), target, order_by, self.tables)
        query = {"from": name, **query}
        return query, self.predict(query)

    def quick_evaluate(self, name: str, target: str, order_by: list) -> tuple:
        """``(query, result)``: an example evaluation of a table, every tenth row held out."""
        _, query = ev.quick_queries(self.table(name), target, order_by, self.tables)
        query = {**query, "evaluate": {"from": name, **query["evaluate"]}}
        return query, self.evaluate(query, order_by=order_by)

    def all_entries(self, name: str, fields: list | None = None) -> DataFrame:
        df = self.table(name)
        return se.select(df, fields, self.tables) if fields else df

    def expand_links(self, name: str) -> DataFrame:
        return expand_links(self.table(name), self.tables)


class _Tables(dict):
    """Tables of an engine, looked up by name when a link asks for them."""

    def __init__(self, engine: Engine):
        super().__init__()
        self._engine = engine

    def __contains__(self, name):
        return name in self._engine._frames or self._engine.spark.catalog.tableExists(self._engine._catalog_name(name))

    def __missing__(self, name):
        return self._engine.table(name)

    def __bool__(self):
        return True
