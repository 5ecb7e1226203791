"""Stored tables: Parquet tables of the Spark catalog with columns and deletions kept as metadata.

A table keeps its name while it changes.  New rows are files that are added; a new version of all rows is a
new folder that the name is moved to.  What the files do not say is a property of the table, one for
each folder, so that moving the name changes both at once:

* ``columns``: the columns in order, the name of each in the files, and its schema.  A dropped column
  stays in the files under a name that no new column gets; a new one is filled with its default by the
  reader of the files.
* ``deleted``: folders with the positions of deleted rows, by file.  Readers leave these rows out.

So columns are added and dropped without a job over the data, and a deletion may write no more than the
positions of its rows.  A reader sees the table before or after a change, never between.  Whoever reads the
name in the catalog without this class sees the columns of the files, and rows deleted by position.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell.plans.workspace import fresh_path
from foretell.sources import files

STATE = "foretell.state."
FILE, PLACE = "_file", "_place"  # where a row stands
VECTORS = 16  # folders of deleted positions above which they become one


class StoredTable:
    """A table of the catalog under its quoted name."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.target)

    def _folder(self) -> str:
        """The last part of the folder that the name points to."""
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.target}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"].rstrip("/").rsplit("/", 1)[-1]

    def state(self) -> dict:
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.target}").where(F.col("key") == STATE + self._folder()).collect()
        return json.loads(found[0]["value"]) if found else {}

    def _set_state(self, folder: str, state: dict) -> None:
        value = json.dumps(state).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {self.target} SET TBLPROPERTIES ('{STATE}{folder}' = '{value}')")

    def _columns(self, state: dict, whole: DataFrame) -> list:
        """``(name, name in the files, metadata)`` in order."""
        return state.get("columns") or [[f.name, f.name, f.metadata] for f in whole.schema.fields]

    def read(self, places: bool = False) -> DataFrame:
        """The rows as they are now; with ``places`` also where each stands in the files."""
        state, whole = self.state(), self.spark.table(self.target)
        out = [F.col(f"`{file}`").alias(name, metadata=meta) for name, file, meta in self._columns(state, whole)]
        if not state.get("deleted") and not places:
            return whole.select(*out) if state else whole
        rows = whole.select(*out, F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(PLACE))
        if state.get("deleted"):
            rows = rows.join(self.spark.read.parquet(*state["deleted"]), [FILE, PLACE], "left_anti")
        return rows if places else rows.drop(FILE, PLACE)

    def write(self, df: DataFrame) -> None:
        """A new version with these rows and columns."""
        path = fresh_path(self.spark, "table")
        if not self.exists():
            files.write_parquet(df, path)
            self.spark.catalog.createTable(self.target, path=path, source="parquet")
            return
        columns = [self._column_for(f) for f in df.schema.fields]
        whole = self.spark.table(self.target)
        self._put(df, columns, whole).write.parquet(path)
        if [c[:2] for c in columns] != [[c, c] for c in whole.columns] or any(whole.schema[c[1]].metadata != c[2] for c in columns):
            self._set_state(path.rsplit("/", 1)[-1], {"columns": columns})
        self.spark.sql(f"ALTER TABLE {self.target} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.target)

    def _put(self, df: DataFrame, columns: list, whole: DataFrame) -> DataFrame:
        """Rows by the columns of the files; those without a name are null."""
        by_file = {file: name for name, file, _ in columns}
        return df.select(*[(F.col(f"`{by_file[f.name]}`") if f.name in by_file else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in whole.schema.fields])

    def _column_for(self, field: T.StructField) -> list:
        """The column of the files that a new version of this field goes to; one is added if none fits."""
        known = {f.name.lower(): f for f in self.spark.table(self.target).schema.fields}
        for file in (field.name, *(f"{field.name}__{i}" for i in range(2, len(known) + 2))):
            if file.lower() not in known:
                self._add(file, field.dataType)
                return [field.name, file, field.metadata]
            if known[file.lower()].dataType == field.dataType:
                return [field.name, known[file.lower()].name, field.metadata]
        raise AssertionError("there are more names than columns")

    def _add(self, file: str, kind: T.DataType, default: Column | None = None) -> None:
        filled = ""
        if default is not None:
            value = self.spark.sql("SELECT 1 AS one").select(default.cast(kind).alias("v")).first()["v"]
            text = str(value).replace("\\", "\\\\").replace("'", "\\'")
            filled = f" DEFAULT CAST('{text}' AS {kind.simpleString()})"
        self.spark.sql(f"ALTER TABLE {self.target} ADD COLUMNS (`{file}` {kind.simpleString()}{filled})")

    def add_rows(self, df: DataFrame) -> None:
        whole = self.spark.table(self.target)
        self._put(df, self._columns(self.state(), whole), whole).write.mode("append").insertInto(self.target)

    def add_column(self, field: T.StructField, default=None) -> None:
        """Adds or replaces a column that holds ``default`` in all rows; no job over the data."""
        state, whole = self.state(), self.spark.table(self.target)
        columns, known = self._columns(state, whole), {c.lower() for c in whole.columns}
        file = next(n for n in (field.name, *(f"{field.name}__{i}" for i in range(2, len(known) + 3))) if n.lower() not in known)
        self._add(file, field.dataType, None if default is None else F.lit(default))
        added = [field.name, file, field.metadata]
        listed = [added if c[0] == field.name else c for c in columns]
        self._set_state(self._folder(), {**state, "columns": listed if added in listed else [*listed, added]})

    def drop_column(self, name: str) -> None:
        state, whole = self.state(), self.spark.table(self.target)
        columns = self._columns(state, whole)
        if name not in [c[0] for c in columns]:
            raise ValueError(f"no column {name!r}, there are {[c[0] for c in columns]}")
        self._set_state(self._folder(), {**state, "columns": [c for c in columns if c[0] != name]})

    def delete(self, matched: DataFrame) -> None:
        """Leaves out the rows of ``matched``, which holds their places."""
        state = self.state()
        path = fresh_path(self.spark, "deleted")
        matched.select(FILE, PLACE).write.parquet(path)
        if self.spark.read.parquet(path).isEmpty():
            return
        vectors = [*state.get("deleted", []), path]
        if len(vectors) > VECTORS:
            merged = fresh_path(self.spark, "deleted")
            self.spark.read.parquet(*vectors).repartition(FILE).sortWithinPartitions(FILE, PLACE).write.parquet(merged)
            vectors = [merged]
        self._set_state(self._folder(), {**state, "deleted": vectors})


