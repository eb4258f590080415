"""Names to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.errors import UnknownTable

#: System columns that a table shows when it has no column of that name itself. ``select_all`` shows the first alone.
SYSTEM = ("id", "createdAt", "updatedAt")
#: Marks archived rows of a stored table; no query sees it, or them.
ARCHIVED = "__archived"


class Catalog:
    """Resolves a table name: registered DataFrames and views first, then ``<path>/<name>.parquet``.

    ``overrides`` maps the names used in queries to stored names. Resolved DataFrames are kept; a
    failure never is. Listing known tables for an error goes through Spark's own file system layer,
    so any store that Spark reads will do.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, tables: dict | None = None,
                 overrides: dict | None = None, system: dict | None = None):
        self.spark, self.path = spark, path
        self.tables, self.overrides = dict(tables or {}), dict(overrides or {})
        self.system, self._resolved = dict(system or {}), {}

    def register(self, name: str, df: DataFrame) -> Catalog:
        self.tables[name] = df
        self._resolved.pop(name, None)
        return self

    def known(self) -> list[str]:
        names = set(self.tables) | set(self.overrides)
        if self.path:
            jvm = self.spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(self.path)
            fs = p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
            if fs.exists(p):
                names |= {s.getPath().getName().removesuffix(".parquet") for s in fs.listStatus(p)
                          if s.getPath().getName().endswith(".parquet")}
        return sorted(names)

    def hidden(self, name: str) -> set[str]:
        """System columns that can be named but are no part of ``select_all``."""
        own = self.stored(name).columns
        return {c for c in self.system.get(name, {}) if c in SYSTEM[1:] and c not in own}

    def table(self, name: str) -> DataFrame:
        """The live rows of a table, with its system columns."""
        if name in self._resolved:
            return self._resolved[name]
        df = self.stored(name)
        own = df.columns
        if ARCHIVED in own:
            df = df.where(~F.col(ARCHIVED)).drop(ARCHIVED)
        for column, value in self.system.get(name, {}).items():
            if column in SYSTEM and column not in own:  # a real field wins
                df = df.withColumn(column, value if not isinstance(value, str) else F.col(value))
        self._resolved[name] = df
        return df

    def stored(self, name: str) -> DataFrame:
        """A table as it is stored, with archived rows and the mark that tells them."""
        stored = self.overrides.get(name, name)
        if stored in self.tables:
            return self.tables[stored]
        if self.path and stored in self.known():
            return self.spark.read.parquet(f"{self.path}/{stored}.parquet")
        if self.spark.catalog.tableExists(stored):
            return self.spark.table(stored)
        raise UnknownTable(name, self.known())
