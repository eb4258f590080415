"""Writes as DataFrames, and Parquet sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strataq.errors import QueryRefused
from strataq.operators.predicates import ref
from strataq.sources.catalog import ARCHIVED


def _literals(values: dict) -> dict:
    for k, v in values.items():
        if isinstance(v, Column) or callable(v) or hasattr(v, "to_df"):
            raise QueryRefused(f"{k}: only literal values can be written")
    return values


def _known(df: DataFrame, names) -> None:
    if extra := set(names) - (set(df.columns) - {ARCHIVED}):
        raise QueryRefused(f"no such column: {', '.join(sorted(extra))}")


def _hit(df: DataFrame, where: Column | None) -> Column:
    """TRUE for the live rows that ``where`` holds for; UNKNOWN is no hit."""
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return hit & ~F.col(ARCHIVED) if ARCHIVED in df.columns else hit


def new_rows(df: DataFrame, rows: list[dict]) -> DataFrame:
    """Rows to add to a table; columns a row leaves out are NULL. Unknown columns are refused."""
    for r in rows:
        _literals(r)
        _known(df, r)
    schema = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
    return df.sparkSession.createDataFrame([tuple(False if c == ARCHIVED else r.get(c) for c in df.columns) for r in rows], schema)


def insert(df: DataFrame, rows: list[dict]) -> DataFrame:
    """The table with rows added."""
    return df.unionByName(new_rows(df, rows)) if rows else df


def update(df: DataFrame, where: Column | None, patch: dict) -> DataFrame:
    """Merge literals into the rows for which ``where`` is TRUE; UNKNOWN leaves a row as it is."""
    _known(df, _literals(patch))
    hit = _hit(df, where)
    return df.withColumns({c: F.when(hit, F.lit(v).cast(df.schema[c].dataType)).otherwise(ref(c)) for c, v in patch.items()})


def archive(df: DataFrame, where: Column | None) -> DataFrame:
    """Mark rows as archived, in a column of their own; nothing is removed. ``live`` hides them."""
    was = F.col(ARCHIVED) if ARCHIVED in df.columns else F.lit(False)
    return df.withColumn(ARCHIVED, was | _hit(df, where))


def live(df: DataFrame) -> DataFrame:
    return df.where(~F.col(ARCHIVED)).drop(ARCHIVED) if ARCHIVED in df.columns else df


@dataclass(frozen=True)
class Written:
    """What a write did: ``rows`` as they now are (none, for a delete), and how many rows it affected."""

    rows: DataFrame
    affected: int


class Store:
    """Named tables with writes. A delete archives: the rows leave every query of the catalog but stay stored, and
    ``restore`` brings them back; it is refused unless it was allowed.

    With ``folder``, tables outlive the session: an insert appends files to the table's newest version there, an update,
    delete or restore writes a new version, and a Store that is opened on the folder later reads the newest ones."""

    def __init__(self, catalog, allow_archiving_delete: bool = False, folder: str | None = None):
        self.catalog, self.allow_archiving_delete, self.folder = catalog, allow_archiving_delete, folder and folder.rstrip("/")
        if folder:
            for name in self._listed(self.folder):
                if versions := self._versions(name):
                    self._register(name, self._version(name, versions[-1]))

    def insert(self, name: str, rows: list[dict]) -> Written:
        df = self.catalog.stored(name)
        new = new_rows(df, rows)
        if rows and self.folder and (versions := self._versions(self._stored(name))):
            at = f"{self.folder}/{self._stored(name)}/{versions[-1]}"
            new.write.mode("append").parquet(at)
            self._register(self._stored(name), self._version(self._stored(name), versions[-1]))
        else:
            self._put(name, insert(df, rows))
        return Written(live(new), len(rows))

    def update(self, name: str, where: Column | None, patch: dict) -> Written:
        df = self.catalog.stored(name)
        done = update(df, where, patch)  # the filter is of the rows as they were
        flagged = update(df.withColumn("__hit", _hit(df, where)), where, patch).where("__hit").drop("__hit")
        affected = df.where(_hit(df, where)).count()
        self._put(name, done)
        return Written(live(flagged), affected)

    def delete(self, name: str, where: Column | None) -> Written:
        if not self.allow_archiving_delete:
            raise QueryRefused("a delete archives rows; pass allow_archiving_delete=True to accept that")
        df = self.catalog.stored(name)
        affected = df.where(_hit(df, where)).count()
        self._put(name, archive(df, where))
        return Written(live(df).limit(0), affected)

    def restore(self, name: str, where: Column | None) -> Written:
        """Archived rows that ``where`` holds for are live again."""
        df = self.catalog.stored(name)
        if ARCHIVED not in df.columns:
            return Written(df.limit(0), 0)
        back = F.col(ARCHIVED) & (F.lit(True) if where is None else F.coalesce(where, F.lit(False)))
        rows = df.where(back)
        self._put(name, df.withColumn(ARCHIVED, F.col(ARCHIVED) & ~back))
        return Written(rows.drop(ARCHIVED), rows.count())

    def save(self, name: str, path: str, mode: str = "errorifexists") -> None:
        self.catalog.table(name).write.mode(mode).parquet(path)

    def _stored(self, name: str) -> str:
        return self.catalog.overrides.get(name, name)

    def _register(self, stored: str, df: DataFrame) -> None:
        self.catalog.register(stored, df)
        self.catalog._resolved.clear()  # names that override to this one too

    def _put(self, name: str, df: DataFrame) -> None:
        stored = self._stored(name)
        if self.folder:
            version = f"v{len(self._listed(f'{self.folder}/{stored}')):06d}"
            df.write.parquet(f"{self.folder}/{stored}/{version}")
            df = self._version(stored, version)
        self._register(stored, df)

    def _version(self, stored: str, version: str) -> DataFrame:
        return self.catalog.spark.read.parquet(f"{self.folder}/{stored}/{version}")

    def _listed(self, folder: str) -> list[str]:
        spark = self.catalog.spark
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _versions(self, stored: str) -> list[str]:
        """The versions that were written to their end."""
        return [v for v in self._listed(f"{self.folder}/{stored}") if "_SUCCESS" in self._listed(f"{self.folder}/{stored}/{v}")]

    def begin(self):
        raise QueryRefused("transactions are not supported")

    commit = rollback = begin

    def execute_raw(self, *_):
        raise QueryRefused("raw SQL and DDL are not supported")
