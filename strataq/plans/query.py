"""The immutable query builder. Every method returns a new Query; ``to_df`` gives a lazy DataFrame."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.errors import QueryRefused, ScanLimitExceeded, UnsupportedWhere
from strataq.operators import predicates as P
from strataq.operators.aggregates import aggregate, check
from strataq.operators.joins import join_pairs
from strataq.operators.ordering import sort_key, whole
from strataq.operators.setops import combine


@dataclass(frozen=True)
class Item:
    """One selected column or aggregate."""

    alias: str
    name: str | None = None
    fn: str | None = None
    distinct: bool = False


def col_as(name: str, alias: str) -> Item:
    return Item(alias, name)


def agg(fn: str, name: str | None = None, alias: str | None = None, distinct: bool = False) -> Item:
    if not alias:
        raise QueryRefused("an aggregate needs an alias")
    check(fn, name, distinct)
    return Item(alias, name, fn, distinct)


@dataclass(frozen=True)
class Join:
    table: str
    alias: str
    pairs: tuple
    kind: str
    many: bool = False


@dataclass(frozen=True)
class Query:
    """``root`` is a table's name, or the query whose rows are read."""

    catalog: object
    root: object
    alias: str
    joins: tuple = ()
    filters: tuple = ()
    items: tuple | None = None
    groups: tuple = ()
    order: tuple = ()
    n: int | None = None
    skip: int = 0
    branches: tuple = ()
    max_scanned: int | None = None

    @classmethod
    def table(cls, catalog, name: str, alias: str | None = None, max_scanned: int | None = None) -> Query:
        """``max_scanned``: how many rows the root's scan may read only for a filter to throw them away. Filters that a
        Parquet scan takes over (comparisons with literals, IN, BETWEEN, empty tests, prefixes) cost nothing; of the rows
        that they leave, those that the other filters reject are counted when the query runs, which then fails."""
        if not isinstance(name, str):
            raise QueryRefused("a query reads from exactly one root table")
        return cls(catalog, name, alias or name, max_scanned=max_scanned)

    # projections
    def select(self, *items) -> Query:
        """Names, ``"name as alias"`` texts, ``col_as`` and ``agg`` items; expressions are refused."""
        out = []
        for x in items:
            if isinstance(x, str):
                name, _, alias = x.partition(" as ")
                x = Item(alias.strip() or name.strip().split(".")[-1], name.strip())
            if not isinstance(x, Item):
                raise QueryRefused("computed expressions can't be selected; name a column or an aggregate")
            out.append(x)
        q = self._opened()
        return replace(q, items=(q.items or ()) + tuple(out))

    def select_all(self) -> Query:
        return replace(self._opened(), items=None)

    # filters
    def where(self, column, op: str | None = None, value=None, **how) -> Query:
        """``where(predicate)`` or ``where(name, operator, literal)``."""
        q = self._opened()
        if isinstance(column, Column) and op is None:
            return replace(q, filters=q.filters + ((column,),))
        if not isinstance(column, str):
            raise UnsupportedWhere("the left side of a filter must be a column name")
        return replace(q, filters=q.filters + ((column, op, value, how),))

    def where_ref(self, left: str, op: str, right: str) -> Query:
        return self.where(P.column_comparison(left, op, right))

    # grouping, order, limit
    def group_by(self, *names: str) -> Query:
        if not all(isinstance(x, str) for x in names):
            raise QueryRefused("GROUP BY takes column names")
        q = self._opened()
        return replace(q, groups=q.groups + names)

    def order_by(self, name: str, direction: str = "asc") -> Query:
        if not isinstance(name, str) or direction not in ("asc", "desc"):
            raise QueryRefused("ORDER BY takes column names and asc or desc")
        return replace(self, order=self.order + ((name, direction),))

    def limit(self, n: int) -> Query:
        return replace(self, n=whole(n, "LIMIT"))

    def offset(self, n: int) -> Query:
        return replace(self, skip=whole(n, "OFFSET"))

    # joins
    def join(self, table: str, *pairs, kind: str = "inner", alias: str | None = None, many: bool = False) -> Query:
        """``many``: keys repeat on both sides, so that far more rows come out than go in; the rows are the same."""
        q, j = self._opened(), Join(table, alias or table, tuple(pairs), kind, many)
        if j.alias in {q.alias, *(x.alias for x in q.joins)}:
            raise QueryRefused(f"{j.alias} is joined twice; give it an alias")
        return replace(q, joins=q.joins + (j,))

    def left_join(self, table, *pairs, alias=None, many=False):
        return self.join(table, *pairs, kind="left", alias=alias, many=many)

    def right_join(self, table, *pairs, alias=None, many=False):
        return self.join(table, *pairs, kind="right", alias=alias, many=many)

    def full_join(self, table, *pairs, alias=None):
        return self.join(table, *pairs, kind="full", alias=alias)

    def _opened(self) -> Query:
        """Clauses after a set operation hold for its combined rows: they go to a query that reads these."""
        return Query(self.catalog, self, self.alias) if self.branches else self

    # set operations: a left fold; order, limit and offset given afterwards hold for the whole
    def _combine(self, op: str, other) -> Query:
        if not isinstance(other, (Query, DataFrame)):
            raise QueryRefused("a set operation takes another query")
        if self.branches and not (self.order or self.n is not None or self.skip):
            return replace(self, branches=self.branches + ((op, other),))
        return Query(self.catalog, self.root, self.alias, branches=(("", self), (op, other)))

    def union(self, other, all: bool = False):
        return self._combine("union all" if all else "union", other)

    def intersect(self, other, all: bool = False):
        return self._combine("intersect all" if all else "intersect", other)

    def except_(self, other, all: bool = False):
        return self._combine("except all" if all else "except", other)

    # refused, never ignored
    def _refuse(self, *_, **__):
        raise QueryRefused("HAVING, DISTINCT, CTEs, window functions and raw SQL are not part of this builder")

    having = distinct = distinct_on = with_ = window = raw = cross_join = returning = on_conflict = _refuse

    # compilation
    def to_df(self) -> DataFrame:
        if self.branches:
            frames = [(op, b.to_df() if isinstance(b, Query) else b) for op, b in self.branches]
            df = frames[0][1]
            for op, right in frames[1:]:
                df = combine(df, right, op)
            return self._slice(self._sorted(df))
        df, types = self._read(self.root).alias(self.alias), self._types()
        if self.max_scanned is not None and (lost := self._lost(df, types)) is not None:
            stop = F.raise_error(F.lit(str(ScanLimitExceeded(self.root, self.max_scanned))))
            # below all other filters, so that it is met even where these leave no row
            df = df.where(F.when(lost > self.max_scanned, stop.cast("boolean")).otherwise(True))
        # tiles would keep filters from the scans, and are of no use to few rows out
        alone = len(self.joins) == 1 and not (self.filters or self.groups or self.order or self.n is not None or self.skip or any(i.fn for i in self.items or ()))
        wanted = None if self.items is None else [i.name for i in self.items]
        for j in self.joins:
            df = join_pairs(df, self._read(j.table).alias(j.alias), j.pairs, j.kind, j.many, (self.alias, j.alias) if alone else None, wanted)
        for f in self.filters:
            df = df.where(self._condition(types, f))
        items = self.items
        if self.groups or any(i.fn for i in items or ()):
            return self._slice(self._sorted(self._grouped(df, items or ())))
        if items is None:
            names = [P.member(a, c).alias(f"{a}.{c}" if self.joins else c) for a, c in self._columns()]
            # sorted first: a sort key may be named with or without its table
            return self._slice(self._sorted(df)).select(*names)
        aliases = {i.alias for i in items}
        if len(aliases) < len(items):
            raise QueryRefused("two selected columns have the same name; alias one")
        if self.order and all(n in aliases for n, _ in self.order):
            return self._slice(self._sorted(df.select(*(P.ref(i.name).alias(i.alias) for i in items))))
        return self._slice(self._sorted(df)).select(*(P.ref(i.name).alias(i.alias) for i in items))

    def collect(self) -> list:
        """The rows; a budget that is exceeded raises ScanLimitExceeded."""
        try:
            return self.to_df().collect()
        except PySparkException as e:
            if self.max_scanned is not None and ScanLimitExceeded.MARK in str(e):
                raise ScanLimitExceeded(self.root, self.max_scanned) from e
            raise

    def _read(self, table) -> DataFrame:
        return table.to_df() if isinstance(table, Query) else self.catalog.table(table)

    def _condition(self, types: dict, f: tuple) -> Column:
        return f[0] if len(f) == 1 else self._predicate(types, *f)

    def _lost(self, root: DataFrame, types: dict) -> Column | None:
        """How many of the root's rows its filters beyond the scan's own reject, counted as a part of the query."""
        own = {n for c in root.columns for n in (c, f"{self.alias}.{c}")}
        mine = [f for f in self.filters if (f[0] in own if len(f) > 1 else not self.joins)]
        scan = [f for f in mine if _scanned(f) and not P.mixed(types[f[0]], f[2])]
        rest = [f for f in mine if f not in scan]
        if not rest:  # an exact scan throws nothing away
            return None
        for f in scan:
            root = root.where(self._condition(types, f))
        lost = root.where(~F.coalesce(P.all_(*(self._condition(types, f) for f in rest)), F.lit(False)))
        return lost.limit(self.max_scanned + 1).agg(F.count(F.lit(1))).scalar()

    def _columns(self):
        for t, a in ((self.root, self.alias), *((j.table, j.alias) for j in self.joins)):
            hidden = self.catalog.hidden(t) if isinstance(t, str) else ()
            yield from ((a, c) for c in self._read(t).columns if c not in hidden)

    def _types(self) -> dict:
        out = {}
        for t, a in ((self.root, self.alias), *((j.table, j.alias) for j in self.joins)):
            for f in self._read(t).schema.fields:
                out[f"{a}.{f.name}"] = f.dataType.typeName()
                out.setdefault(f.name, f.dataType.typeName())
        return out

    def _predicate(self, types: dict, name: str, op: str, value, how: dict) -> Column:
        op, kind = str(op).lower(), types.get(name)
        if op in ("is", "is not"):
            if value is not None:
                raise UnsupportedWhere("IS compares with null only")
            return (P.is_empty if op == "is" else P.is_not_empty)(name, text=kind == "string")
        if op in ("in", "not in"):
            if value is None or isinstance(value, (str, Query, DataFrame, Column)):
                raise UnsupportedWhere("IN takes a list of literals; subqueries are not supported")
            values = [_literal(v, kind) for v in value]
            if any(P.mixed(kind, v) for v in values):
                some = P.any_(*(P.compared(name, "=", v, kind) for v in values))
                return P.negate(some) if op == "not in" else some
            return P.one_of(name, values, op == "not in")
        if op in ("like", "ilike"):
            return P.matches(name, value, op == "ilike")
        if op == "between":
            lo, hi = (_literal(v, kind) for v in value)
            return P.all_(P.compared(name, ">=", lo, kind), P.compared(name, "<=", hi, kind))
        if isinstance(value, (Query, DataFrame, Column)):
            raise UnsupportedWhere("a filter compares with a literal; use where_ref for columns")
        return P.comparison(name, op, value, **how) if how else P.compared(name, op, _literal(value, kind), kind)

    def _grouped(self, df: DataFrame, items) -> DataFrame:
        short = {g.split(".")[-1] for g in self.groups} | set(self.groups)
        for i in items:
            if not i.fn and i.name not in short:
                raise QueryRefused(f"{i.name} is neither grouped nor aggregated")
        aggs = [aggregate(i.fn, i.name, i.distinct).alias(i.alias) for i in items if i.fn]
        if not self.groups:
            if len(aggs) < len(items):
                raise QueryRefused("plain columns beside aggregates need GROUP BY")
            return df.agg(*aggs)
        keys = {g: next((i.alias for i in items if not i.fn and i.name in (g, g.split(".")[-1])), g.split(".")[-1]) for g in self.groups}
        cols = [P.ref(g).alias(f"__{k}") for k, g in enumerate(self.groups)]
        out = df.groupBy(*cols).agg(*aggs) if aggs else df.select(*cols).distinct()
        at = {alias: f"__{k}" for k, alias in enumerate(keys.values())}
        chosen = [i.alias for i in items] if items else list(keys.values())
        return out.select(*(P.ref(at.get(a, a)).alias(a) for a in chosen))

    def _sorted(self, df: DataFrame) -> DataFrame:
        return df.orderBy(*(sort_key(n, d) for n, d in self.order)) if self.order else df

    def _slice(self, df: DataFrame) -> DataFrame:
        df = df.offset(self.skip) if self.skip else df
        return df if self.n is None else df.limit(self.n)


def _scanned(f: tuple) -> bool:
    """Whether a Parquet scan decides a filter by itself."""
    if len(f) == 1 or f[3]:
        return False
    op, value = str(f[1]).lower(), f[2]
    if isinstance(value, (list, tuple)) and any(isinstance(v, str) and re.match(P.NUMERIC, v) for v in value):
        return False
    if op == "like":
        return isinstance(value, str) and not set("_\\") & set(value) and "%" not in value[:-1]
    return op != "ilike" and not isinstance(value, (Query, DataFrame, Column))


def _literal(value, kind: str | None):
    """Booleans also take 'true', 'false' and numbers; times also take ISO text."""
    if kind == "boolean" and isinstance(value, str):
        return {"true": True, "false": False}.get(value)
    if kind == "boolean" and isinstance(value, (int, float)) and not isinstance(value, bool):
        return value != 0
    if kind in ("timestamp", "timestamp_ntz") and isinstance(value, str):
        return datetime.fromisoformat(value)
    if kind in ("timestamp", "timestamp_ntz") and isinstance(value, date) and not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    return value
