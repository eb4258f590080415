"""The five aggregate functions, each with an optional DISTINCT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataq.errors import QueryRefused
from strataq.operators.predicates import ref

FUNCTIONS = ("count", "sum", "avg", "min", "max")


def check(fn: str, name: str | None, distinct: bool) -> None:
    if fn not in FUNCTIONS:
        raise QueryRefused(f"aggregate {fn!r} is not one of {', '.join(FUNCTIONS)}")
    if name is None:
        if fn != "count" or distinct:
            raise QueryRefused(f"{fn} needs a column")
    elif not isinstance(name, str):
        raise QueryRefused("an aggregate takes a column name, not an expression")


def aggregate(fn: str, name: str | None = None, distinct: bool = False) -> Column:
    """``count`` without a name counts rows; the others skip NULLs, and sum, avg, min and max over no
    values are NULL. sum and avg stay numeric."""
    check(fn, name, distinct)
    if name is None:
        return F.count(F.lit(1))
    c = ref(name)
    if fn in ("min", "max"):
        return getattr(F, fn)(c)
    if fn == "count":
        return F.count_distinct(c) if distinct else F.count(c)
    if fn == "sum":
        return F.sum_distinct(c) if distinct else F.sum(c)
    return F.call_function("avg", c) if not distinct else F.expr(f"avg(DISTINCT {_quoted(name)})")


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))
