"""Predicate constructors. Each returns one boolean Column with Kleene logic, so Catalyst can push,
split and simplify it; there is no predicate tree of our own."""

from __future__ import annotations

import operator
import re
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataq.errors import UnsupportedWhere
from strataq.functions.patterns import normalise_like

#: Comparison spellings and what they compute.
OPERATORS = {
    "=": operator.eq, "==": operator.eq, "eq": operator.eq,
    "!=": operator.ne, "<>": operator.ne, "ne": operator.ne,
    ">": operator.gt, "gt": operator.gt, ">=": operator.ge, "gte": operator.ge,
    "<": operator.lt, "lt": operator.lt, "<=": operator.le, "lte": operator.le,
}


def ref(name: str | Column) -> Column:
    """A column by ``name`` or ``table.name``. A name that holds a dot is written in backquotes."""
    if isinstance(name, Column):
        return name
    if not isinstance(name, str) or not name:
        raise UnsupportedWhere(f"a column name is needed, not {name!r}")
    return F.col(name) if "`" in name else F.col(".".join(f"`{p}`" for p in name.split(".")))


def member(table: str, column: str) -> Column:
    return F.col(".".join("`" + p.replace("`", "``") + "`" for p in (table, column)))


def _op(op: str):
    if op not in OPERATORS:
        raise UnsupportedWhere(f"operator {op!r} is not supported")
    return OPERATORS[op]


def comparison(name, op: str, value, numeric_text: bool = False) -> Column:
    """column ⊕ literal. NULL on either side is UNKNOWN.

    ``numeric_text`` compares a text column as numbers; text that is no number is UNKNOWN."""
    left = ref(name)
    if numeric_text:
        left, value = left.try_cast("double"), _number(value)
    return _op(op)(left, F.lit(value).cast("double") if numeric_text else F.lit(value))


#: Text that reads as a number.
NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")


def _number(value) -> float | None:
    """The number that a literal is or reads as, else None."""
    if isinstance(value, str):
        return float(value) if re.match(NUMERIC, value) else None
    return float(value) if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool) else None


def mixed(kind: str | None, value) -> bool:
    """Whether a column of this type and a literal meet as text and number."""
    if kind == "string":
        return _number(value) is not None
    return kind in _NUMBERS and isinstance(value, str)


def compared(name, op: str, value, kind: str | None) -> Column:
    """column ⊕ literal by the column's type. Where text meets a number, or text that reads as one, values that read as
    numbers compare as numbers and all others as text; nothing fails at run time."""
    if not mixed(kind, value):
        return comparison(name, op, value)
    left, n, f = ref(name), _number(value), _op(op)
    if kind == "string":
        text = value if isinstance(value, str) else repr(int(value) if n == int(n) else n) if abs(n) < 2**53 else repr(value)
        return F.when(left.rlike(NUMERIC), f(left.try_cast("double"), F.lit(n))).otherwise(f(left, F.lit(text)))
    if n is not None:
        return f(left, F.lit(n))
    whole = left.cast("double") == F.floor(left.cast("double"))
    return f(F.when(whole & (F.abs(left) < 2**53), left.cast("bigint").cast("string")).otherwise(left.cast("string")), F.lit(value))


def column_comparison(left, op: str, right) -> Column:
    return _op(op)(ref(left), ref(right))


def matches(name, pattern: str, ci: bool = False) -> Column:
    """LIKE (``ci``: ILIKE) over the whole value; numbers and booleans are read as text."""
    if not isinstance(pattern, str):
        raise UnsupportedWhere("a LIKE pattern must be text")
    c, p = ref(name), normalise_like(pattern)
    return c.ilike(p) if ci else c.like(p)


def is_empty(name, text: bool = True) -> Column:
    """NULL, or for text columns the empty string too."""
    c = ref(name)
    return c.isNull() | (c == "") if text else c.isNull()


def is_not_empty(name, text: bool = True) -> Column:
    c = ref(name)
    return c.isNotNull() & (c != "") if text else c.isNotNull()


def one_of(name, values, negated: bool = False) -> Column:
    """IN / NOT IN a literal list. An empty IN is FALSE; an empty NOT IN holds for non-null values."""
    if isinstance(values, (str, bytes)) or not hasattr(values, "__iter__"):
        raise UnsupportedWhere("IN takes a list of literals")
    values, c = list(values), ref(name)
    if any(isinstance(v, Column) or hasattr(v, "to_df") for v in values):
        raise UnsupportedWhere("IN takes literals, not columns or subqueries")
    if not values:
        return c.isNotNull() if negated else F.lit(False)
    return ~c.isin(values) if negated else c.isin(values)


def in_range(name, lower, upper) -> Column:
    return ref(name).between(lower, upper)


def all_(*nodes: Column) -> Column:
    return reduce(operator.and_, nodes) if nodes else F.lit(True)


def any_(*nodes: Column) -> Column:
    return reduce(operator.or_, nodes) if nodes else F.lit(False)


def negate(node: Column) -> Column:
    return ~node


def always_true() -> Column:
    return F.lit(True)
