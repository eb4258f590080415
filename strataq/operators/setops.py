"""Bag and set operators, by position. NULL equals NULL."""

from pyspark.sql import DataFrame

from strataq.errors import QueryRefused

OPS = {
    "union": lambda a, b: a.union(b).distinct(),
    "union all": lambda a, b: a.union(b),
    "intersect": lambda a, b: a.intersect(b),
    "intersect all": lambda a, b: a.intersectAll(b),
    "except": lambda a, b: a.subtract(b),
    "except all": lambda a, b: a.exceptAll(b),
}


def combine(left: DataFrame, right: DataFrame, op: str) -> DataFrame:
    """Branches must agree in column count and types, so that 1 never meets '1' by coercion."""
    if op not in OPS:
        raise QueryRefused(f"set operation {op!r} is not one of {', '.join(OPS)}")
    a, b = ([f.dataType for f in x.schema.fields] for x in (left, right))
    if len(a) != len(b):
        raise QueryRefused(f"set operation branches have {len(a)} and {len(b)} columns")
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if x != y and not {x.typeName(), y.typeName()} <= {"byte", "short", "integer", "long"}:
            raise QueryRefused(f"column {i + 1} is {x.simpleString()} on the left and {y.simpleString()} on the right")
    return OPS[op](left, right)
