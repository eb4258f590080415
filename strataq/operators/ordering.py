"""Sort keys: nulls last when ascending, first when descending."""

from strataq.errors import QueryRefused
from strataq.operators.predicates import ref


def sort_key(name: str, direction: str = "asc"):
    if not isinstance(name, str):
        raise QueryRefused("ORDER BY takes column names, not expressions")
    if direction not in ("asc", "desc"):
        raise QueryRefused(f"unknown sort direction {direction!r}")
    c = ref(name)
    return c.asc_nulls_last() if direction == "asc" else c.desc_nulls_first()


def whole(n, what: str) -> int:
    """A LIMIT or OFFSET: a non-negative int, never silently ignored."""
    if isinstance(n, bool) or not isinstance(n, int) or n < 0:
        raise QueryRefused(f"{what} must be a non-negative whole number, not {n!r}")
    return n
