"""strataq: an immutable relational query builder that compiles to lazy Spark DataFrames."""

from strataq.errors import (
    QueryRefused,
    ScanLimitExceeded,
    UnknownTable,
    UnsupportedJoin,
    UnsupportedWhere,
)
from strataq.plans.query import Query, agg, col_as
from strataq.sources.catalog import Catalog
from strataq.sources.store import Store

__all__ = [
    "Catalog", "Query", "QueryRefused", "ScanLimitExceeded", "Store", "UnknownTable",
    "UnsupportedJoin", "UnsupportedWhere", "agg", "col_as",
]
