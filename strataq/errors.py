"""Refusals. A request without an exact meaning raises one of these instead of guessing."""


class QueryRefused(ValueError):
    """The request is outside the builder's surface."""


class UnsupportedWhere(QueryRefused):
    """A filter that has no exact three-valued meaning here."""


class UnsupportedJoin(QueryRefused):
    """A join that is not an AND of column equalities, or of an unknown kind."""


class UnknownTable(KeyError):
    def __init__(self, name, known):
        self.name, self.known = name, sorted(known)
        super().__init__(f"no table named {name!r}; known tables: {', '.join(self.known) or 'none'}")

    def __str__(self):
        return self.args[0]


class ScanLimitExceeded(RuntimeError):
    """A scan reads more rows than allowed that a filter then throws away."""

    MARK = "exceeds the scan budget"

    def __init__(self, table, limit):
        self.table, self.limit = table, limit
        super().__init__(f"a query of {table!r} {self.MARK}: its filters throw away more than {limit} rows; narrow them or raise max_scanned")
