"""Registered queries and their SQL, by name."""

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register
