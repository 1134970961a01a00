"""Collects the named queries and their SQL counterparts."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a function (spark, folder) -> DataFrame, with the SQL that must agree with it."""
    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register
