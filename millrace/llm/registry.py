"""Queries by name, apart from the library's own registry."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register
