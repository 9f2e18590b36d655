"""Query registry: name -> (spark, sf_dir) function, and name -> SQL."""

QUERIES = {}
ORACLE = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add
