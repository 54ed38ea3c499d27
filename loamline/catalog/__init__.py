"""Name → query and name → equivalent SQL."""

from loamline.catalog import queries_quality, queries_readings, queries_runs, queries_storage

_MODULES = (queries_readings, queries_quality, queries_storage, queries_runs)


def queries():
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
