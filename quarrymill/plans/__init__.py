"""Bindings of the operators to tables, as registered queries with their SQL."""


def all_queries() -> tuple[dict, dict]:
    """(queries by name, SQL by name)."""
    from . import assembly, demand, ingest, more, records, replenishment, review, scoping, series, stores
    from .registry import ORACLES, QUERIES

    del assembly, demand, ingest, more, records, replenishment, review, scoping, series, stores  # importing them registers their queries
    return dict(QUERIES), dict(ORACLES)
