"""Every operator as a query over the given tables, next to independent SQL computing the same rows."""

from stratamart.registry import dimensions, facts, keyed, loads, quality, scd, sources, stations, streams

MODULES = (facts, dimensions, keyed, scd, stations, sources, quality, streams, loads)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
