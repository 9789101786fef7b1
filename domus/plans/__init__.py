"""The query catalogue bound to the driver's tables (see ``registry``)."""

from domus.plans import q_cdc, q_columns, q_io, q_models, q_pages, q_stats  # noqa: F401  (registration)
from domus.plans.registry import REGISTRY, Entry  # noqa: F401


def queries():
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql():
    return {k: e.sql for k, e in REGISTRY.items() if e.sql}


def bench_queries():
    return {k: e.fn for k, e in REGISTRY.items() if e.bench}
