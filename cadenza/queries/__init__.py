"""Registered queries by survey section."""

from importlib import import_module

MODULES = ["sources", "columns", "filters", "joins", "aggregates", "ordering", "scalars", "scaling",
           "vectors", "text", "recommenders", "evaluation", "learning", "jobs"]


def load_all():
    from cadenza.queries import base
    for m in MODULES:
        import_module(f"cadenza.queries.{m}")
    return base.QUERIES, base.SQL
