"""Checked queries over the generated tables."""


def all_queries():
    """(queries, oracles) after loading every query module."""
    from parcelmood.checks import base, models, prep, scoring, stats  # noqa: F401

    return base.QUERIES, base.ORACLES
