"""Helpers the tests import; fixtures stay in conftest.py, whose name every folder may use."""

from __future__ import annotations


def rows(df, *order):
    """Rows as tuples, sorted."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
