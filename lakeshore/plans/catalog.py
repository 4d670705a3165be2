"""The full query catalog: importing the key modules fills the registry."""

from __future__ import annotations

from . import keys_changes, keys_flows, keys_functions, keys_governed, keys_landing, keys_tables  # noqa: F401
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
