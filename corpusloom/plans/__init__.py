"""Registered queries by operator family; importing this package registers all of them."""

from . import catalogues, control, journals, portraits, records, runs, scalars, texts  # noqa: F401
from .registry import QUERIES, SQL, Tables

__all__ = ["QUERIES", "SQL", "Tables"]
