"""The operators bound to the driver's tables, each with a SQL counterpart for checking."""

from ledgerline.catalog import names, relations, scalars, stints, storage  # noqa: F401
from ledgerline.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
