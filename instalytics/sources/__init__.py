"""Inputs: declared schemas, warehouse reader, test-table adapters."""

from .bundle import Sources, read_warehouse, scan
from .schemas import SCHEMAS

__all__ = ["Sources", "read_warehouse", "scan", "SCHEMAS"]
