"""Independent DuckDB SQL of the same semantics, used as the test oracle.

The SQL evaluates local times literally (``timezone(zone, ts)`` per row) and
uses window ``ROW_NUMBER`` / fan-out joins as written in the reference,
while the Spark plans use precomputed epoch-ms bounds, grouped maxima,
existence joins and the bucketed percent rank -- so agreement checks the
rewrites, not a copy of them.
"""

from .sql import oracle_query, oracle_names

__all__ = ["oracle_query", "oracle_names"]
