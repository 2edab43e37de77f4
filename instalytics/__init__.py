"""instalytics: consumer-level instalment-credit features as Spark DataFrame plans.

Layout: ``functions`` (column helpers), ``operators`` (reusable DataFrame
operators), ``sources`` (schemas, readers, test-table adapters), ``plans``
(the 33 feature functions and the master), ``oracle`` (independent DuckDB SQL
of the same semantics, for tests), no streaming operators.
"""

from .context import NO_DATE, NO_DATETIME, Ctx, default_ctx

__all__ = ["Ctx", "default_ctx", "NO_DATE", "NO_DATETIME"]
