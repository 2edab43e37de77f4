"""Assemble one DuckDB statement per query: ``WITH <needed CTEs> SELECT ...``."""

from __future__ import annotations

import re
from functools import lru_cache

from ..context import Ctx, default_ctx
from .adapters import adapter_ctes
from .features import feature_ctes
from .text import Sql


@lru_cache(maxsize=4)
def _ctes(ctx: Ctx) -> dict[str, str]:
    q = Sql(ctx)
    out = dict(adapter_ctes(q))
    out.update(feature_ctes(q))
    return out


def _deps(ctes: dict[str, str], name: str, seen: list[str]) -> None:
    if name in seen:
        return
    body = ctes[name]
    for other in ctes:
        if other != name and re.search(rf"(?<![\w.]){re.escape(other)}(?!\w)", body):
            _deps(ctes, other, seen)
    seen.append(name)


def with_ctes(final_sql: str, ctx: Ctx | None = None) -> str:
    """Prefix ``final_sql`` with every CTE it (transitively) references."""
    ctes = _ctes(ctx or default_ctx())
    order: list[str] = []
    for other in ctes:
        if re.search(rf"(?<![\w.]){re.escape(other)}(?!\w)", final_sql):
            _deps(ctes, other, order)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({ctes[n]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


def oracle_query(name: str, ctx: Ctx | None = None) -> str:
    """SQL of feature ``name`` (e.g. ``fe23``) over the pre-registered test tables."""
    return with_ctes(f"SELECT * FROM {name}", ctx)


def oracle_names(ctx: Ctx | None = None) -> list[str]:
    return [n for n in _ctes(ctx or default_ctx()) if re.fullmatch(r"fe\d\d", n)]
