"""Time columns: epoch ms -> UTC / local wall clock, local-day windows.

All results are ``TIMESTAMP_NTZ`` / ``DATE`` and none depends on the session
time zone. Up to ``LITERAL_ZONES`` zones enter as literals, one ``CASE`` branch
per zone, so that each is resolved once; more are looked up in one map literal,
since that many branches would outgrow a generated method. What depends on the
run clock alone (local dates, bounds of windows) has one branch per different
value: a few dozen at most, however many countries there are.

Local-day windows are not evaluated by converting every row: for each country
the window is a half-open epoch-ms range computed on the driver, so the filter
is an OR of (country in cs AND lo <= ms < hi) terms that Parquet can push down.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..context import Ctx



def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utc_ts(ms) -> Column:
    """Epoch ms -> UTC wall clock, truncated to whole seconds (integer
    division toward zero, as the warehouse's ``ms / 1000`` on BIGINT)."""
    ms = _c(ms)
    return F.timestamp_add("MILLISECOND", ms - ms % 1000, epoch_ntz())


def epoch_ms(ts) -> Column:
    """TIMESTAMP_NTZ (read as UTC) -> epoch ms, sub-ms truncated."""
    return F.timestamp_diff("MILLISECOND", epoch_ntz(), _c(ts))


LITERAL_ZONES = 16


def _grouped(ctx: Ctx, value) -> list[tuple]:
    """(value, its countries): the countries of the context by equal values."""
    groups: dict = {}
    for c in ctx.countries:
        groups.setdefault(value(c), []).append(c)
    return list(groups.items())


def _one_of(country: Column, countries: list[str]) -> Column:
    return country == F.lit(countries[0]) if len(countries) == 1 else country.isin(countries)


def by_country(country, ctx: Ctx, value, fn, default) -> Column:
    """``fn(value(country))`` with one branch per different value, ``default``
    for other countries and null."""
    country, expr = _c(country), None
    for v, countries in _grouped(ctx, value):
        cond = _one_of(country, countries)
        expr = F.when(cond, fn(v)) if expr is None else expr.when(cond, fn(v))
    return default if expr is None else expr.otherwise(default)


def zone_of(country, ctx: Ctx) -> Column:
    """The zone's name, by one look-up in a map literal (UTC outside the map)."""
    pairs = [F.lit(x) for c in ctx.countries for x in (c, ctx.zone_name(c))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _c(country)), F.lit("UTC"))


def local_micros(country, ms, ctx: Ctx) -> Column:
    """Epoch ms -> local wall clock as microseconds since 1970-01-01 00:00.

    ``from_utc_timestamp`` with a literal zone keeps its resolved zone and
    only adds the zone offset of that instant to the raw microseconds (no
    session time zone involved); ``unix_micros`` reads the raw value back."""
    ms = _c(ms)
    secs = ms - ms % 1000
    utc = F.timestamp_millis(secs)
    if len({ctx.zone_name(c) for c in ctx.countries}) > LITERAL_ZONES:
        return F.unix_micros(F.from_utc_timestamp(utc, zone_of(country, ctx)))
    return by_country(country, ctx, ctx.zone_name, lambda z: F.unix_micros(F.from_utc_timestamp(utc, z)), secs * 1000)


def local_ts(country, ms, ctx: Ctx) -> Column:
    """Epoch ms -> local wall clock (``fn_in_local_tz`` of the reference)."""
    return F.timestamp_add("MICROSECOND", local_micros(country, ms, ctx), epoch_ntz())


def local_date(country, ms, ctx: Ctx) -> Column:
    return F.to_date(local_ts(country, ms, ctx))


def local_today(country, ctx: Ctx) -> Column:
    """Local date of the run clock, per row country (a literal per branch)."""
    return by_country(country, ctx, ctx.local_today, F.lit, F.lit(ctx.local_today(None)))


def local_now(country, ctx: Ctx) -> Column:
    """Local wall clock of the run clock, per row country."""
    return by_country(country, ctx, ctx.local_now, lambda t: F.lit(t).cast("timestamp_ntz"), F.lit(ctx.local_now(None)).cast("timestamp_ntz"))


def local_today_minus(country, ctx: Ctx, days: int) -> Column:
    def value(c):
        return ctx.local_today(c) - timedelta(days=days)

    return by_country(country, ctx, value, F.lit, F.lit(value(None)))


def in_local_window(ms, country, ctx: Ctx, days: int, end: int = -1) -> Column:
    """``DATE(local(ms)) BETWEEN local_today - days AND local_today + end``.

    Exact: per country the local-date interval maps to one half-open epoch-ms
    range (bounds are whole seconds, so truncating ms to seconds first does
    not change the test). Null ms or country outside the map: UTC rules.
    """
    ms, country = _c(ms), _c(country)
    terms = []
    for (lo, hi), countries in _grouped(ctx, lambda c: ctx.window_ms(c, days, end)):
        terms.append(_one_of(country, countries) & (ms >= F.lit(lo)) & (ms < F.lit(hi)))
    lo, hi = ctx.window_ms(None, days, end)
    other = country.isNull() | ~country.isin(ctx.countries)
    terms.append(other & (ms >= F.lit(lo)) & (ms < F.lit(hi)))
    out = terms[0]
    for t in terms[1:]:
        out = out | t
    return out


def coarse_ms_range(ms, ctx: Ctx, days: int, end: int = -1) -> Column:
    """Country-free superset of :func:`in_local_window` (min lo .. max hi).

    Redundant with the exact test; added next to it so row-group statistics
    can skip whole files even when the country column is not sorted."""
    ms = _c(ms)
    bounds = [ctx.window_ms(c, days, end) for c in ctx.countries + [None]]
    return (ms >= F.lit(min(b[0] for b in bounds))) & (ms < F.lit(max(b[1] for b in bounds)))


def date_on_or_after_local(date_col, country, ctx: Ctx, days: int) -> Column:
    """``DATE(d) >= local_today - days`` (FL07)."""
    return _c(date_col) >= local_today_minus(country, ctx, days)


def date_in_local_window(date_col, country, ctx: Ctx, days: int, end: int = -1) -> Column:
    d = _c(date_col)
    return (d >= local_today_minus(country, ctx, days)) & (d <= local_today_minus(country, ctx, -end))


def days_late(due, paid_cnt, paid_date, full_waived, waived_date, country, ctx: Ctx) -> Column:
    """Days from the current due date to the settling date: paid date if paid,
    else waived date if fully waived, else local today."""
    end = (
        F.when(_c(paid_cnt) >= 1, _c(paid_date))
        .when(_c(full_waived) == 1, _c(waived_date))
        .otherwise(local_today(country, ctx))
    )
    return F.datediff(end, _c(due))


def ts_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a whole-second TIMESTAMP_NTZ (19 chars)."""
    return F.substring(_c(ts).cast("string"), 1, 19)
