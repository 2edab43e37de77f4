"""SQL text helpers (DuckDB dialect) for the oracle."""

from __future__ import annotations

from datetime import datetime

from ..context import Ctx


class Sql:
    def __init__(self, ctx: Ctx):
        self.ctx = ctx
        self.as_of_ms = int((ctx.as_of - datetime(1970, 1, 1)).total_seconds() * 1000)

    # literals -----------------------------------------------------------
    @property
    def region(self) -> str:
        return f"'{self.ctx.region}'"

    @property
    def today(self) -> str:
        return f"DATE '{self.ctx.today.isoformat()}'"

    def horizon(self, days: int) -> str:
        return f"({self.today} - {days})"

    @property
    def cutover(self) -> str:
        return f"DATE '{self.ctx.cutover.isoformat()}'"

    @property
    def now_tz(self) -> str:
        return f"TIMESTAMPTZ '{self.ctx.as_of.isoformat(sep=' ')}+00'"

    # time -----------------------------------------------------------------
    def zone(self, cc: str) -> str:
        whens = " ".join(f"WHEN '{c}' THEN '{z}'" for c, z in self.ctx.tz_map)
        return f"(CASE {cc} {whens} ELSE 'UTC' END)"

    def utc_ts(self, ms: str) -> str:
        return f"epoch_ms(({ms}) - ({ms}) % 1000)"

    def local_of_utc(self, cc: str, ts: str) -> str:
        return f"timezone({self.zone(cc)}, ({ts}) AT TIME ZONE 'UTC')"

    def lts(self, cc: str, ms: str) -> str:
        """Epoch ms -> local wall clock (whole seconds)."""
        return self.local_of_utc(cc, self.utc_ts(ms))

    def ldate(self, cc: str, ms: str) -> str:
        return f"CAST({self.lts(cc, ms)} AS DATE)"

    def local_today(self, cc: str) -> str:
        return f"CAST(timezone({self.zone(cc)}, {self.now_tz}) AS DATE)"

    def local_now(self, cc: str) -> str:
        return f"timezone({self.zone(cc)}, {self.now_tz})"

    def win(self, ms: str, cc: str, days: int, end: int = -1) -> str:
        """DATE(local(ms)) BETWEEN local_today - days AND local_today + end."""
        t = self.local_today(cc)
        hi = f"{t} - {-end}" if end < 0 else f"{t} + {end}"
        return f"({self.ldate(cc, ms)} BETWEEN {t} - {days} AND {hi})"

    def days_late(self, p: str = "") -> str:
        return (f"date_diff('day', {p}current_due_date, CASE WHEN {p}paid_cnt >= 1 THEN {p}latest_instal_paid_date "
                f"WHEN {p}full_waived = 1 THEN {p}latest_instal_waived_date "
                f"ELSE {self.local_today(p + 'country_code')} END)")

    # fixture shapes ---------------------------------------------------------
    @staticmethod
    def uuid(key: str) -> str:
        return f"('c' || CAST({key} AS VARCHAR))"

    @staticmethod
    def reg(key: str) -> str:
        return f"(CASE WHEN {key} % 10 = 9 THEN 'US' ELSE 'GB' END)"

    @staticmethod
    def cc(key: str) -> str:
        return f"(CASE WHEN {key} % 17 = 5 THEN NULL WHEN {key} % 17 = 9 THEN 'BR' ELSE CASE {key} % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' ELSE 'JP' END END)"

    @staticmethod
    def ms_of_date(d: str) -> str:
        return f"((({d}) - DATE '1970-01-01') * 86400000)"

    @staticmethod
    def utc_date(ms: str) -> str:
        return f"CAST(epoch_ms({ms}) AS DATE)"
