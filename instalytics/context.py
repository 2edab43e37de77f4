"""Run context: clock, region, cut-over and the country -> time-zone map.

Everything that depends on "now" is derived here, in Python, once per run, so
the Spark plans only ever see literals (constant folding + Parquet push-down).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

# Sentinels of the output contract ("no date", "no datetime").
NO_DATE = "1969-12-31"
NO_DATETIME = "1969-12-31 11:59:59"

# Scan horizons (days before the run date, on par_process_date).
HORIZON_LONG = 450
HORIZON_YEAR = 360
HORIZON_HALF = 180

# Country -> IANA zone used for "local" times. Countries with several zones
# carry one stated choice. Unknown or null countries are treated as UTC.
DEFAULT_TZ_MAP = (
    ("GB", "Europe/London"),
    ("FR", "Europe/Paris"),
    ("ES", "Europe/Madrid"),
    ("IT", "Europe/Rome"),
    ("JP", "Asia/Tokyo"),
    ("US", "America/New_York"),
    ("CA", "America/Toronto"),
    ("AU", "Australia/Sydney"),
    ("NZ", "Pacific/Auckland"),
)

UTC = timezone.utc
EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Ctx:
    """Parameters of one feature run.

    ``as_of`` is the run clock in UTC (naive datetime = UTC wall clock).
    """

    as_of: datetime
    region: str = "GB"
    cutover: date = date(2021, 6, 1)
    tz_map: tuple = DEFAULT_TZ_MAP
    offsets: tuple = (2, 3, 10, 30, 90, 180)
    # Materialise re-used intermediates (FE05, FE09, FE23, ...) under
    # spark.checkpoint.dir so a lost executor does not replay the whole lineage.
    materialize: bool = False

    # ------------------------------------------------------------------ clock
    @property
    def as_of_utc(self) -> datetime:
        return self.as_of.replace(tzinfo=UTC)

    @property
    def today(self) -> date:
        """``DATE(SYSDATE)``: the UTC run date (partition horizon anchor)."""
        return self.as_of.date()

    def horizon(self, days: int) -> date:
        return self.today - timedelta(days=days)

    # ------------------------------------------------------------- local time
    def zone(self, country: str | None) -> ZoneInfo | timezone:
        return ZoneInfo(dict(self.tz_map)[country]) if country in dict(self.tz_map) else UTC

    def zone_name(self, country: str | None) -> str:
        return dict(self.tz_map).get(country, "UTC")

    def local_now(self, country: str | None) -> datetime:
        """Run clock as local wall clock (naive)."""
        return self.as_of_utc.astimezone(self.zone(country)).replace(tzinfo=None)

    def local_today(self, country: str | None) -> date:
        return self.local_now(country).date()

    def day_start_ms(self, country: str | None, day: date) -> int:
        """Epoch ms of the first instant whose local date is ``day``.

        Checked: the instant one second earlier must fall on the previous
        local date, i.e. the local date is monotone across that boundary.
        """
        zone = self.zone(country)
        start = datetime(day.year, day.month, day.day, tzinfo=zone).astimezone(UTC)
        # A gap at local midnight: move forward to the first existing second.
        while start.astimezone(zone).date() < day:
            start += timedelta(minutes=15)
        while (start - timedelta(minutes=15)).astimezone(zone).date() >= day:
            start -= timedelta(minutes=15)
        before = (start - timedelta(seconds=1)).astimezone(zone).date()
        if before >= day:
            raise ValueError(f"local date not monotone at {day} in {zone}")
        return int((start - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds()) * 1000

    def window_ms(self, country: str | None, days: int, end: int = -1) -> tuple[int, int]:
        """Half-open epoch-ms range [lo, hi) of local dates
        ``local_today - days .. local_today + end`` (inclusive both ends)."""
        today = self.local_today(country)
        lo = self.day_start_ms(country, today - timedelta(days=days))
        hi = self.day_start_ms(country, today + timedelta(days=end + 1))
        return lo, hi

    @property
    def countries(self) -> list[str]:
        return [c for c, _ in self.tz_map]


def default_ctx(**kw) -> Ctx:
    """Context of the shared test tables (see FIXTURES.md section C)."""
    base = dict(as_of=datetime(2001, 8, 2, 12, 0, 0), region="GB", cutover=date(2001, 3, 1))
    base.update(kw)
    return Ctx(**base)
