"""Local-time helpers against Python's zoneinfo (hand-made edge rows and a
property test around DST changes)."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from instalytics.functions.timecols import in_local_window, local_date, local_today, local_ts, utc_ts

UTC = timezone.utc


def ms_of(dt):
    return int(dt.replace(tzinfo=UTC).timestamp() * 1000)


def test_summer_late_evening_is_next_local_day(spark, ctx):
    ms = ms_of(datetime(2001, 7, 1, 23, 30)) + 999
    df = spark.createDataFrame([("GB", ms), ("JP", ms), ("XX", ms), (None, ms)], "cc string, ms long")
    rows = df.select("cc", local_ts("cc", "ms", ctx).alias("t"), local_date("cc", "ms", ctx).alias("d"),
                     utc_ts("ms").alias("u")).collect()
    got = {r.cc: (r.t, r.d, r.u) for r in rows}
    assert got["GB"][0] == datetime(2001, 7, 2, 0, 30) and got["GB"][1] == date(2001, 7, 2)
    assert got["JP"][0] == datetime(2001, 7, 2, 8, 30)
    assert got["XX"][0] == datetime(2001, 7, 1, 23, 30)  # unknown country: UTC
    assert got[None][1] == date(2001, 7, 1)
    assert got["GB"][2] == datetime(2001, 7, 1, 23, 30)  # milliseconds truncated


def test_window_ends(spark, ctx):
    """Events at local midnight of today-360, -1, 0 and one second before."""
    today = ctx.local_today("GB")
    zone = ZoneInfo("Europe/London")
    rows = []
    for k in (361, 360, 1, 0):
        start = datetime(today.year, today.month, today.day, tzinfo=zone) - timedelta(days=k)
        start = datetime.combine((today - timedelta(days=k)), datetime.min.time(), tzinfo=zone)
        rows += [(k, "a", ms_of(start.astimezone(UTC).replace(tzinfo=None))),
                 (k, "b", ms_of(start.astimezone(UTC).replace(tzinfo=None)) - 1)]
    df = spark.createDataFrame([(k, w, "GB", ms) for k, w, ms in rows], "k int, w string, cc string, ms long")
    got = {(r.k, r.w): (r.y, r.t) for r in df.select(
        "k", "w", in_local_window("ms", "cc", ctx, 360).alias("y"),
        in_local_window("ms", "cc", ctx, 360, end=0).alias("t")).collect()}
    assert got[(360, "a")] == (True, True)      # first second of today-360
    assert got[(360, "b")] == (False, False)    # last second of today-361
    assert got[(1, "a")] == (True, True)
    assert got[(0, "a")] == (False, True)       # today: only with end=0
    assert got[(0, "b")] == (True, True)        # last second of yesterday


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=ms_of(datetime(2000, 3, 20)), max_value=ms_of(datetime(2001, 11, 5))),
       st.sampled_from(["GB", "FR", "JP", "US", "AU", "ZZ"]))
def test_local_date_and_window_match_zoneinfo(spark, ctx, ms, cc):
    zone = ZoneInfo(ctx.zone_name(cc)) if ctx.zone_name(cc) != "UTC" else UTC
    secs = ms - ms % 1000
    local = datetime.fromtimestamp(secs / 1000, tz=UTC).astimezone(zone).replace(tzinfo=None)
    today = ctx.local_today(cc)
    inside = today - timedelta(days=360) <= local.date() <= today - timedelta(days=1)
    r = spark.createDataFrame([(cc, ms)], "cc string, ms long").select(
        local_ts("cc", "ms", ctx).alias("t"), in_local_window("ms", "cc", ctx, 360).alias("w"),
        local_today("cc", ctx).alias("today")).first()
    assert r.t == local
    assert r.w == inside
    assert r.today == today


def _world(n):
    """``n`` made-up countries over as many zones as there are."""
    from zoneinfo import available_timezones

    zones = sorted(z for z in available_timezones() if z.startswith(("Africa/", "America/", "Asia/", "Australia/", "Europe/", "Pacific/")))
    step = max(1, len(zones) // n)
    return tuple((f"X{i:03d}", z) for i, z in enumerate(zones[::step][:n]))


@pytest.mark.parametrize("n", [5, 200])
def test_many_zones_equal_python(spark, n):
    """Local times and windows of every country against zoneinfo, with literal
    branches and with the map."""
    import random
    from datetime import datetime, timedelta, timezone

    from instalytics import default_ctx
    from instalytics.functions.timecols import in_local_window, local_today, local_ts

    ctx = default_ctx(tz_map=_world(n))
    assert len(ctx.countries) == n
    rnd = random.Random(n)
    rows = [(rnd.choice([*ctx.countries, None, "??"]), int(ctx.as_of_utc.timestamp() * 1000) - rnd.randrange(200 * 86_400_000)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "cc string, ms long")
    got = df.select("cc", "ms", local_ts("cc", "ms", ctx).alias("l"), local_today("cc", ctx).alias("t"), in_local_window("ms", "cc", ctx, 90).alias("w")).collect()
    for r in got:
        at = datetime.fromtimestamp(r.ms // 1000, timezone.utc).astimezone(ctx.zone(r.cc)).replace(tzinfo=None)
        today = ctx.local_today(r.cc)
        assert r.l == at and r.t == today
        assert r.w == (today - timedelta(days=90) <= at.date() <= today - timedelta(days=1)), r


def test_many_zones_stay_in_generated_code(spark):
    from pyspark.sql import functions as F

    from instalytics import default_ctx
    from instalytics.functions.timecols import in_local_window, local_ts

    ctx = default_ctx(tz_map=_world(200))
    df = spark.range(1000).select(F.concat(F.lit("X"), F.lpad((F.col("id") % 200).cast("string"), 3, "0")).alias("cc"), (F.col("id") * 10**9).alias("ms"))
    out = df.where(in_local_window("ms", "cc", ctx, 90) | (F.col("ms") > 0)).select(local_ts("cc", "ms", ctx).alias("l"))
    jvm = spark._jvm.org.apache.spark.sql.execution
    code = jvm.debug.package.codegenStringSeq(out._jdf.queryExecution().executedPlan())
    stats = [code.apply(i)._3() for i in range(code.size())]
    # a method beyond 64 KB makes Spark give up the generated code; beyond 8 KB the JVM does not compile it
    assert stats and all(0 < s.maxMethodCodeSize() < 65_535 for s in stats)
    assert out.count() == 999
