"""FE23-FE30: overdue facts with exemptions, and the per-consumer overdue,
due-date, on-time and exemption features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import HORIZON_HALF, HORIZON_YEAR, NO_DATE, Ctx
from ..functions.text import GOODWILL, classify_note
from ..functions.timecols import (
    date_on_or_after_local,
    days_late,
    in_local_window,
    local_date,
    local_today,
)
from ..operators.dedup import latest_per_key
from ..operators.joins import anti_join, presence_flag
from ..sources.bundle import scan

def _no_date():
    return F.lit(NO_DATE).cast("date")


def latest_override(schedule_override: DataFrame, ctx: Ctx) -> DataFrame:
    """Latest override per instalment (chosen before any window test), with
    its note category."""
    e = scan(schedule_override, ctx, HORIZON_YEAR).withColumn("category", classify_note("note"))
    return latest_per_key(e, ["key_payment_schedule_id"], ["event_info_event_time"],
                          ["override_overdue_status", "note", "key_order_transaction_id"])


def fe23_instal_ovd_d360(became_overdue: DataFrame, schedule_override: DataFrame, fe05: DataFrame,
                         ctx: Ctx) -> DataFrame:
    """Overdue events of the last 360 local days (today included) with the
    instalment's facts and its latest exemption, if in the window."""
    ovd = scan(became_overdue, ctx, HORIZON_YEAR).alias("ovd")
    ex = latest_override(schedule_override, ctx).alias("ex")
    i = fe05.alias("i")
    j = ovd.join(i, F.col("ovd.key_payment_schedule_id") == F.col("i.instalment_id"), "inner").where(
        in_local_window(F.col("ovd.event_info_event_time"), F.col("i.country_code"), ctx, HORIZON_YEAR, end=0))
    j = j.join(ex, (F.col("ovd.key_payment_schedule_id") == F.col("ex.key_payment_schedule_id"))
               & (F.col("ovd.order_transaction_id") == F.col("ex.key_order_transaction_id"))
               & in_local_window(F.col("ex.event_info_event_time"), F.col("i.country_code"), ctx, HORIZON_YEAR),
               "left")
    st = F.col("ex.override_overdue_status")
    return j.select(
        F.col("ovd.key_payment_schedule_id").alias("key_payment_schedule_id"),
        F.col("ovd.order_transaction_id").alias("order_transaction_id"),
        F.col("i.consumer_uuid").alias("consumer_uuid"),
        F.col("i.country_code").alias("country_code"),
        F.col("ovd.event_info_event_time").alias("ovd_ts"),
        F.coalesce(F.col("ex.event_info_event_time"), F.lit(0).cast("bigint")).alias("expt_ts"),
        F.col("i.upfront_instalment").alias("upfront_instalment"),
        F.col("i.current_due_date").alias("current_due_date"),
        F.col("i.paid_cnt").alias("paid_cnt"),
        F.col("i.latest_instal_paid_date").alias("latest_instal_paid_date"),
        F.col("i.latest_instal_waived_date").alias("latest_instal_waived_date"),
        F.when(st == F.lit(True), F.lit(1)).otherwise(F.lit(0)).alias("ovd_expt"),
        F.when(st.isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("expt_record"),
        F.col("ex.category").alias("category"),
        F.coalesce(F.col("i.full_waived"), F.lit(0)).alias("full_waived"),
    ).distinct()


def fe24_cust_ovd_d360(fe23: DataFrame) -> DataFrame:
    """Earliest / latest due date of non-exempt overdue instalments."""
    return fe23.where(F.col("ovd_expt") == 0).groupBy("consumer_uuid").agg(
        F.coalesce(F.min("current_due_date"), _no_date()).alias("c_earliest_late_pymt_due_date_360d"),
        F.coalesce(F.max("current_due_date"), _no_date()).alias("c_latest_late_pymt_due_date_360d"))


def fe25_cust_instal_d360(fe05: DataFrame, fe23: DataFrame, ctx: Ctx) -> DataFrame:
    """Latest relevant due date and latest postponed original due date."""
    inst = fe05.where(date_on_or_after_local("current_due_date", "country_code", ctx, HORIZON_YEAR))
    # existence join: an instalment overdue several times is still one row
    inst = presence_flag(inst, fe23, "instalment_id", "key_payment_schedule_id", "_ovd")
    due = (F.when(F.col("full_waived") == 1, _no_date())
           .when((F.col("payment_cnt") > 0) | (F.col("_ovd") == 1)
                 | (F.col("current_due_date") >= local_today("country_code", ctx)), F.col("current_due_date"))
           .otherwise(_no_date()))
    post = F.when(F.col("original_due_date") < F.col("current_due_date"), F.col("original_due_date")) \
        .otherwise(_no_date())
    return inst.groupBy("consumer_uuid").agg(
        F.max(due).alias("c_latest_instal_due_date_360d"),
        F.max(post).alias("c_latest_instal_postpone_due_date_360d"))


def fe26_instal_ontime_d180(fe05: DataFrame, fe23: DataFrame, ctx: Ctx) -> DataFrame:
    """Paid instalments due in the last 180 local days or later, never
    overdue, not the up-front one (anti join)."""
    inst = fe05.where((F.col("paid_cnt") >= 1) & (F.col("upfront_instalment") == 0)
                      & date_on_or_after_local("current_due_date", "country_code", ctx, HORIZON_HALF))
    return anti_join(inst, fe23, "instalment_id", "key_payment_schedule_id")


def fe27_cust_ontime_d180(fe26: DataFrame) -> DataFrame:
    return fe26.groupBy("consumer_uuid").agg(F.count(F.lit(1)).alias("c_ontime_pymt_cnt_180d"))


def _days_late(ctx: Ctx):
    return days_late("current_due_date", "paid_cnt", "latest_instal_paid_date", "full_waived",
                     "latest_instal_waived_date", "country_code", ctx)


def fe28_cust_ovd_d180(fe23: DataFrame, fe26: DataFrame, ctx: Ctx) -> DataFrame:
    """Late count, max / total days late (non-exempt, due in 180 local days)
    and on-time payments made after the last late due date.

    The reference fans the per-consumer row out over on-time instalments and
    undoes it with MAX; here the on-time rows meet the one per-consumer date
    in an equi-join and are counted, so no aggregate is repeated."""
    late = (fe23.where((F.col("ovd_expt") == 0)
                       & date_on_or_after_local("current_due_date", "country_code", ctx, HORIZON_HALF))
            .withColumn("_dl", _days_late(ctx)).where(F.col("_dl") >= 0))
    tmp = late.groupBy("consumer_uuid").agg(
        F.count(F.lit(1)).alias("c_late_pymt_cnt_180d"),
        F.max("current_due_date").alias("_last_due"),
        F.max("_dl").cast("bigint").alias("c_day_late_pymt_max_cnt_180d"),
        F.sum("_dl").cast("bigint").alias("c_day_late_pymt_tot_cnt_180d"))
    last = tmp.select(F.col("consumer_uuid").alias("_lk"), "_last_due")
    ot = fe26.select("consumer_uuid", "latest_instal_paid_date", "upfront_instalment")
    after = (ot.join(last, ot["consumer_uuid"] == last["_lk"], "inner")
             .where((F.col("latest_instal_paid_date") > F.col("_last_due")) & (F.col("upfront_instalment") == 0))
             .groupBy(F.col("_lk")).agg(F.count(F.lit(1)).alias("_n")))
    out = tmp.join(after, tmp["consumer_uuid"] == after["_lk"], "left")
    return out.select(
        "consumer_uuid", "c_late_pymt_cnt_180d", "c_day_late_pymt_max_cnt_180d", "c_day_late_pymt_tot_cnt_180d",
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("c_ontime_pymt_cnt_llate_180d"))


def fe29_cust_late_expt_d360(fe23: DataFrame, ctx: Ctx) -> DataFrame:
    """Latest exemption date; latest goodwill exemption date (the local date
    of epoch 0 when the consumer's exemptions are not goodwill)."""
    e = fe23.where(F.col("ovd_expt") == 1)
    gw = F.when(F.col("category") == GOODWILL, F.col("expt_ts")).otherwise(F.lit(0).cast("bigint"))
    return e.groupBy("consumer_uuid").agg(
        F.max(local_date("country_code", "expt_ts", ctx)).alias("c_latest_late_expt_date_360d"),
        F.max(local_date("country_code", gw, ctx)).alias("c_latest_late_expt_goodwill_date_360d"))


def fe30_cust_ovd_limit_d360(fe08: DataFrame, fe23: DataFrame, ctx: Ctx) -> DataFrame:
    """Max days late of non-exempt overdue events dated on or after the last
    credit-line change (360-day fall-back). The reference's left join is
    undone by its own null-rejecting filter, so it is an inner join."""
    line = fe08.select(F.col("consumer_consumer_uuid").alias("_lu"), "line_change_ts_360d")
    ovd = fe23.where(F.col("ovd_expt") == 0)
    j = ovd.join(line, (ovd["consumer_uuid"] == line["_lu"])
                 & (local_date(ovd["country_code"], ovd["ovd_ts"], ctx) >= F.to_date(line["line_change_ts_360d"])),
                 "inner")
    j = j.withColumn("_dl", _days_late(ctx)).where(F.col("_dl") >= 0)
    return j.groupBy("consumer_uuid").agg(
        F.max("_dl").cast("bigint").alias("c_day_late_pymt_max_cnt_after_limit_change_360d"))
