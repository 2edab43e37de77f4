"""FE01-FE05: instalment base, due-date history, payment events, per-instalment
aggregate. Grain moves order -> instalment; the distribution key downstream
is the instalment id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import HORIZON_LONG, HORIZON_YEAR, Ctx
from ..functions.conditional import count_when, max_when, sum_when
from ..functions.text import not_blank
from ..functions.timecols import date_on_or_after_local, in_local_window, local_ts
from ..operators.dedup import latest_per_key, number_in_group
from ..sources.bundle import scan

D20 = "decimal(20,2)"


def approved_orders(order: DataFrame, ctx: Ctx, days: int | None) -> DataFrame:
    return scan(order, ctx, days).where(F.col("status") == "APPROVED")


def instalment_rows(payment_scheduled: DataFrame, order: DataFrame, ctx: Ctx) -> DataFrame:
    """Approved-order instalments of the last 450 ingestion days, de-duplicated,
    with local times."""
    base = scan(payment_scheduled, ctx, HORIZON_LONG).alias("b")
    o = approved_orders(order, ctx, HORIZON_LONG).alias("o")
    j = base.join(o, (F.col("o.order_transaction_id") == F.col("b.order_transaction_id"))
                  & (F.col("o.par_region") == F.col("b.par_region")), "inner")
    return j.select(
        F.col("o.consumer_consumer_uuid").alias("consumer_uuid"),
        F.col("o.country_code").alias("country_code"),
        F.col("b.key_payment_schedule_id").alias("instalment_id"),
        F.col("b.due_date_string").try_cast("date").alias("original_due_date"),
        F.col("b.amount_amount").cast(D20).alias("inv_amount"),
        F.col("b.event_info_event_time").alias("invoice_event_time"),
        F.col("b.par_region").alias("par_region"),
        local_ts(F.col("o.country_code"), F.col("b.event_info_event_time"), ctx).alias("invoice_event_datetime"),
        F.col("o.order_transaction_id").alias("order_id"),
        local_ts(F.col("o.country_code"), F.col("o.key_event_info_event_time"), ctx).alias("order_event_datetime"),
        F.col("o.first_payment_up_front").alias("first_payment_up_front"),
        F.col("o.consumer_total_amount_amount").cast(D20).alias("consumer_amount"),
    ).distinct()


def fe01_instal_invoice(rows: DataFrame) -> DataFrame:
    """``instalment_rows`` and the instalment's position in its order.

    The rows come de-duplicated (grouped on all columns, so a hot order was
    spread by its instalments) and, in a materialised run, staged: the cut points
    read one column of the files and the join runs once. Region is a single
    value here, so numbering per (order, region) equals numbering per order."""
    return number_in_group(rows, ["order_id", "par_region"], ["instalment_id"], "instalment_seq_id",
                           tiebreak=["invoice_event_time", "inv_amount", "original_due_date", "consumer_uuid"])


def fe02_due_date_history(due_date_changed: DataFrame, fe01: DataFrame, ctx: Ctx) -> DataFrame:
    """Due-date changes of known instalments (blank dates dropped)."""
    b = scan(due_date_changed, ctx, HORIZON_LONG).where(
        not_blank("old_due_date_string") & not_blank("new_due_date_string")).alias("b")
    i = fe01.select("instalment_id", "order_id", "country_code").alias("i")
    j = b.join(i, (F.col("i.instalment_id") == F.col("b.key_payment_schedule_id"))
               & (F.col("i.order_id") == F.col("b.order_transaction_id")), "inner")
    eff = local_ts(F.col("i.country_code"), F.col("b.event_info_event_time"), ctx)
    out = j.select(
        F.col("b.key_consumer_consumer_uuid").alias("consumer_uuid"),
        F.col("b.key_payment_schedule_id").alias("instalment_id"),
        F.col("b.order_transaction_id").alias("order_id"),
        F.col("i.country_code").alias("country_code"),
        eff.alias("effective_datetime"),
        F.to_date(eff).alias("effective_date"),
        F.col("b.old_due_date_string").try_cast("date").alias("prev_due_date"),
        F.col("b.new_due_date_string").try_cast("date").alias("due_date"),
    )
    return out.withColumn(
        "invalid_flag", F.when(F.col("effective_date") > F.col("prev_due_date"), F.lit(1)).otherwise(F.lit(0)))


def fe03_due_date_valid(fe02: DataFrame) -> DataFrame:
    """Latest due-date change per (instalment, order); ties: later new due date."""
    return latest_per_key(fe02, ["instalment_id", "order_id"], ["effective_datetime"],
                          ["due_date", "prev_due_date", "consumer_uuid"])


def successful_payments(payment_processed: DataFrame, ctx: Ctx) -> DataFrame:
    """Latest SUCCESSFUL processing event per payment id (450 days)."""
    pp = scan(payment_processed, ctx, HORIZON_LONG).where(F.col("payment_status") == "SUCCESSFUL").select(
        F.col("key_consumer_consumer_uuid").alias("consumer_uuid"), "key_payment_id", "par_region",
        "payment_method_discount_name", "event_info_event_time")
    return latest_per_key(pp, ["key_payment_id"], ["event_info_event_time"],
                          ["payment_method_discount_name", "consumer_uuid", "par_region"])


def fe04_instal_events(instalment_payment: DataFrame, payments: DataFrame, fe01: DataFrame,
                       ctx: Ctx) -> DataFrame:
    """Instalment payments whose latest successful processing event has the
    same event time; typed PAYMENT, or DISCOUNT when a discount name is set.
    ``payments``: see ``successful_payments``."""
    p = scan(instalment_payment, ctx, HORIZON_LONG).alias("p")
    pp = payments.alias("pp")
    # FE01 holds the run's region only; stating it marks FE01 as a selective side, so that
    # Spark may filter the payments by a Bloom filter of its instalments before their exchange
    inst = fe01.where(F.col("par_region") == ctx.region).select("consumer_uuid", "country_code", "instalment_id", "order_id",
                                                                "par_region").alias("i")
    j = (p.join(inst, F.col("i.instalment_id") == F.col("p.key_payment_schedule_id"), "inner")
         .join(pp, (F.col("pp.key_payment_id") == F.col("p.key_payment_id"))
               & (F.col("pp.event_info_event_time") == F.col("p.event_time")), "inner"))
    disc = F.coalesce(F.col("pp.payment_method_discount_name"), F.lit(""))
    return j.select(
        F.col("i.consumer_uuid").alias("consumer_uuid"),
        F.col("i.country_code").alias("country_code"),
        F.col("p.key_payment_schedule_id").alias("instalment_id"),
        F.col("i.order_id").alias("order_id"),
        F.col("i.par_region").alias("par_region"),
        F.when(disc == "", F.lit("PAYMENT")).otherwise(F.lit("DISCOUNT")).alias("event_type"),
        F.col("p.key_payment_id").alias("payment_id"),
        F.lit(None).cast("bigint").alias("refund_id"),
        F.col("p.event_time").alias("event_time"),
        F.col("p.amount_amount").cast(D20).alias("amount_paid"),
        F.lit(0).cast(D20).alias("amount_waived"),
        F.col("p.payment_schedule_status").alias("payment_schedule_status"),
    ).distinct()


FE05_KEYS = ["instalment_id", "consumer_uuid", "country_code", "par_region", "inv_amount", "invoice_event_datetime",
             "order_id", "order_event_datetime", "first_payment_up_front", "instalment_seq_id",
             "upfront_instalment", "original_due_date", "current_due_date"]


def fe05_instal_events_agg(fe01: DataFrame, fe04: DataFrame, fe03: DataFrame, ctx: Ctx) -> DataFrame:
    """One row per instalment due in the last 360 local days or later:
    paid / payment / refund counts, latest times, discount, full-waive flag."""
    dt = fe03.select(F.col("instalment_id").alias("dt_iid"), F.col("order_id").alias("dt_oid"), "due_date")
    # The due-date join is 1:1 and feeds the row filter, so it runs first:
    # instalments outside the window never meet their payment events.
    base = (fe01.join(dt, (fe01["instalment_id"] == dt["dt_iid"]) & (fe01["order_id"] == dt["dt_oid"]), "left")
            .withColumn("current_due_date", F.coalesce(F.col("due_date"), F.col("original_due_date")))
            .where(date_on_or_after_local("current_due_date", "country_code", ctx, HORIZON_YEAR))
            .withColumn("upfront_instalment",
                        F.when(F.coalesce(F.col("first_payment_up_front"), F.lit(False))
                               & (F.col("instalment_seq_id") == 1), F.lit(1)).otherwise(F.lit(0)))
            .drop("dt_iid", "dt_oid", "due_date"))
    ev = fe04.where(F.col("event_type").isin("PAYMENT", "REFUNDED", "DISCOUNT")).select(
        F.col("instalment_id").alias("e_iid"), F.col("order_id").alias("e_oid"),
        F.col("consumer_uuid").alias("e_uuid"), "event_type", "event_time", "payment_schedule_status",
        "amount_paid", "amount_waived")
    # Events meet the instalment keys in an inner join (the residual -- event
    # in the instalment's local 360-day window -- filters the pairs), are
    # aggregated per instalment, and only then left-joined 1:1 to the base.
    # Same result as aggregating the outer join, but the many-rows side is
    # the streamed side of an inner join (AQE may split a hot key) and is
    # reduced by partial aggregation before the second shuffle.
    keys = base.select("instalment_id", "order_id", "consumer_uuid", "country_code").distinct()
    j = ev.join(keys, (keys["instalment_id"] == ev["e_iid"]) & (keys["order_id"] == ev["e_oid"])
                & (keys["consumer_uuid"] == ev["e_uuid"])
                & in_local_window(ev["event_time"], keys["country_code"], ctx, HORIZON_YEAR), "inner")
    et = F.col("event_type")
    ev_agg = j.groupBy("instalment_id", "order_id", "consumer_uuid", "country_code").agg(
        count_when((F.coalesce(F.col("payment_schedule_status"), F.lit("")) == "PAID") & (et == "PAYMENT"))
        .alias("paid_cnt"),
        count_when(et == "PAYMENT").alias("payment_cnt"),
        count_when(et == "REFUNDED").alias("waived_cnt"),
        max_when(et == "PAYMENT", "event_time").alias("latest_instal_paid_datetime"),
        max_when(et == "REFUNDED", "event_time").alias("latest_instal_waived_datetime"),
        sum_when(et == "REFUNDED", "amount_waived", dtype=D20).alias("waived_amount"),
        sum_when(et == "DISCOUNT", "amount_paid", dtype=D20).alias("discount_amount"),
    )
    # the country is part of the grain (it fixes the window) but may be null
    back = ev_agg.select(*[F.col(c).alias(f"_{c}") for c in ("instalment_id", "order_id", "consumer_uuid", "country_code")],
                         *ev_agg.columns[4:])
    agg = base.join(back, (F.col("instalment_id") == F.col("_instalment_id")) & (F.col("order_id") == F.col("_order_id"))
                    & (F.col("consumer_uuid") == F.col("_consumer_uuid"))
                    & F.col("country_code").eqNullSafe(F.col("_country_code")), "left")
    zero20 = F.lit(0).cast(D20)
    agg = agg.select(
        *FE05_KEYS,
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("paid_cnt", "payment_cnt", "waived_cnt")],
        "latest_instal_paid_datetime", "latest_instal_waived_datetime",
        F.coalesce(F.col("waived_amount"), zero20).alias("waived_amount"),
        F.coalesce(F.col("discount_amount"), zero20).alias("discount_amount"),
    )
    return agg.select(
        *FE05_KEYS, "paid_cnt", "payment_cnt", "waived_cnt", "latest_instal_paid_datetime",
        "latest_instal_waived_datetime",
        F.to_date(local_ts("country_code", "latest_instal_paid_datetime", ctx)).alias("latest_instal_paid_date"),
        F.to_date(local_ts("country_code", "latest_instal_waived_datetime", ctx)).alias("latest_instal_waived_date"),
        "waived_amount", "discount_amount",
        F.when(F.col("inv_amount") - F.col("discount_amount") + F.col("waived_amount") <= 0, F.lit(1))
        .otherwise(F.lit(0)).alias("full_waived"),
    )
