"""FE06-FE13: recent approved orders, credit-line changes, limit decisions,
as-of limit, order attempts and limit checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import HORIZON_HALF, HORIZON_YEAR, Ctx
from ..functions.text import blank_to_null, json_text
from ..functions.timecols import coarse_ms_range, epoch_ms, in_local_window, local_date, local_now, local_ts
from ..operators.dedup import latest_per_key, previous_value
from ..operators.joins import asof_latest
from ..operators.reshape import union_aligned
from ..sources.bundle import scan

D10 = "decimal(10,2)"
CHECKPOINTS = ("ONLINE_CHECKOUT_START", "BARCODE_GENERATION")


def fe06_order_d360(order: DataFrame, ctx: Ctx) -> DataFrame:
    """Approved orders placed in the last 360 local days (yesterday inclusive)."""
    o = scan(order, ctx, HORIZON_YEAR).where(
        (F.col("status") == "APPROVED")
        & coarse_ms_range("key_event_info_event_time", ctx, HORIZON_YEAR)
        & in_local_window("key_event_info_event_time", "country_code", ctx, HORIZON_YEAR))
    return o.select(
        "order_transaction_id", "key_token", "pos_pre_approval_id", "consumer_consumer_uuid",
        F.col("consumer_total_amount_amount").cast(D10).alias("order_amt"),
        local_ts("country_code", "key_event_info_event_time", ctx).alias("order_datetime"),
        "country_code",
    )


def value_changes(decision_value_change: DataFrame, ctx: Ctx) -> DataFrame:
    """Value-change events with the next older event's value (0 for the oldest)."""
    vc = scan(decision_value_change, ctx, HORIZON_YEAR)
    return previous_value(vc, ["consumer_uuid"], "timestamp", "old_value", "last_old_value", D10,
                          tiebreak=["old_value", "country_code"])


def fe07_line_change(decision_value_change: DataFrame, limit_change_backfill: DataFrame, ctx: Ctx) -> DataFrame:
    """Latest credit-line change per consumer in 360 local days, plus back-filled
    change times (bag union; a consumer may appear in both parts)."""
    d = value_changes(decision_value_change, ctx)
    changed = d.where((F.col("last_old_value") != F.col("old_value").cast(D10))
                      & in_local_window("timestamp", "country_code", ctx, HORIZON_YEAR))
    recent = changed.groupBy("consumer_uuid").agg(F.max("timestamp").alias("ts"))
    ts = F.greatest("c_latest_limit_increase_ts", "c_latest_limit_decrease_ts")
    back = limit_change_backfill.where(in_local_window(ts, "country_code", ctx, HORIZON_YEAR)).select(
        F.col("entity_id").alias("consumer_uuid"), ts.alias("ts"))
    return recent.unionByName(back)


def fe08_line_change_window(fe06: DataFrame, fe07: DataFrame, ctx: Ctx) -> DataFrame:
    """Start of the 'since last line change' period per (consumer, country);
    local now - 180 / - 360 days when no change is known."""
    last = fe07.groupBy("consumer_uuid").agg(F.max("ts").alias("max_event_ts"))
    # max() over duplicated (consumer, country) rows equals max() over one of
    # them, so the order rows collapse before the join.
    base = fe06.select("consumer_consumer_uuid", "country_code").distinct()
    j = base.join(last, base["consumer_consumer_uuid"] == last["consumer_uuid"], "left")
    event_ts = local_ts("country_code", "max_event_ts", ctx)
    now = local_now("country_code", ctx)
    return j.select(
        "consumer_consumer_uuid", "country_code",
        F.coalesce(event_ts, now - F.expr("INTERVAL 180 DAYS")).alias("line_change_ts_180d"),
        F.coalesce(event_ts, now - F.expr("INTERVAL 360 DAYS")).alias("line_change_ts_360d"),
    )


DE_LIMIT_SCHEMA = [
    ("consumer_uuid", "string"), ("order_id", "string"), ("pos_external_id", "string"),
    ("checkpoint_type", "string"), ("account_limit_amount", D10), ("otb_amount", D10), ("osb_amount", D10),
    ("event_info_event_time", "bigint"), ("limit_local_datetime", "timestamp_ntz"),
]


def fe09_de_limit(decision_vars: DataFrame, rules_engine_result: DataFrame, ctx: Ctx) -> DataFrame:
    """Approved checkout / barcode limit decisions, latest per order, from the
    old (before cut-over) and the new (JSON variables) source in one shape."""
    old = decision_vars.where(
        (F.col("par_region") == ctx.region) & (F.col("par_created_date") < F.lit(ctx.cutover))
        & F.col("input_checkpointtype").isin(*CHECKPOINTS) & (F.col("approved") == "1")).select(
        "consumer_uuid",
        F.col("order_token").alias("order_id"),
        "pos_external_id",
        F.col("input_checkpointtype").alias("checkpoint_type"),
        F.col("account_limit_amount").cast(D10).alias("account_limit_amount"),
        F.col("input_otbamount").cast(D10).alias("otb_amount"),
        F.col("input_amountowing").cast(D10).alias("osb_amount"),
        epoch_ms("created_datetime").alias("event_info_event_time"),
        F.col("created_datetime").alias("limit_local_datetime"),
    )
    new = rules_engine_result.where(
        (F.col("par_region") == ctx.region) & (F.col("par_process_date") >= F.lit(ctx.cutover))
        & F.col("check_point_type").isin(*CHECKPOINTS) & (F.col("approved") == "true")).select(
        "consumer_uuid", "order_id", "pos_external_id",
        F.col("check_point_type").alias("checkpoint_type"),
        F.col("account_limit_amount").cast(D10).alias("account_limit_amount"),
        F.col("available_barcode_amount_amount").cast(D10).alias("otb_amount"),
        blank_to_null(json_text("input_variables", "amountOwing", "value"), D10).alias("osb_amount"),
        "event_info_event_time",
        F.lit(None).cast("timestamp_ntz").alias("limit_local_datetime"),
    )
    tb = ["consumer_uuid", "pos_external_id", "checkpoint_type", "account_limit_amount", "otb_amount"]
    old = latest_per_key(old, ["order_id"], ["limit_local_datetime"], tb)
    new = latest_per_key(new, ["order_id"], ["event_info_event_time"], tb)
    return union_aligned([old, new], DE_LIMIT_SCHEMA)


def decision_local_date(de: DataFrame, country, ctx: Ctx):
    """Local date of a decision: its own local time (old format) or its UTC
    ms converted with the consumer's country (new format)."""
    return F.when(de["limit_local_datetime"].isNull(), local_date(country, de["event_info_event_time"], ctx)) \
        .otherwise(F.to_date(de["limit_local_datetime"]))


def latest_approved_order(order: DataFrame, ctx: Ctx, status: str | None = "APPROVED") -> DataFrame:
    o = scan(order, ctx).where(F.col("par_process_date") <= F.lit(ctx.today))
    if status is not None:
        o = o.where(F.col("status") == status)
    # by consumer and country first, a hash aggregate of one number, so that the greatest
    # country (a string, which Spark aggregates by sorting) is taken from these few rows
    one = o.groupBy("consumer_consumer_uuid", "country_code").agg(F.max("key_event_info_event_time").alias("_t"))
    return one.groupBy("consumer_consumer_uuid").agg(F.max("country_code").alias("country_code"), F.max("_t").alias("latest_order_datetime"))


def limit_asof(base: DataFrame, fe09: DataFrame, ctx: Ctx) -> DataFrame:
    """Limit in force on each consumer's latest order day (as-of by local
    day, inclusive). Ties on the day: later event time, then order id."""
    left = base.select(F.col("consumer_consumer_uuid").alias("consumer_uuid"), "country_code",
                       "latest_order_datetime")
    de = fe09.select("consumer_uuid", "account_limit_amount", "event_info_event_time", "limit_local_datetime",
                     "order_id")

    def cond(l, r):
        return local_date(l["country_code"], l["latest_order_datetime"], ctx) >= \
            decision_local_date(r, l["country_code"], ctx)

    def pick(l, r):
        return [r["account_limit_amount"].alias("c_latest_approved_credit_limit"),
                decision_local_date(r, l["country_code"], ctx).alias("event_date"),
                r["event_info_event_time"].alias("_t"), r["order_id"].alias("_o")]

    out = asof_latest(left, de, "consumer_uuid", "consumer_uuid", cond, pick, ["event_date"],
                      ["_t", "_o", "c_latest_approved_credit_limit"])
    return out.select("consumer_uuid", "c_latest_approved_credit_limit", "event_date")


def fe10_cust_approved_limit(order: DataFrame, fe09: DataFrame, ctx: Ctx) -> DataFrame:
    """As-of join: latest approved-limit decision dated (local day) on or
    before the consumer's last approved order; consumers without one keep a
    null limit."""
    return limit_asof(latest_approved_order(order, ctx), fe09, ctx)


def fe11_order_attempt(fe09: DataFrame, pre_approval: DataFrame, ctx: Ctx) -> DataFrame:
    """Decisions with the id of the latest in-store pre-approval (180 days)."""
    pa = scan(pre_approval, ctx, HORIZON_HALF).select("external_id", "key_id", "event_info_event_time")
    pa = latest_per_key(pa, ["external_id"], ["event_info_event_time"], ["key_id"]).select(
        F.col("external_id").alias("pa_ext"), "key_id")
    j = fe09.join(pa, fe09["pos_external_id"] == pa["pa_ext"], "left")
    return j.select(
        "consumer_uuid", "order_id", "key_id",
        F.col("event_info_event_time").alias("key_event_info_event_time"),
        "otb_amount", "account_limit_amount", "osb_amount",
    )


def fe12_limit_check(credit_limit_result: DataFrame, ctx: Ctx) -> DataFrame:
    """Stand-alone limit checks: open-to-buy, limit, outstanding (180 days)."""
    c = scan(credit_limit_result, ctx, HORIZON_HALF)
    return c.select(
        "consumer_uuid",
        F.lit(None).cast("string").alias("order_id"),
        F.lit(-1).cast("bigint").alias("key_id"),
        epoch_ms("event_info_event_time").alias("key_event_info_event_time"),
        F.col("otb_amount_amount").cast(D10).alias("otb_amount"),
        F.col("account_limit_amount").cast(D10).alias("account_limit_amount"),
        (F.col("account_limit_amount") - F.col("otb_amount_amount")).cast(D10).alias("osb_amount"),
    )


OTB_SCHEMA = [
    ("consumer_uuid", "string"), ("order_id", "string"), ("key_id", "bigint"),
    ("key_event_info_event_time", "bigint"), ("otb_amount", D10), ("account_limit_amount", D10),
    ("osb_amount", D10),
]


def fe13_otb(fe11: DataFrame, fe12: DataFrame) -> DataFrame:
    """Order attempts and limit checks, one bag."""
    return union_aligned([fe11, fe12], OTB_SCHEMA)


__all__ = [
    "fe06_order_d360", "fe07_line_change", "fe08_line_change_window", "fe09_de_limit",
    "fe10_cust_approved_limit", "fe11_order_attempt", "fe12_limit_check", "fe13_otb", "limit_asof",
]
