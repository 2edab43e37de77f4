"""FE18-FE22: payment type, order counts, prior limits, spend percentile,
consumer base."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import HORIZON_HALF, Ctx
from ..functions.conditional import any_when, count_when
from ..functions.timecols import coarse_ms_range, in_local_window, local_today
from ..operators.rank import percent_rank_global
from ..operators.reshape import pivot_day_offsets
from ..sources.bundle import scan

D10 = "decimal(10,2)"
D20 = "decimal(20,2)"
# Status reasons that count as an order attempt.
ATTEMPT_REASONS = ("APPROVED", "INSUFFICIENT_FUNDS", "INVALID_PAYMENT_DETAILS", "FRAUD_RULE_BREACH", "DECLINED")


def fe18_cust_pymt_method(payment_processed: DataFrame, ctx: Ctx) -> DataFrame:
    """CREDIT if any payment (any status, all history) used a credit card."""
    p = scan(payment_processed, ctx).where(F.col("par_process_date") <= F.lit(ctx.today))
    agg = p.groupBy(F.col("key_consumer_consumer_uuid").alias("consumer_uuid")).agg(
        any_when(F.col("payment_method_credit_card_card_type") == "CREDIT").alias("_credit"))
    return agg.select("consumer_uuid", F.when(F.col("_credit") == 1, F.lit("CREDIT")).otherwise(F.lit("DEBIT"))
                      .alias("c_best_payment_type"))


def orders_in_window(order: DataFrame, ctx: Ctx, days: int) -> DataFrame:
    t = "key_event_info_event_time"
    return scan(order, ctx, days).where(
        coarse_ms_range(t, ctx, days) & in_local_window(t, "country_code", ctx, days))


def fe19_cust_order_d180(order: DataFrame, ctx: Ctx) -> DataFrame:
    """Online (token present) orders, attempts, insufficient-funds declines
    in the last 180 local days."""
    o = orders_in_window(order, ctx, HORIZON_HALF)
    tok = F.col("key_token").isNotNull()
    return o.groupBy(F.col("consumer_consumer_uuid").alias("consumer_uuid")).agg(
        count_when(tok & (F.col("status") == "APPROVED")).alias("c_order_cnt_180d"),
        count_when(tok & (F.col("status_reason") == "INSUFFICIENT_FUNDS"))
        .alias("c_topaz_decl_insufficent_funds_cnt_180d"),
        count_when(tok & F.col("status_reason").isin(*ATTEMPT_REASONS)).alias("c_order_attempt_cnt_180d"),
    )


def fe20_cust_account_limit(limit_daily: DataFrame, ctx: Ctx, keep_empty: bool = True) -> DataFrame:
    """Daily limit k days before local today, k in ``ctx.offsets``.

    ``keep_empty=False`` first keeps only rows dated on one of the wanted
    days (a literal IN list -> pushed to the scan / partition pruning);
    groups with none of those days then vanish instead of carrying nulls,
    which the master turns into the same 0."""
    df = limit_daily
    if not keep_empty:
        days = sorted({ctx.local_today(c) - timedelta(days=k)
                       for c in ctx.countries + [None] for k in ctx.offsets})
        df = df.where(F.col("created_local_date").isin(*days))
    return pivot_day_offsets(df, ["par_region", "country_code", "consumer_uuid"], "created_local_date",
                             "daily_account_limit", local_today("country_code", ctx), ctx.offsets,
                             "c_prior_credit_limit_{}d")


def approved_spend(order: DataFrame, ctx: Ctx) -> DataFrame:
    """Approved spend per consumer in the last 180 local days."""
    o = orders_in_window(order, ctx, HORIZON_HALF).where(F.col("status") == "APPROVED")
    return o.groupBy(F.col("consumer_consumer_uuid").alias("consumer_uuid")).agg(
        F.sum(F.col("consumer_total_amount_amount").cast(D10)).cast(D20).alias("c_order_amt_180d"))


def fe21_cust_approved_order_d180(spend: DataFrame) -> DataFrame:
    """``approved_spend`` and its percentile among consumers with such spend:
    1 = top 1 %, 100 = lowest."""
    ranked = percent_rank_global(spend, "c_order_amt_180d", "pct_rank")
    pr = F.col("pct_rank")
    return ranked.select(
        "consumer_uuid", "c_order_amt_180d", "pct_rank",
        F.when(pr >= 0.99, F.lit(1.0)).otherwise(F.lit(100.0) - F.floor(pr * 100).cast("double"))
        .alias("c_order_amt_percentile_180d"))


def fe22_cust_base(consumer: DataFrame, ctx: Ctx) -> DataFrame:
    """Consumers of the region with tenure in days since the first order."""
    c = consumer.where(F.col("par_region") == ctx.region)
    return c.select(
        F.col("uuid").alias("consumer_uuid"), F.col("id").alias("consumer_id"), "country_code", "par_region",
        F.when(F.col("first_order_date").isNull(), F.lit(0))
        .otherwise(F.datediff(local_today("country_code", ctx), F.to_date("first_order_date")))
        .cast("bigint").alias("c_tenure"),
    )


__all__ = ["fe18_cust_pymt_method", "fe19_cust_order_d180", "fe20_cust_account_limit",
           "approved_spend", "fe21_cust_approved_order_d180", "fe22_cust_base", "order_rollup", "fe19_from_rollup", "fe21_from_rollup"]


def order_rollup(order: DataFrame, ctx: Ctx) -> DataFrame:
    """One pass over the region's orders, grouped by consumer, for the master:
    FE19's online counts and FE21's spend (180 local days) and FE10's latest
    approved order (all history up to today), as conditional aggregates.
    Replaces three scans and three shuffles of the order table by one of each;
    the ``_has_*`` flags keep each feature's own row set."""
    o = scan(order, ctx)
    t = "key_event_info_event_time"
    in180 = ((F.col("par_process_date") >= F.lit(ctx.horizon(HORIZON_HALF)))
             & in_local_window(t, "country_code", ctx, HORIZON_HALF))
    approved = F.col("status") == "APPROVED"
    tok = F.col("key_token").isNotNull()
    upto_today = approved & (F.col("par_process_date") <= F.lit(ctx.today))
    # by consumer and country first, all in fixed-width buffers; the greatest country
    # (a string, which Spark aggregates by sorting) comes from these few rows
    one = o.groupBy(F.col("consumer_consumer_uuid").alias("consumer_uuid"), "country_code").agg(
        any_when(in180).alias("_has_180d"),
        count_when(in180 & tok & approved).alias("c_order_cnt_180d"),
        count_when(in180 & tok & (F.col("status_reason") == "INSUFFICIENT_FUNDS"))
        .alias("c_topaz_decl_insufficent_funds_cnt_180d"),
        count_when(in180 & tok & F.col("status_reason").isin(*ATTEMPT_REASONS)).alias("c_order_attempt_cnt_180d"),
        any_when(in180 & approved).alias("_has_spend"),
        F.sum(F.when(in180 & approved, F.col("consumer_total_amount_amount").cast(D10))).cast(D20)
        .alias("c_order_amt_180d"),
        any_when(upto_today).alias("_has_latest"),
        F.max(F.when(upto_today, F.col(t))).alias("latest_order_datetime"),
    )
    flags = ("_has_180d", "_has_spend", "_has_latest")
    counts = ("c_order_cnt_180d", "c_topaz_decl_insufficent_funds_cnt_180d", "c_order_attempt_cnt_180d")
    return one.groupBy("consumer_uuid").agg(
        *[F.max(c).alias(c) for c in flags], *[F.sum(c).alias(c) for c in counts],
        F.sum("c_order_amt_180d").cast(D20).alias("c_order_amt_180d"),
        F.max(F.when(F.col("_has_latest") == 1, F.col("country_code"))).alias("country_code"),
        F.max("latest_order_datetime").alias("latest_order_datetime"))


def fe19_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.where(F.col("_has_180d") == 1).select(
        "consumer_uuid", "c_order_cnt_180d", "c_topaz_decl_insufficent_funds_cnt_180d", "c_order_attempt_cnt_180d")


def fe21_from_rollup(rollup: DataFrame) -> DataFrame:
    return fe21_cust_approved_order_d180(rollup.where(F.col("_has_spend") == 1).select("consumer_uuid", "c_order_amt_180d"))
