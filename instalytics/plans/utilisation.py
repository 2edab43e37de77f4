"""FE31-FE32: attempts / checks since the last line change and the maximum
utilisation (outstanding + order amount)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import HORIZON_HALF, Ctx
from ..functions.timecols import date_in_local_window, local_date, local_ts

D10 = "decimal(10,2)"
D20 = "decimal(20,2)"


def fe31_util_d180(fe08: DataFrame, fe13: DataFrame, ctx: Ctx) -> DataFrame:
    """Per consumer (from FE08): every attempt / check dated on or after the
    last line change (180-day fall-back); one sentinel row when none."""
    line = fe08.select("consumer_consumer_uuid", "country_code", "line_change_ts_180d")
    otb = fe13.select(F.col("consumer_uuid").alias("_ou"), "order_id", "key_id", "otb_amount",
                      "account_limit_amount", "osb_amount", "key_event_info_event_time")
    # Left join written as inner join + anti join: the attempts (many per
    # consumer) are the streamed side of an inner join, so AQE can split a
    # hot consumer; consumers without attempts get the sentinel row.
    since = (line["consumer_consumer_uuid"] == otb["_ou"]) & (
        local_date(line["country_code"], otb["key_event_info_event_time"], ctx)
        >= F.to_date(line["line_change_ts_180d"]))
    matched = otb.join(line, since, "inner").select(
        "consumer_consumer_uuid",
        F.coalesce(F.col("order_id"), F.lit("")).alias("order_id"),
        F.coalesce(F.col("key_id"), F.lit(-1).cast("bigint")).alias("pos_pre_approval_id"),
        F.coalesce(F.col("otb_amount"), F.lit(0).cast(D10)).alias("otb_amount"),
        F.coalesce(F.col("account_limit_amount"), F.lit(0).cast(D10)).alias("limit_amount"),
        F.coalesce(F.col("osb_amount"), F.lit(0).cast(D10)).alias("osb_amount"),
        "country_code", "key_event_info_event_time",
        local_ts("country_code", "key_event_info_event_time", ctx).alias("otb_event_ts"),
    )
    # Some attempt is on or after the change if the latest one is (a local
    # date never falls as time passes), so the anti half needs one row per consumer.
    last = otb.groupBy("_ou").agg(F.max("key_event_info_event_time").alias("_last"))
    after = local_date(line["country_code"], F.col("_last"), ctx) >= F.to_date(line["line_change_ts_180d"])
    alone = line.join(last, line["consumer_consumer_uuid"] == last["_ou"], "left").where(
        ~F.coalesce(after, F.lit(False))).select(
        "consumer_consumer_uuid", F.lit("").alias("order_id"), F.lit(-1).cast("bigint").alias("pos_pre_approval_id"),
        F.lit(0).cast(D10).alias("otb_amount"), F.lit(0).cast(D10).alias("limit_amount"),
        F.lit(0).cast(D10).alias("osb_amount"), "country_code",
        F.lit(None).cast("bigint").alias("key_event_info_event_time"),
        F.lit(None).cast("timestamp_ntz").alias("otb_event_ts"),
    )
    return matched.unionByName(alone)


def fe32_cust_util_d180(fe06: DataFrame, fe31: DataFrame, ctx: Ctx) -> DataFrame:
    """Max over three branches of utilisation: online orders matched on token,
    in-store orders matched on pre-approval id, and check-only rows; 0 when
    nothing matches. Each branch is reduced to (consumer, utilisation)
    before the union, so only two columns cross the shuffle."""
    base = fe06.where(date_in_local_window(F.to_date("order_datetime"), "country_code", ctx, HORIZON_HALF)).select(
        "consumer_consumer_uuid", "key_token", "pos_pre_approval_id", "order_amt")
    # the maximum of (outstanding + amount) is the maximum outstanding plus the
    # amount, so a hot consumer's attempts are reduced before they are joined
    u = F.col("consumer_consumer_uuid").alias("_u")
    by_order = fe31.groupBy(u, F.col("order_id").alias("_oid")).agg(F.max("osb_amount").alias("osb_amount"))
    by_check = fe31.groupBy(u, F.col("pos_pre_approval_id").alias("_pa")).agg(F.max("osb_amount").alias("osb_amount"))
    online = base.join(by_order, (base["consumer_consumer_uuid"] == by_order["_u"]) & (base["key_token"] == by_order["_oid"]),
                       "left").select("consumer_consumer_uuid",
                                      (F.col("osb_amount") + F.col("order_amt")).alias("utilization"))
    instore_base = base.where(F.col("pos_pre_approval_id") != -1)
    instore = instore_base.join(by_check, (instore_base["consumer_consumer_uuid"] == by_check["_u"])
                                & (instore_base["pos_pre_approval_id"] == by_check["_pa"]), "left").select(
        "consumer_consumer_uuid", (F.col("osb_amount") + F.col("order_amt")).alias("utilization"))
    checks = fe31.where(F.col("order_id") == "").select(
        "consumer_consumer_uuid", (F.col("osb_amount") + F.lit(0).cast(D10)).alias("utilization"))
    tbl = online.unionByName(instore).unionByName(checks)
    return tbl.groupBy(F.col("consumer_consumer_uuid").alias("consumer_uuid")).agg(
        F.coalesce(F.max("utilization"), F.lit(0)).cast(D20).alias("c_max_util_amt_after_limit_change_180d"))
