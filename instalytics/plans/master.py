"""FE33: one row per consumer of the region, 45 columns with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import NO_DATE, NO_DATETIME, Ctx
from ..operators.joins import star_union

D10 = "decimal(10,2)"
D20 = "decimal(20,2)"

# Fixed values of the output: (column, source column, default literal, type) in order.
MASTER_COLUMNS = [
    ("c_best_payment_type", "c_best_payment_type", "DEBIT", "string"),
    ("c_order_cnt_180d_v3", "c_order_cnt_180d", 0, "bigint"),
    ("c_topaz_decl_insufficent_funds_cnt_180d_v3", "c_topaz_decl_insufficent_funds_cnt_180d", 0, "bigint"),
    ("c_order_attempt_cnt_180d_v3", "c_order_attempt_cnt_180d", 0, "bigint"),
    ("c_ontime_pymt_cnt_180d_v3", "c_ontime_pymt_cnt_180d", 0, "bigint"),
    ("c_ontime_pymt_cnt_llate_180d_v3", "c_ontime_pymt_cnt_llate_180d", 0, "bigint"),
    ("c_day_late_pymt_max_cnt_180d_v3", "c_day_late_pymt_max_cnt_180d", 0, "bigint"),
    ("c_day_late_pymt_tot_cnt_180d_v3", "c_day_late_pymt_tot_cnt_180d", 0, "bigint"),
    ("c_latest_approved_credit_limit_v3", "c_latest_approved_credit_limit", 0, D10),
    ("c_earliest_late_pymt_due_date_360d_v3", "c_earliest_late_pymt_due_date_360d", NO_DATE, "date"),
    ("c_latest_late_pymt_due_date_360d_v3", "c_latest_late_pymt_due_date_360d", NO_DATE, "date"),
    ("c_late_fee_paid_amount_360d_v3", "c_late_fee_paid_amount_360d", 0, D20),
    ("c_late_fee_paid_amount_90d_v3", "c_late_fee_paid_amount_90d", 0, D20),
    ("c_late_fee_paid_cnt_360d_v3", "c_late_fee_paid_cnt_360d", 0, "bigint"),
    ("c_late_fee_paid_cnt_90d_v3", "c_late_fee_paid_cnt_90d", 0, "bigint"),
    ("c_first_late_fee_paid_datetime_360d_v3", "c_first_late_fee_paid_datetime_360d", NO_DATETIME, "string"),
    ("c_first_late_fee_paid_datetime_90d_v3", "c_first_late_fee_paid_datetime_90d", NO_DATETIME, "string"),
    ("c_max_util_amt_after_limit_change_180d_v3", "c_max_util_amt_after_limit_change_180d", 0, D20),
    ("c_day_late_pymt_max_cnt_after_limit_change_360d_v3", "c_day_late_pymt_max_cnt_after_limit_change_360d", 0,
     "bigint"),
    ("c_latest_instal_due_date_360d_v3", "c_latest_instal_due_date_360d", NO_DATE, "date"),
    ("c_latest_instal_postpone_due_date_360d_v3", "c_latest_instal_postpone_due_date_360d", NO_DATE, "date"),
    ("c_latest_late_expt_date_360d_v3", "c_latest_late_expt_date_360d", NO_DATE, "date"),
    ("c_latest_late_expt_goodwill_date_360d_v3", "c_latest_late_expt_goodwill_date_360d", NO_DATE, "date"),
    ("c_order_amt_180d_v3", "c_order_amt_180d", 0, D20),
    ("c_order_amt_percentile_180d_v3", "c_order_amt_percentile_180d", 0, "double"),
    *[(f"c_prior_credit_limit_{k}d_v3", f"c_prior_credit_limit_{k}d", 0, D10) for k in (2, 3, 10, 30, 90, 180)],
    *[(f"c_late_fee_{kind}_{what}_{d}d_v3", f"c_late_fee_{kind}_{what}_{d}d", 0, D20 if what == "amount" else "bigint")
      for kind in ("waived", "refunded") for what in ("amount", "cnt") for d in (360, 90)],
]


def fe33_consumer_master(f: dict[str, DataFrame], ctx: Ctx) -> DataFrame:
    """Left-join the per-consumer features onto the consumer base.

    The base and every side must hold a consumer once; the run fails
    otherwise. FE17 and FE20 are per country: a consumer's row of the base's
    country is taken (null equals null), else that of the greatest country. All
    sides meet in one union and one aggregate (``star_union``)."""
    key = "consumer_uuid"

    def side(name, cols):
        return f[name].select(key, *cols)

    sides = [
        side("fe18", ["c_best_payment_type"]),
        side("fe19", ["c_order_cnt_180d", "c_topaz_decl_insufficent_funds_cnt_180d", "c_order_attempt_cnt_180d"]),
        side("fe10", ["c_latest_approved_credit_limit"]),
        side("fe27", ["c_ontime_pymt_cnt_180d"]),
        side("fe28", ["c_ontime_pymt_cnt_llate_180d", "c_day_late_pymt_max_cnt_180d", "c_day_late_pymt_tot_cnt_180d"]),
        side("fe24", ["c_earliest_late_pymt_due_date_360d", "c_latest_late_pymt_due_date_360d"]),
        side("fe25", ["c_latest_instal_due_date_360d", "c_latest_instal_postpone_due_date_360d"]),
        side("fe29", ["c_latest_late_expt_date_360d", "c_latest_late_expt_goodwill_date_360d"]),
        side("fe32", ["c_max_util_amt_after_limit_change_180d"]),
        side("fe30", ["c_day_late_pymt_max_cnt_after_limit_change_360d"]),
        side("fe21", ["c_order_amt_180d", "c_order_amt_percentile_180d"]),
    ]
    by_country = [
        side("fe17", ["country_code", *[c for c in f["fe17"].columns if c.startswith("c_")]]),
        side("fe20m", ["country_code", *[f"c_prior_credit_limit_{k}d" for k in ctx.offsets]]),
    ]
    j = star_union(f["fe22"], key, sides, by_country)
    out = [
        "par_region",
        F.lit(ctx.today).alias("par_process_date"),
        "consumer_id", "consumer_uuid", "country_code", "c_tenure",
    ]
    for name, src, default, typ in MASTER_COLUMNS:
        out.append(F.coalesce(F.col(src).cast(typ), F.lit(default).cast(typ)).alias(name))
    return j.select(*out)
