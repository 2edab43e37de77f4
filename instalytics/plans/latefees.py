"""FE14-FE17: late-fee invoices, the four-entry ledger, per-fee pivot and the
per-consumer late-fee features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import HORIZON_LONG, HORIZON_YEAR, NO_DATETIME, Ctx
from ..functions.conditional import any_when, max_when, min_when, sum_when
from ..functions.timecols import in_local_window, local_ts, ts_text
from ..operators.reshape import union_aligned
from ..sources.bundle import scan

D20 = "decimal(20,2)"
WINDOWS = (360, 90)


def fe14_latefee_invoice(late_fee_applied: DataFrame, rows: DataFrame, ctx: Ctx) -> DataFrame:
    """Late fees charged on instalments of approved orders (``instalment_rows``
    holds these, of the same 450 ingestion days)."""
    lf = scan(late_fee_applied, ctx, HORIZON_LONG).alias("lf")
    i = rows.select("instalment_id", "par_region", "consumer_uuid", "country_code", "order_id").alias("i")
    j = lf.join(i, (F.col("lf.payment_schedule_id") == F.col("i.instalment_id"))
                & (F.col("lf.par_region") == F.col("i.par_region")), "inner")
    return j.select(
        F.col("i.consumer_uuid").alias("consumer_uuid"),
        F.col("i.country_code").alias("country_code"),
        F.col("i.order_id").alias("order_id"),
        F.col("lf.payment_schedule_id").alias("instalment_id"),
        F.col("lf.key_late_fee_id").alias("late_fee_id"),
        F.col("lf.event_info_event_time").alias("event_time"),
        F.col("lf.amount_amount").cast(D20).alias("amount_invoiced"),
        F.col("lf.par_region").alias("par_region"),
    ).distinct()


LEDGER_SCHEMA = [
    ("consumer_uuid", "string"), ("country_code", "string"), ("instalment_id", "bigint"), ("order_id", "bigint"),
    ("par_region", "string"), ("late_fee_id", "bigint"), ("event_type", "string"), ("payment_id", "bigint"),
    ("event_time", "bigint"), ("amount_invoiced", D20), ("amount_paid", D20), ("amount_waived", D20),
    ("amount_refunded", D20),
]


def _entry(event_type: str, **amounts):
    cols = [F.lit(event_type).alias("event_type")]
    for name in ("amount_invoiced", "amount_paid", "amount_waived", "amount_refunded"):
        cols.append((amounts.get(name, F.lit(0))).cast(D20).alias(name))
    return cols


def fe15_latefee_events(late_fee_payment: DataFrame, payments: DataFrame, late_fee_waived: DataFrame,
                        late_fee_refunded: DataFrame, fe14: DataFrame, ctx: Ctx) -> DataFrame:
    """Ledger: PAYMENT, INVOICED, WAIVED, REFUNDED rows (each part distinct,
    bag union across parts)."""
    lf = fe14.alias("lf")
    p = scan(late_fee_payment, ctx, HORIZON_LONG).alias("p")
    pp = payments.alias("pp")  # see successful_payments
    pay = (p.join(pp, F.col("pp.key_payment_id") == F.col("p.payment_id"), "inner")
           .join(lf, F.col("lf.late_fee_id") == F.col("p.key_late_fee_id"), "left")
           .select(F.col("pp.consumer_uuid"), F.col("lf.country_code"), F.col("lf.instalment_id"),
                   F.col("lf.order_id"), F.col("p.par_region"), F.col("p.key_late_fee_id").alias("late_fee_id"),
                   *_entry("PAYMENT", amount_paid=F.col("p.amount_amount")),
                   F.col("p.payment_id"), F.col("p.event_time")).distinct())
    inv = fe14.select("consumer_uuid", "country_code", "instalment_id", "order_id", "par_region", "late_fee_id",
                      *_entry("INVOICED", amount_invoiced=F.col("amount_invoiced")),
                      F.lit(None).cast("bigint").alias("payment_id"), "event_time").distinct()
    w = scan(late_fee_waived, ctx, HORIZON_LONG).alias("w")
    waived = (w.join(lf, (F.col("w.key_late_fee_id") == F.col("lf.late_fee_id"))
                     & (F.col("w.payment_schedule_id") == F.col("lf.instalment_id"))
                     & (F.col("w.par_region") == F.col("lf.par_region")), "left")
              .select(F.col("lf.consumer_uuid"), F.col("lf.country_code"), F.col("lf.instalment_id"),
                      F.col("lf.order_id"), F.col("lf.par_region"), F.col("w.key_late_fee_id").alias("late_fee_id"),
                      *_entry("WAIVED", amount_waived=F.col("w.amount_amount")),
                      F.lit(None).cast("bigint").alias("payment_id"),
                      F.col("w.event_info_event_time").alias("event_time")).distinct())
    r = scan(late_fee_refunded, ctx, HORIZON_LONG).alias("r")
    refunded = (r.join(lf, (F.col("r.key_late_fee_id") == F.col("lf.late_fee_id"))
                       & (F.col("r.par_region") == F.col("lf.par_region")), "left")
                .select(F.col("lf.consumer_uuid"), F.col("lf.country_code"), F.col("lf.instalment_id"),
                        F.col("lf.order_id"), F.col("lf.par_region"),
                        F.col("r.key_late_fee_id").alias("late_fee_id"),
                        *_entry("REFUNDED", amount_refunded=F.col("r.amount_amount")),
                        F.lit(None).cast("bigint").alias("payment_id"),
                        F.col("r.event_info_event_time").alias("event_time")).distinct())
    return union_aligned([pay, inv, waived, refunded], LEDGER_SCHEMA)


def fe16_latefee_events_agg(fe15: DataFrame, consumer: DataFrame, ctx: Ctx) -> DataFrame:
    """Per fee: the four amounts and latest times of ledger entries in the
    last 360 local days (country from the consumer dimension; entries with no
    consumer drop out at the inner join)."""
    dc = consumer.select(F.col("uuid"), F.col("country_code").alias("dc_country"))
    j = fe15.join(dc, fe15["consumer_uuid"] == dc["uuid"], "inner").where(
        in_local_window(fe15["event_time"], dc["dc_country"], ctx, HORIZON_YEAR))
    t = F.col("event_type")
    return j.groupBy(F.col("consumer_uuid"), F.col("dc_country").alias("country_code"), "order_id", "instalment_id",
                     "late_fee_id").agg(
        sum_when(t == "INVOICED", "amount_invoiced", dtype=D20).alias("amount_invoiced"),
        sum_when(t == "PAYMENT", "amount_paid", dtype=D20).alias("amount_paid"),
        sum_when(t == "WAIVED", "amount_waived", dtype=D20).alias("amount_waived"),
        sum_when(t == "REFUNDED", "amount_refunded", dtype=D20).alias("amount_refunded"),
        max_when(t == "INVOICED", "event_time").alias("invoiced_time"),
        max_when(t == "PAYMENT", "event_time").alias("paid_time"),
        max_when(t == "WAIVED", "event_time").alias("waived_time"),
        max_when(t == "REFUNDED", "event_time").alias("refunded_time"),
    )


KINDS = (("paid", "paid_time", "amount_paid"), ("waived", "waived_time", "amount_waived"),
         ("refunded", "refunded_time", "amount_refunded"))


def fe17_cust_latefee(fe16: DataFrame, ctx: Ctx) -> DataFrame:
    """Per (consumer, country): paid / waived / refunded amount and fee count
    over 360 and 90 local days (window tested on the fee's latest entry time
    of that kind), and the first paid time as 19-character text.

    ``COUNT(DISTINCT CASE ...)`` x6 is computed in two aggregation levels
    instead of an ``Expand``: per fee a 0/1 "in window" flag, then a sum per
    consumer. Equal to the distinct count because a fee counts once when any
    of its rows is in the window."""
    cc = "country_code"
    lvl1 = []
    for kind, tcol, acol in KINDS:
        for d in WINDOWS:
            inside = in_local_window(tcol, cc, ctx, d)
            lvl1 += [sum_when(inside, acol, dtype=D20).alias(f"s_{kind}_{d}"),
                     any_when(inside).alias(f"f_{kind}_{d}")]
            if kind == "paid":
                lvl1.append(min_when(inside, local_ts(cc, tcol, ctx)).alias(f"m_{kind}_{d}"))
    per_fee = fe16.groupBy("consumer_uuid", cc, "late_fee_id").agg(*lvl1)
    # a null fee id is not counted by COUNT(DISTINCT ...)
    per_fee = per_fee.select("*", F.col("late_fee_id").isNotNull().alias("_has_id"))
    lvl2 = []
    for kind, _, _ in KINDS:
        for d in WINDOWS:
            lvl2.append(F.sum(f"s_{kind}_{d}").cast(D20).alias(f"c_late_fee_{kind}_amount_{d}d"))
    for kind, _, _ in KINDS:
        for d in WINDOWS:
            lvl2.append(F.sum(F.when(F.col("_has_id"), F.col(f"f_{kind}_{d}")).otherwise(F.lit(0)))
                        .cast("bigint").alias(f"c_late_fee_{kind}_cnt_{d}d"))
    for d in WINDOWS:
        lvl2.append(F.min(f"m_paid_{d}").alias(f"_first_{d}"))
    agg = per_fee.groupBy("consumer_uuid", cc).agg(*lvl2)
    out = ["consumer_uuid", cc]
    for d in WINDOWS:
        out.append(F.coalesce(F.col(f"c_late_fee_paid_amount_{d}d"), F.lit(0).cast(D20))
                   .alias(f"c_late_fee_paid_amount_{d}d"))
    for d in WINDOWS:
        out.append(F.col(f"c_late_fee_paid_cnt_{d}d"))
    for d in WINDOWS:
        out.append(F.coalesce(ts_text(F.col(f"_first_{d}")), F.lit(NO_DATETIME))
                   .alias(f"c_first_late_fee_paid_datetime_{d}d"))
    for kind in ("waived", "refunded"):
        for d in WINDOWS:
            out.append(F.col(f"c_late_fee_{kind}_amount_{d}d"))
        for d in WINDOWS:
            out.append(F.col(f"c_late_fee_{kind}_cnt_{d}d"))
    return agg.select(*out)
