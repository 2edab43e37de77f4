"""Hand-made edge rows through single feature functions (FIXTURES.md D)."""

from datetime import date, datetime
from decimal import Decimal

from instalytics.plans.instalments import fe05_instal_events_agg
from instalytics.plans.limits import fe10_cust_approved_limit
from instalytics.plans.overdue import fe29_cust_late_expt_d360
from instalytics.sources.schemas import SCHEMAS

FE23_COLS = ("key_payment_schedule_id long, order_transaction_id long, consumer_uuid string, country_code string, "
             "ovd_ts long, expt_ts long, upfront_instalment int, current_due_date date, paid_cnt long, "
             "latest_instal_paid_date date, latest_instal_waived_date date, ovd_expt int, expt_record int, "
             "category string, full_waived int")


def test_goodwill_date_defaults_to_local_epoch(spark, ctx):
    ms = int((datetime(2001, 7, 20, 10) - datetime(1970, 1, 1)).total_seconds() * 1000)
    rows = [
        (1, 1, "gb", "GB", ms, ms, 0, date(2001, 7, 1), 0, None, None, 1, 1, "Hardship", 0),
        (2, 2, "us", "US", ms, ms, 0, date(2001, 7, 1), 0, None, None, 1, 1, "Complaint", 0),
        (3, 3, "gw", "GB", ms, ms, 0, date(2001, 7, 1), 0, None, None, 1, 1, "Goodwill", 0),
    ]
    got = {r.consumer_uuid: (r.c_latest_late_expt_date_360d, r.c_latest_late_expt_goodwill_date_360d)
           for r in fe29_cust_late_expt_d360(spark.createDataFrame(rows, FE23_COLS), ctx).collect()}
    assert got["gb"] == (date(2001, 7, 20), date(1970, 1, 1))   # London was UTC+1 at epoch 0
    assert got["us"] == (date(2001, 7, 20), date(1969, 12, 31))  # New York: previous evening
    assert got["gw"] == (date(2001, 7, 20), date(2001, 7, 20))


def test_limit_decided_after_last_order_keeps_consumer_with_null(spark, ctx):
    def ms(y, m, d, h=12):
        return int((datetime(y, m, d, h) - datetime(1970, 1, 1)).total_seconds() * 1000)

    order = spark.createDataFrame([
        (1, "a", "GB", ms(2001, 7, 1), False, Decimal("10.00"), "APPROVED", "APPROVED", "t1", -1, "GB",
         date(2001, 7, 1)),
        (2, "b", "GB", ms(2001, 7, 1), False, Decimal("10.00"), "APPROVED", "APPROVED", "t2", -1, "GB",
         date(2001, 7, 1)),
    ], SCHEMAS["order"])
    de = spark.createDataFrame([
        ("a", "t1", "x", "ONLINE_CHECKOUT_START", Decimal("500.00"), None, None, ms(2001, 7, 2), None),
        ("b", "t2", "x", "ONLINE_CHECKOUT_START", Decimal("700.00"), None, None, ms(2001, 6, 30), None),
        ("b", "t3", "x", "ONLINE_CHECKOUT_START", Decimal("800.00"), None, None, ms(2001, 7, 1, 23), None),
    ], "consumer_uuid string, order_id string, pos_external_id string, checkpoint_type string, "
       "account_limit_amount decimal(10,2), otb_amount decimal(10,2), osb_amount decimal(10,2), "
       "event_info_event_time long, limit_local_datetime timestamp_ntz")
    got = {r.consumer_uuid: (r.c_latest_approved_credit_limit, r.event_date)
           for r in fe10_cust_approved_limit(order, de, ctx).collect()}
    assert got["a"] == (None, None)                              # only decision is a day later
    # 23:00 UTC on 07-01 is 07-02 in London: after the order's local day
    assert got["b"] == (Decimal("700.00"), date(2001, 6, 30))


def test_fully_discounted_instalment_is_full_waived(spark, ctx):
    fe01 = spark.createDataFrame([
        ("c", "GB", 10, date(2001, 7, 15), Decimal("50.00"), 0, "GB", datetime(2001, 6, 1), 7,
         datetime(2001, 6, 1), True, Decimal("100.00"), 1),
        ("c", "GB", 11, date(2001, 7, 29), Decimal("50.00"), 0, "GB", datetime(2001, 6, 1), 7,
         datetime(2001, 6, 1), True, Decimal("100.00"), 2),
    ], "consumer_uuid string, country_code string, instalment_id long, original_due_date date, "
       "inv_amount decimal(20,2), invoice_event_time long, par_region string, invoice_event_datetime timestamp_ntz, "
       "order_id long, order_event_datetime timestamp_ntz, first_payment_up_front boolean, "
       "consumer_amount decimal(20,2), instalment_seq_id long")
    paid_ms = int((datetime(2001, 7, 10) - datetime(1970, 1, 1)).total_seconds() * 1000)
    fe04 = spark.createDataFrame([
        ("c", "GB", 10, 7, "GB", "DISCOUNT", 1, None, paid_ms, Decimal("50.00"), Decimal("0.00"), "PAID"),
        ("c", "GB", 11, 7, "GB", "PAYMENT", 2, None, paid_ms, Decimal("50.00"), Decimal("0.00"), "PAID"),
    ], "consumer_uuid string, country_code string, instalment_id long, order_id long, par_region string, "
       "event_type string, payment_id long, refund_id long, event_time long, amount_paid decimal(20,2), "
       "amount_waived decimal(20,2), payment_schedule_status string")
    fe03 = spark.createDataFrame([], "instalment_id long, order_id long, due_date date")
    got = {r.instalment_id: r for r in fe05_instal_events_agg(fe01, fe04, fe03, ctx).collect()}
    assert got[10].full_waived == 1 and got[10].paid_cnt == 0 and got[10].upfront_instalment == 1
    assert got[11].full_waived == 0 and got[11].paid_cnt == 1 and got[11].upfront_instalment == 0
    assert got[11].latest_instal_paid_date == date(2001, 7, 10)


def test_fee_paid_on_rejected_order_stays_in_ledger(spark, ctx):
    from instalytics.plans.instalments import successful_payments
    from instalytics.plans.latefees import fe15_latefee_events

    d = date(2001, 7, 20)
    ms = int((datetime(2001, 7, 20, 9) - datetime(1970, 1, 1)).total_seconds() * 1000)
    pay = spark.createDataFrame([(900, 77, ms, Decimal("6.00"), "GB", d)], SCHEMAS["late_fee_payment"])
    processed = spark.createDataFrame([("cx", 77, "", "DEBIT", "SUCCESSFUL", ms, "GB", d)],
                                      SCHEMAS["payment_processed"])
    empty = {n: spark.createDataFrame([], SCHEMAS[n]) for n in ("late_fee_waived", "late_fee_refunded")}
    fe14 = spark.createDataFrame([], "consumer_uuid string, country_code string, order_id long, instalment_id long, "
                                     "late_fee_id long, event_time long, amount_invoiced decimal(20,2), "
                                     "par_region string")  # the fee's order was not approved: no invoice row
    rows = fe15_latefee_events(pay, successful_payments(processed, ctx), empty["late_fee_waived"], empty["late_fee_refunded"], fe14,
                               ctx).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.event_type, r.consumer_uuid, r.order_id, r.late_fee_id, r.amount_paid) == \
        ("PAYMENT", "cx", None, 900, Decimal("6.00"))


def test_paid_instalment_of_an_order_without_country(spark, ctx):
    """A null country counts as UTC; its payments must not be lost in FE05."""
    from instalytics.plans.instalments import fe05_instal_events_agg

    now = datetime(2001, 7, 1, 10)
    ms = int((now - datetime(1970, 1, 1)).total_seconds() * 1000)
    fe01 = spark.createDataFrame(
        [("u", c, i, date(2001, 7, 1), Decimal("10.00"), ms, "GB", now, i, now, False, Decimal("10.00"), 1) for i, c in ((1, None), (2, "GB"))],
        "consumer_uuid string, country_code string, instalment_id long, original_due_date date, inv_amount decimal(20,2), "
        "invoice_event_time long, par_region string, invoice_event_datetime timestamp_ntz, order_id long, "
        "order_event_datetime timestamp_ntz, first_payment_up_front boolean, consumer_amount decimal(20,2), instalment_seq_id long")
    fe04 = spark.createDataFrame(
        [("u", c, i, i, "GB", "PAYMENT", i, None, ms, Decimal("10.00"), Decimal("0.00"), "PAID") for i, c in ((1, None), (2, "GB"))],
        "consumer_uuid string, country_code string, instalment_id long, order_id long, par_region string, event_type string, "
        "payment_id long, refund_id long, event_time long, amount_paid decimal(20,2), amount_waived decimal(20,2), "
        "payment_schedule_status string")
    fe03 = spark.createDataFrame([], "instalment_id long, order_id long, due_date date")
    got = {r.instalment_id: (r.paid_cnt, r.latest_instal_paid_date) for r in fe05_instal_events_agg(fe01, fe04, fe03, ctx).collect()}
    assert got == {1: (1, date(2001, 7, 1)), 2: (1, date(2001, 7, 1))}
