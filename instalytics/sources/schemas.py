"""Declared schemas of the 19 inputs (only the columns the features read).

Money is DECIMAL(20,2) on read (the features cast it further where the
output contract says so); event times are BIGINT epoch milliseconds, except
the two TIMESTAMP columns noted below. ``par_region`` / ``par_process_date``
are directory partitions of the event tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

MS = T.LongType()
ID = T.LongType()
S = T.StringType()
MONEY = T.DecimalType(20, 2)
LIMIT = T.DecimalType(10, 2)

PARTS = [T.StructField("par_region", S), T.StructField("par_process_date", T.DateType())]


def _st(cols, parts=True) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols] + (PARTS if parts else []))


SCHEMAS: dict[str, T.StructType] = {
    "payment_scheduled": _st([
        ("key_payment_schedule_id", ID), ("order_transaction_id", ID), ("due_date_string", S),
        ("amount_amount", MONEY), ("event_info_event_time", MS)]),
    "order": _st([
        ("order_transaction_id", ID), ("consumer_consumer_uuid", S), ("country_code", S),
        ("key_event_info_event_time", MS), ("first_payment_up_front", T.BooleanType()),
        ("consumer_total_amount_amount", MONEY), ("status", S), ("status_reason", S), ("key_token", S),
        ("pos_pre_approval_id", ID)]),
    "due_date_changed": _st([
        ("key_consumer_consumer_uuid", S), ("key_payment_schedule_id", ID), ("order_transaction_id", ID),
        ("event_info_event_time", MS), ("old_due_date_string", S), ("new_due_date_string", S)]),
    "instalment_payment": _st([
        ("key_payment_schedule_id", ID), ("key_payment_id", ID), ("event_time", MS), ("amount_amount", MONEY),
        ("payment_schedule_status", S)]),
    "payment_processed": _st([
        ("key_consumer_consumer_uuid", S), ("key_payment_id", ID), ("payment_method_discount_name", S),
        ("payment_method_credit_card_card_type", S), ("payment_status", S), ("event_info_event_time", MS)]),
    "became_overdue": _st([
        ("key_payment_schedule_id", ID), ("order_transaction_id", ID), ("event_info_event_time", MS)]),
    "schedule_override": _st([
        ("key_payment_schedule_id", ID), ("key_order_transaction_id", ID), ("event_info_event_time", MS),
        ("override_overdue_status", T.BooleanType()), ("note", S)]),
    "decision_value_change": _st([
        ("consumer_uuid", S), ("country_code", S), ("old_value", LIMIT), ("timestamp", MS)]),
    "limit_change_backfill": _st([
        ("entity_id", S), ("country_code", S), ("c_latest_limit_increase_ts", MS),
        ("c_latest_limit_decrease_ts", MS)], parts=False),
    "decision_vars": T.StructType([
        T.StructField("consumer_uuid", S), T.StructField("order_token", S), T.StructField("pos_external_id", S),
        T.StructField("input_checkpointtype", S), T.StructField("account_limit_amount", MONEY),
        T.StructField("input_otbamount", MONEY), T.StructField("input_amountowing", MONEY),
        # local wall clock, no zone
        T.StructField("created_datetime", T.TimestampNTZType()), T.StructField("approved", S),
        T.StructField("par_region", S), T.StructField("par_created_date", T.DateType())]),
    "rules_engine_result": _st([
        ("consumer_uuid", S), ("order_id", S), ("pos_external_id", S), ("check_point_type", S),
        ("account_limit_amount", MONEY), ("available_barcode_amount_amount", MONEY), ("input_variables", S),
        ("event_info_event_time", MS), ("approved", S)]),
    "pre_approval": _st([("external_id", S), ("key_id", ID), ("event_info_event_time", MS)]),
    # event time is a UTC TIMESTAMP here, not epoch ms
    "credit_limit_result": _st([
        ("consumer_uuid", S), ("event_info_event_time", T.TimestampNTZType()), ("otb_amount_amount", MONEY),
        ("account_limit_amount", MONEY)]),
    "late_fee_applied": _st([
        ("payment_schedule_id", ID), ("key_late_fee_id", ID), ("event_info_event_time", MS), ("amount_amount", MONEY)]),
    "late_fee_payment": _st([
        ("key_late_fee_id", ID), ("payment_id", ID), ("event_time", MS), ("amount_amount", MONEY)]),
    "late_fee_waived": _st([
        ("key_late_fee_id", ID), ("payment_schedule_id", ID), ("event_info_event_time", MS), ("amount_amount", MONEY)]),
    "late_fee_refunded": _st([
        ("key_late_fee_id", ID), ("event_info_event_time", MS), ("amount_amount", MONEY)]),
    "consumer": T.StructType([
        T.StructField("uuid", S), T.StructField("id", ID), T.StructField("country_code", S),
        T.StructField("par_region", S), T.StructField("first_order_date", T.DateType())]),
    "limit_daily": T.StructType([
        T.StructField("par_region", S), T.StructField("country_code", S), T.StructField("consumer_uuid", S),
        T.StructField("created_local_date", T.DateType()), T.StructField("daily_account_limit", LIMIT)]),
}

SOURCE_NAMES = tuple(SCHEMAS)
