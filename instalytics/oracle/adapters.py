"""The test-table adapters of ``sources.testdata`` restated in DuckDB SQL."""

from __future__ import annotations

from .fixed import BACKFILL_FROM, EVENT_SHIFT_DAYS, LIMIT_DAYS, OVERRIDE_NOTES
from .text import Sql


def adapter_ctes(q: Sql) -> dict[str, str]:
    ctx = q.ctx
    asof = q.as_of_ms
    day = 86400000
    notes = "[" + ", ".join("'" + n + "'" for n in OVERRIDE_NOTES) + "]"
    ovd_rows = f"_q > 25 AND _due < {q.today}"
    cur_d = f"CAST(c_acctbal AS DECIMAL(20,2))"

    def dms(n: int) -> str:
        return q.ms_of_date(f"_due + {n}")

    c: dict[str, str] = {}
    c["o"] = f"""
SELECT *, {q.uuid('o_custkey')} AS _uuid, {q.reg('o_custkey')} AS _reg, {q.cc('o_custkey')} AS _cc,
  {q.ms_of_date('CAST(o_orderdate AS DATE)')} + (o_orderkey % 86400) * 1000 + o_orderkey % 1000 AS _t0,
  CASE WHEN o_orderkey % 5 <> 0 THEN 't' || CAST(o_orderkey AS VARCHAR) END AS _tok,
  CAST(o_orderdate AS DATE) AS _odate
FROM orders"""
    c["src_order"] = """
SELECT o_orderkey AS order_transaction_id, _uuid AS consumer_consumer_uuid, _cc AS country_code,
  _t0 AS key_event_info_event_time, o_orderpriority = '1-URGENT' AS first_payment_up_front,
  CAST(o_totalprice AS DECIMAL(20,2)) AS consumer_total_amount_amount,
  CASE WHEN o_orderstatus = 'P' THEN 'DECLINED' ELSE 'APPROVED' END AS status,
  CASE WHEN o_orderstatus <> 'P' THEN 'APPROVED' WHEN o_orderkey % 3 = 0 THEN 'INSUFFICIENT_FUNDS'
       WHEN o_orderkey % 3 = 1 THEN 'FRAUD_RULE_BREACH' ELSE 'OTHER' END AS status_reason,
  _tok AS key_token, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey ELSE -1 END AS pos_pre_approval_id,
  _reg AS par_region, _odate AS par_process_date
FROM o"""
    c["line0"] = """
SELECT *, ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000
            + (CAST(l_shipdate AS DATE) - DATE '1995-01-01') AS _iid,
  _odate + CAST(14 * l_linenumber AS INTEGER) AS _due, CAST(l_quantity AS INTEGER) AS _q
FROM lineitem JOIN o ON l_orderkey = o_orderkey"""
    c["line"] = f"""
SELECT *, {q.ms_of_date('_due + (_q - 25)')} + (l_partkey % 86400) * 1000 AS _paid FROM line0"""
    c["src_payment_scheduled"] = """
SELECT _iid AS key_payment_schedule_id, l_orderkey AS order_transaction_id, CAST(_due AS VARCHAR) AS due_date_string,
  CAST(l_extendedprice AS DECIMAL(20,2)) AS amount_amount, _t0 AS event_info_event_time, _reg AS par_region,
  _odate AS par_process_date
FROM line"""
    c["src_due_date_changed"] = f"""
SELECT * FROM (
  SELECT _uuid AS key_consumer_consumer_uuid, _iid AS key_payment_schedule_id, l_orderkey AS order_transaction_id,
    _t0 + 3 * {day} AS event_info_event_time, CAST(_due AS VARCHAR) AS old_due_date_string,
    CASE WHEN l_partkey % 13 = 0 THEN '' ELSE CAST(_due + 7 AS VARCHAR) END AS new_due_date_string,
    _reg AS par_region, {q.utc_date(f'_t0 + 3 * {day}')} AS par_process_date
  FROM line WHERE l_returnflag = 'R'
  UNION ALL
  SELECT _uuid, _iid, l_orderkey, _t0 + 5 * {day}, CAST(_due AS VARCHAR), CAST(_due + 10 AS VARCHAR),
    _reg, {q.utc_date(f'_t0 + 5 * {day}')}
  FROM line WHERE l_returnflag = 'R' AND l_partkey % 4 = 0
) WHERE event_info_event_time <= {asof}"""
    c["src_instalment_payment"] = f"""
SELECT _iid AS key_payment_schedule_id, _iid AS key_payment_id, _paid AS event_time,
  CAST(l_extendedprice AS DECIMAL(20,2)) AS amount_amount,
  CASE WHEN l_partkey % 17 = 0 THEN 'PARTIAL' ELSE 'PAID' END AS payment_schedule_status,
  _reg AS par_region, {q.utc_date('_paid')} AS par_process_date
FROM line WHERE _q <= 40 AND _paid <= {asof}"""
    card = "CASE WHEN l_suppkey % 2 = 0 THEN 'CREDIT' ELSE 'DEBIT' END"
    promo = "CASE WHEN l_discount > 0.08 THEN 'PROMO' ELSE '' END"
    c["src_payment_processed"] = f"""
SELECT * FROM (
  SELECT _uuid AS key_consumer_consumer_uuid, _iid AS key_payment_id, {promo} AS payment_method_discount_name,
    {card} AS payment_method_credit_card_card_type,
    CASE WHEN l_partkey % 19 = 0 THEN 'FAILED' ELSE 'SUCCESSFUL' END AS payment_status,
    _paid AS event_info_event_time, _reg AS par_region, {q.utc_date('_paid')} AS par_process_date
  FROM line WHERE _q <= 40
  UNION ALL
  SELECT _uuid, _iid, {promo}, {card}, 'SUCCESSFUL', _paid - 60000, _reg, {q.utc_date('_paid - 60000')}
  FROM line WHERE _q <= 40 AND l_partkey % 6 = 0
  UNION ALL
  SELECT _uuid, _iid + 5000, '', {card}, 'SUCCESSFUL', {dms(6)}, _reg, {q.utc_date(dms(6))}
  FROM line WHERE {ovd_rows} AND _q > 40 AND l_partkey % 3 = 0
) WHERE event_info_event_time <= {asof}"""
    c["src_became_overdue"] = f"""
SELECT _iid AS key_payment_schedule_id, l_orderkey AS order_transaction_id, {dms(1)} AS event_info_event_time,
  _reg AS par_region, _due + 1 AS par_process_date
FROM line WHERE {ovd_rows}"""
    c["src_schedule_override"] = f"""
SELECT _iid AS key_payment_schedule_id, l_orderkey AS key_order_transaction_id, {dms(2)} AS event_info_event_time,
  l_partkey % 10 = 0 AS override_overdue_status, {notes}[CAST(l_partkey % {len(OVERRIDE_NOTES)} AS INTEGER) + 1] AS note,
  _reg AS par_region, _due + 2 AS par_process_date
FROM line WHERE {ovd_rows} AND l_partkey % 5 = 0 AND {dms(2)} <= {asof}"""
    fee = f"{ovd_rows} AND _q > 40"
    c["src_late_fee_applied"] = f"""
SELECT _iid AS payment_schedule_id, _iid + 3000 AS key_late_fee_id, {dms(3)} AS event_info_event_time,
  CAST(6 AS DECIMAL(20,2)) AS amount_amount, _reg AS par_region, _due + 3 AS par_process_date
FROM line WHERE {fee} AND {dms(3)} <= {asof}"""
    c["src_late_fee_payment"] = f"""
SELECT _iid + 3000 AS key_late_fee_id, _iid + 5000 AS payment_id, {dms(6)} AS event_time,
  CAST(6 AS DECIMAL(20,2)) AS amount_amount, _reg AS par_region, _due + 6 AS par_process_date
FROM line WHERE {fee} AND l_partkey % 3 = 0 AND {dms(6)} <= {asof}"""
    c["src_late_fee_waived"] = f"""
SELECT _iid + 3000 AS key_late_fee_id, _iid AS payment_schedule_id, {dms(5)} AS event_info_event_time,
  CAST(6 AS DECIMAL(20,2)) AS amount_amount, _reg AS par_region, _due + 5 AS par_process_date
FROM line WHERE {fee} AND l_partkey % 3 = 1 AND {dms(5)} <= {asof}"""
    c["src_late_fee_refunded"] = f"""
SELECT _iid + 3000 AS key_late_fee_id, {dms(9)} AS event_info_event_time,
  CAST(2 AS DECIMAL(20,2)) AS amount_amount, _reg AS par_region, _due + 9 AS par_process_date
FROM line WHERE {fee} AND l_partkey % 3 = 0 AND l_partkey % 2 = 0 AND {dms(9)} <= {asof}"""
    ems = f"(epoch_us(ts) // 1000 - CAST({EVENT_SHIFT_DAYS} AS BIGINT) * {day})"
    c["src_decision_value_change"] = f"""
SELECT {q.uuid('user_id')} AS consumer_uuid, {q.cc('user_id')} AS country_code,
  CAST(value AS DECIMAL(10,2)) AS old_value, {ems} AS "timestamp", {q.reg('user_id')} AS par_region,
  {q.utc_date(ems)} AS par_process_date
FROM events WHERE event_type IN ('view', 'click') AND {ems} <= {asof}"""
    ets = f"(ts - INTERVAL {EVENT_SHIFT_DAYS} DAY)"
    c["src_credit_limit_result"] = f"""
SELECT {q.uuid('user_id')} AS consumer_uuid, {ets} AS event_info_event_time,
  CAST(value AS DECIMAL(20,2)) AS otb_amount_amount, CAST(value + 100 AS DECIMAL(20,2)) AS account_limit_amount,
  {q.reg('user_id')} AS par_region, CAST({ets} AS DATE) AS par_process_date
FROM events WHERE event_type = 'signup' AND epoch_us({ets}) // 1000 <= {asof}"""
    inc = q.ms_of_date(f"DATE '{BACKFILL_FROM}' + CAST(c_custkey % 100 AS INTEGER)")
    c["src_limit_change_backfill"] = f"""
SELECT {q.uuid('c_custkey')} AS entity_id, {q.cc('c_custkey')} AS country_code, {inc} AS c_latest_limit_increase_ts,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE {inc} + 5 * {day} END AS c_latest_limit_decrease_ts
FROM customer WHERE c_custkey % 7 = 0"""
    c["ok_orders"] = """
SELECT o.*, c_acctbal FROM o JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'"""
    token = "COALESCE(_tok, 'p' || CAST(o_orderkey AS VARCHAR))"
    ext = "('x' || CAST(o_orderkey AS VARCHAR))"
    cp = "CASE WHEN o_orderkey % 5 = 0 THEN 'BARCODE_GENERATION' ELSE 'ONLINE_CHECKOUT_START' END"
    c["src_decision_vars"] = f"""
SELECT _uuid AS consumer_uuid, {token} AS order_token, {ext} AS pos_external_id, {cp} AS input_checkpointtype,
  CAST(o_totalprice AS DECIMAL(20,2)) AS account_limit_amount, {cur_d} AS input_otbamount,
  CAST(o_custkey % 1000 AS DECIMAL(20,2)) AS input_amountowing, epoch_ms(_t0) AS created_datetime,
  CASE WHEN o_orderkey % 23 = 0 THEN '0' ELSE '1' END AS approved, _reg AS par_region, _odate AS par_created_date
FROM ok_orders WHERE _odate < {q.cutover}"""
    js = ("CASE WHEN o_orderkey % 11 = 0 THEN 'bad' WHEN o_orderkey % 7 = 0 THEN '{}' "
          "ELSE '{\"amountOwing\":{\"value\":\"' || CAST(o_custkey % 1000 AS VARCHAR) || '.50\"}}' END")
    c["src_rules_engine_result"] = f"""
SELECT _uuid AS consumer_uuid, {token} AS order_id, {ext} AS pos_external_id, {cp} AS check_point_type,
  CAST(o_totalprice AS DECIMAL(20,2)) AS account_limit_amount, {cur_d} AS available_barcode_amount_amount,
  {js} AS input_variables, _t0 AS event_info_event_time,
  CASE WHEN o_orderkey % 23 = 0 THEN 'false' ELSE 'true' END AS approved, _reg AS par_region,
  _odate AS par_process_date
FROM ok_orders WHERE _odate >= {q.cutover}"""
    c["src_pre_approval"] = f"""
SELECT {ext} AS external_id, o_orderkey AS key_id, _t0 - 3600000 AS event_info_event_time, _reg AS par_region,
  {q.utc_date('_t0 - 3600000')} AS par_process_date
FROM o WHERE o_orderkey % 5 = 0"""
    c["src_consumer"] = f"""
SELECT {q.uuid('c_custkey')} AS uuid, c_custkey AS id, {q.cc('c_custkey')} AS country_code,
  {q.reg('c_custkey')} AS par_region, f.first_order_date
FROM customer LEFT JOIN (SELECT o_custkey, MIN(_odate) AS first_order_date FROM o WHERE o_orderstatus <> 'P'
                         GROUP BY o_custkey) f ON c_custkey = f.o_custkey"""
    c["src_limit_daily"] = "\nUNION ALL\n".join(f"""
SELECT {q.reg('c_custkey')} AS par_region, {q.cc('c_custkey')} AS country_code, {q.uuid('c_custkey')} AS consumer_uuid,
  {q.local_today(q.cc('c_custkey'))} - {k} AS created_local_date,
  CAST(c_acctbal + {k} AS DECIMAL(10,2)) AS daily_account_limit
FROM customer""" for k in LIMIT_DAYS)
    return c
