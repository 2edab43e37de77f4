"""Operator queries: one reusable operator each, over the whole adapted test
tables (or features Spark derives from them), with an oracle in DuckDB SQL."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from .context import HORIZON_HALF, Ctx, default_ctx
from .functions.conditional import count_when, max_when, min_when, sum_when
from .functions.text import blank_to_null, classify_note, json_text
from .functions.timecols import days_late, in_local_window, local_date, local_today, local_ts, utc_ts
from .operators.aggregates import count_distinct_when
from .operators.dedup import number_in_group
from .operators.joins import anti_join, left_join_residual, presence_flag, star_join
from .operators.rank import percent_rank_global
from .operators.reshape import pivot_day_offsets, union_aligned
from .oracle.features import _note_case
from .oracle.sql import with_ctes
from .oracle.text import Sql
from .plans.daystates import days_between, fe18_from_states, fe19_from_states, order_states, payment_states, spend_from_states
from .plans.instalments import successful_payments
from .plans.limits import latest_approved_order, limit_asof, value_changes
from .plans.materialize import checkpoint_root
from .sources.testdata import build_sources

D10 = "decimal(10,2)"
D20 = "decimal(20,2)"


def _ctx() -> Ctx:
    return default_ctx(materialize=True)


def _src(spark, sf):
    return build_sources(spark, sf, default_ctx())


def _fs(spark, sf):
    from .catalog import feature_set

    return feature_set(spark, sf)


def op_latest_per_key(spark, sf):
    return successful_payments(_src(spark, sf).payment_processed, default_ctx())


def op_number_in_group(spark, sf):
    ps = _src(spark, sf).payment_scheduled.select("key_payment_schedule_id", "order_transaction_id",
                                                  "event_info_event_time")
    return number_in_group(ps, ["order_transaction_id"], ["key_payment_schedule_id"], "seq",
                           tiebreak=["event_info_event_time"])


def op_previous_value(spark, sf):
    return value_changes(_src(spark, sf).decision_value_change, default_ctx()).select(
        "consumer_uuid", "timestamp", "old_value", "last_old_value")


def op_percent_rank_global(spark, sf):
    o = _src(spark, sf).order
    spend = o.groupBy(F.col("consumer_consumer_uuid").alias("consumer_uuid")).agg(
        F.sum(F.when(F.col("status") == "APPROVED", F.col("consumer_total_amount_amount"))).cast(D20).alias("spend"))
    return percent_rank_global(spend, "spend", "pct_rank").select("consumer_uuid", "spend", "pct_rank")


def op_asof_latest(spark, sf):
    ctx = _ctx()
    fs = _fs(spark, sf)
    return limit_asof(latest_approved_order(fs.src.order, ctx, status=None), fs["fe09"], ctx)


def op_left_join_residual(spark, sf):
    ctx = default_ctx()
    fs = _fs(spark, sf)
    base = fs["fe01"].select("instalment_id", "order_id", "consumer_uuid", "country_code")
    ev = fs["fe04"].select(F.col("instalment_id").alias("e_iid"), F.col("order_id").alias("e_oid"),
                           F.col("consumer_uuid").alias("e_uuid"), "payment_id", "event_time")
    j = left_join_residual(base, ev, [("instalment_id", "e_iid"), ("order_id", "e_oid"), ("consumer_uuid", "e_uuid")],
                           lambda b, e: in_local_window(e["event_time"], b["country_code"], ctx, 90))
    return j.select("instalment_id", "order_id", "payment_id", "event_time")


def op_range_left_join(spark, sf):
    ctx = default_ctx()
    fs = _fs(spark, sf)
    line = fs["fe08"].select("consumer_consumer_uuid", "line_change_ts_360d")
    ovd = fs["fe23"].where(F.col("ovd_expt") == 0).select("consumer_uuid", "country_code", "key_payment_schedule_id",
                                                          "ovd_ts")
    j = left_join_residual(line, ovd, [("consumer_consumer_uuid", "consumer_uuid")],
                           lambda n, o: local_date(o["country_code"], o["ovd_ts"], ctx) >= F.to_date(n["line_change_ts_360d"]))
    return j.select("consumer_consumer_uuid", "key_payment_schedule_id", "ovd_ts")


def op_anti_join(spark, sf):
    fs = _fs(spark, sf)
    return anti_join(fs["fe05"], fs["fe23"], "instalment_id", "key_payment_schedule_id").select(
        "instalment_id", "consumer_uuid", "current_due_date")


def op_presence_flag(spark, sf):
    fs = _fs(spark, sf)
    return presence_flag(fs["fe05"].select("instalment_id", "consumer_uuid"), fs["fe23"], "instalment_id",
                         "key_payment_schedule_id", "is_overdue")


def op_star_join(spark, sf):
    fs = _fs(spark, sf)
    return star_join(fs["fe22"].select("consumer_uuid", "country_code"),
                     [(fs["fe18"], ["consumer_uuid"]), (fs["fe19"], ["consumer_uuid"]), (fs["fe27"], ["consumer_uuid"])])


def op_conditional_agg(spark, sf):
    ev = _fs(spark, sf)["fe04"]
    t = F.col("event_type")
    return ev.groupBy("consumer_uuid").agg(
        count_when(t == "PAYMENT").alias("n_payments"),
        sum_when(t == "DISCOUNT", "amount_paid", dtype=D20).alias("discount_total"),
        max_when(t == "PAYMENT", "event_time").alias("last_payment_ms"),
        min_when(t == "DISCOUNT", "event_time").alias("first_discount_ms"))


def op_count_distinct_when(spark, sf):
    ctx = default_ctx()
    f16 = _fs(spark, sf)["fe16"]
    cc = "country_code"
    return count_distinct_when(f16, ["consumer_uuid", cc], "late_fee_id", {
        "paid_fees_360d": in_local_window("paid_time", cc, ctx, 360),
        "paid_fees_90d": in_local_window("paid_time", cc, ctx, 90),
        "waived_fees_360d": in_local_window("waived_time", cc, ctx, 360),
    })


def op_pivot_day_offsets(spark, sf):
    ctx = default_ctx()
    return pivot_day_offsets(_src(spark, sf).limit_daily, ["par_region", "country_code", "consumer_uuid"],
                             "created_local_date", "daily_account_limit", local_today("country_code", ctx),
                             (1, 7, 30), "limit_{}d_ago")


def op_distinct_rows(spark, sf):
    return _src(spark, sf).payment_processed.select(
        "key_consumer_consumer_uuid", "payment_method_credit_card_card_type", "payment_status").distinct()


ACTIVITY = [("consumer_uuid", "string"), ("event_ms", "bigint"), ("amount", D10), ("kind", "string")]


def op_union_aligned(spark, sf):
    ctx = default_ctx()
    fs = _fs(spark, sf)
    o = fs.src.order.where((F.col("status") == "APPROVED") & (F.col("par_region") == ctx.region)).select(
        F.col("consumer_consumer_uuid").alias("consumer_uuid"), F.col("key_event_info_event_time").alias("event_ms"),
        F.col("consumer_total_amount_amount").cast(D10).alias("amount"), F.lit("ORDER").alias("kind"))
    chk = fs["fe12"].select("consumer_uuid", F.col("key_event_info_event_time").alias("event_ms"),
                            F.col("osb_amount").alias("amount"), F.lit("CHECK").alias("kind"))
    return union_aligned([o, chk], ACTIVITY)


FEE_ROWS = [("key_late_fee_id", "bigint"), ("event_info_event_time", "bigint"), ("amount_amount", D20),
            ("kind", "string")]


def op_append(spark, sf):
    s = _src(spark, sf)
    w = s.late_fee_waived.select("key_late_fee_id", "event_info_event_time", "amount_amount",
                                 F.lit("WAIVED").alias("kind"))
    r = s.late_fee_refunded.select("key_late_fee_id", "event_info_event_time", "amount_amount",
                                   F.lit("REFUNDED").alias("kind"))
    return union_aligned([w, r], FEE_ROWS)


def op_local_window(spark, sf):
    ctx = default_ctx()
    o = _src(spark, sf).order
    t = "key_event_info_event_time"
    return o.where(in_local_window(t, "country_code", ctx, 90, end=0)).select(
        "order_transaction_id", "consumer_consumer_uuid", local_date("country_code", t, ctx).alias("local_date"))


def op_epoch_local_time(spark, sf):
    ctx = default_ctx()
    t = "key_event_info_event_time"
    return _src(spark, sf).order.select(
        "order_transaction_id", "country_code", utc_ts(t).alias("utc_ts"), local_ts("country_code", t, ctx).alias("local_ts"),
        local_date("country_code", t, ctx).alias("local_date"))


def op_days_between(spark, sf):
    ctx = default_ctx()
    ovd = _fs(spark, sf)["fe23"]
    return ovd.select(
        "key_payment_schedule_id", "ovd_ts", "expt_ts",
        days_late("current_due_date", "paid_cnt", "latest_instal_paid_date", "full_waived",
                  "latest_instal_waived_date", "country_code", ctx).cast("bigint").alias("days_late"),
        F.datediff(local_today("country_code", ctx), F.col("current_due_date")).cast("bigint").alias("days_since_due"))


def op_blank_to_null_cast(spark, sf):
    d = _src(spark, sf).due_date_changed
    return d.select("key_payment_schedule_id", "event_info_event_time", "new_due_date_string",
                    blank_to_null("new_due_date_string", "date").alias("new_due_date"))


def op_json_path(spark, sf):
    r = _src(spark, sf).rules_engine_result
    txt = json_text("input_variables", "amountOwing", "value")
    return r.select("order_id", "input_variables", txt.alias("amount_owing_text"),
                    blank_to_null(txt, D10).alias("osb_amount"))


def op_classify_note(spark, sf):
    o = _src(spark, sf).schedule_override
    return o.select("key_payment_schedule_id", "event_info_event_time", "note", classify_note("note").alias("category"))


def op_greatest_coalesce(spark, sf):
    b = _src(spark, sf).limit_change_backfill
    inc, dec = F.col("c_latest_limit_increase_ts"), F.col("c_latest_limit_decrease_ts")
    return b.select("entity_id", F.greatest(inc, dec).alias("latest_change_ts"),
                    F.coalesce(dec, inc).alias("decrease_or_increase_ts"))


def op_top_sample(spark, sf):
    o = _src(spark, sf).order.where(F.col("status") == "APPROVED")
    return (o.orderBy(F.col("consumer_total_amount_amount").desc(), F.col("order_transaction_id").asc())
            .limit(100).select("order_transaction_id", "consumer_consumer_uuid", "consumer_total_amount_amount"))


def _state_path(spark, name):
    return f"{checkpoint_root(spark)}/instalytics/states-{name}-{uuid.uuid4().hex}"


def op_day_states_orders(spark, sf):
    """FE19 and FE21's spend from day states: the history, then day by day the
    last two days, and the expired ones dropped."""
    fs = _fs(spark, sf)
    ctx, order = fs.ctx, fs.src.order
    states = order_states(spark, _state_path(spark, "orders"))
    first, last = ctx.horizon(HORIZON_HALF + 1), ctx.today
    states.update(order, ctx, days_between(first, last - timedelta(days=2)))
    for day in (last - timedelta(days=1), last):
        states.update(order, ctx, [day])
    states.expire(ctx, ctx.horizon(HORIZON_HALF))
    read = states.read(ctx)
    return fe19_from_states(read, ctx).join(spend_from_states(read, ctx), "consumer_uuid", "left")


def op_day_states_payment_type(spark, sf):
    """FE18 from day states: the history merged into one, then two days, merged in turn."""
    fs = _fs(spark, sf)
    ctx, paid = fs.ctx, fs.src.payment_processed
    states = payment_states(spark, _state_path(spark, "payments"))
    states.update_merged(paid, ctx, ctx.horizon(2))
    states.update(paid, ctx, [ctx.horizon(1)])
    states.merge_until(ctx, ctx.horizon(1))
    states.update(paid, ctx, [ctx.today])
    return fe18_from_states(states.read(ctx), ctx)


OP_QUERIES = {f.__name__: f for f in [
    op_latest_per_key, op_number_in_group, op_previous_value, op_percent_rank_global, op_asof_latest,
    op_left_join_residual, op_range_left_join, op_anti_join, op_presence_flag, op_star_join, op_conditional_agg,
    op_count_distinct_when, op_pivot_day_offsets, op_distinct_rows, op_union_aligned, op_append, op_local_window,
    op_epoch_local_time, op_days_between, op_blank_to_null_cast, op_json_path, op_classify_note,
    op_greatest_coalesce, op_top_sample, op_day_states_orders, op_day_states_payment_type,
]}


def op_oracle_sql(ctx: Ctx | None = None) -> dict[str, str]:
    ctx = ctx or default_ctx()
    q = Sql(ctx)
    t = q.local_today
    G = q.region
    s: dict[str, str] = {}
    s["op_latest_per_key"] = "SELECT * FROM pp_latest"
    s["op_number_in_group"] = """
SELECT key_payment_schedule_id, order_transaction_id, event_info_event_time,
  CAST(ROW_NUMBER() OVER (PARTITION BY order_transaction_id ORDER BY key_payment_schedule_id ASC NULLS LAST,
    event_info_event_time ASC NULLS LAST) AS BIGINT) AS seq
FROM src_payment_scheduled"""
    s["op_previous_value"] = """
SELECT consumer_uuid, "timestamp", old_value, CAST(last_old_value AS DECIMAL(10,2)) AS last_old_value FROM vc_prev"""
    s["op_percent_rank_global"] = """
SELECT consumer_uuid, spend, percent_rank() OVER (ORDER BY spend ASC NULLS LAST) AS pct_rank
FROM (SELECT consumer_consumer_uuid AS consumer_uuid,
        CAST(SUM(CASE WHEN status = 'APPROVED' THEN consumer_total_amount_amount END) AS DECIMAL(20,2)) AS spend
      FROM src_order GROUP BY consumer_consumer_uuid)"""
    s["op_asof_latest"] = "SELECT * FROM asof_any"
    s["op_left_join_residual"] = f"""
SELECT base.instalment_id, base.order_id, ev.payment_id, ev.event_time
FROM fe01 base LEFT JOIN fe04 ev ON ev.instalment_id = base.instalment_id AND ev.order_id = base.order_id
  AND ev.consumer_uuid = base.consumer_uuid AND {q.win('ev.event_time', 'base.country_code', 90)}"""
    s["op_range_left_join"] = f"""
SELECT line.consumer_consumer_uuid, ovd.key_payment_schedule_id, ovd.ovd_ts
FROM fe08 line LEFT JOIN (SELECT * FROM fe23 WHERE ovd_expt = 0) ovd
  ON line.consumer_consumer_uuid = ovd.consumer_uuid
  AND {q.ldate('ovd.country_code', 'ovd.ovd_ts')} >= CAST(line.line_change_ts_360d AS DATE)"""
    s["op_anti_join"] = """
SELECT instal.instalment_id, instal.consumer_uuid, instal.current_due_date
FROM fe05 instal LEFT JOIN fe23 ovd ON instal.instalment_id = ovd.key_payment_schedule_id
WHERE ovd.key_payment_schedule_id IS NULL"""
    s["op_presence_flag"] = """
SELECT instalment_id, consumer_uuid,
  CASE WHEN EXISTS (SELECT 1 FROM fe23 WHERE fe23.key_payment_schedule_id = fe05.instalment_id) THEN 1 ELSE 0 END
    AS is_overdue
FROM fe05"""
    s["op_star_join"] = """
SELECT b.consumer_uuid, b.country_code, cpm.c_best_payment_type, co.c_order_cnt_180d,
  co.c_topaz_decl_insufficent_funds_cnt_180d, co.c_order_attempt_cnt_180d, cot.c_ontime_pymt_cnt_180d
FROM fe22 b LEFT JOIN fe18 cpm ON b.consumer_uuid = cpm.consumer_uuid
LEFT JOIN fe19 co ON b.consumer_uuid = co.consumer_uuid
LEFT JOIN fe27 cot ON b.consumer_uuid = cot.consumer_uuid"""
    s["op_conditional_agg"] = """
SELECT consumer_uuid, CAST(SUM(CASE WHEN event_type = 'PAYMENT' THEN 1 ELSE 0 END) AS BIGINT) AS n_payments,
  CAST(SUM(CASE WHEN event_type = 'DISCOUNT' THEN amount_paid ELSE 0 END) AS DECIMAL(20,2)) AS discount_total,
  MAX(CASE WHEN event_type = 'PAYMENT' THEN event_time END) AS last_payment_ms,
  MIN(CASE WHEN event_type = 'DISCOUNT' THEN event_time END) AS first_discount_ms
FROM fe04 GROUP BY consumer_uuid"""
    s["op_count_distinct_when"] = f"""
SELECT consumer_uuid, country_code,
  CAST(COUNT(DISTINCT CASE WHEN {q.win('paid_time', 'country_code', 360)} THEN late_fee_id END) AS BIGINT) AS paid_fees_360d,
  CAST(COUNT(DISTINCT CASE WHEN {q.win('paid_time', 'country_code', 90)} THEN late_fee_id END) AS BIGINT) AS paid_fees_90d,
  CAST(COUNT(DISTINCT CASE WHEN {q.win('waived_time', 'country_code', 360)} THEN late_fee_id END) AS BIGINT)
    AS waived_fees_360d
FROM fe16 GROUP BY consumer_uuid, country_code"""
    piv = ", ".join(f"MAX(CASE WHEN created_local_date = {t('country_code')} - {k} THEN daily_account_limit END) "
                    f"AS limit_{k}d_ago" for k in (1, 7, 30))
    s["op_pivot_day_offsets"] = f"""
SELECT par_region, country_code, consumer_uuid, {piv} FROM src_limit_daily
GROUP BY par_region, country_code, consumer_uuid"""
    s["op_distinct_rows"] = """
SELECT DISTINCT key_consumer_consumer_uuid, payment_method_credit_card_card_type, payment_status
FROM src_payment_processed"""
    s["op_union_aligned"] = f"""
SELECT consumer_consumer_uuid AS consumer_uuid, key_event_info_event_time AS event_ms,
  CAST(consumer_total_amount_amount AS DECIMAL(10,2)) AS amount, 'ORDER' AS kind
FROM src_order WHERE status = 'APPROVED' AND par_region = {G}
UNION ALL
SELECT consumer_uuid, key_event_info_event_time, osb_amount, 'CHECK' FROM fe12"""
    s["op_append"] = """
SELECT key_late_fee_id, event_info_event_time, amount_amount, 'WAIVED' AS kind FROM src_late_fee_waived
UNION ALL
SELECT key_late_fee_id, event_info_event_time, amount_amount, 'REFUNDED' FROM src_late_fee_refunded"""
    tcol = "key_event_info_event_time"
    s["op_local_window"] = f"""
SELECT order_transaction_id, consumer_consumer_uuid, {q.ldate('country_code', tcol)} AS local_date
FROM src_order WHERE {q.win(tcol, 'country_code', 90, end=0)}"""
    s["op_epoch_local_time"] = f"""
SELECT order_transaction_id, country_code, {q.utc_ts(tcol)} AS utc_ts, {q.lts('country_code', tcol)} AS local_ts,
  {q.ldate('country_code', tcol)} AS local_date
FROM src_order"""
    s["op_days_between"] = f"""
SELECT key_payment_schedule_id, ovd_ts, expt_ts, CAST({q.days_late()} AS BIGINT) AS days_late,
  CAST(date_diff('day', current_due_date, {t('country_code')}) AS BIGINT) AS days_since_due
FROM fe23"""
    s["op_blank_to_null_cast"] = """
SELECT key_payment_schedule_id, event_info_event_time, new_due_date_string,
  TRY_CAST(NULLIF(new_due_date_string, '') AS DATE) AS new_due_date
FROM src_due_date_changed"""
    jt = "CASE WHEN json_valid(input_variables) THEN json_extract_string(input_variables, '$.amountOwing.value') END"
    s["op_json_path"] = f"""
SELECT order_id, input_variables, {jt} AS amount_owing_text, TRY_CAST(NULLIF({jt}, '') AS DECIMAL(10,2)) AS osb_amount
FROM src_rules_engine_result"""
    s["op_classify_note"] = f"""
SELECT key_payment_schedule_id, event_info_event_time, note, {_note_case('note')} AS category
FROM src_schedule_override"""
    s["op_greatest_coalesce"] = """
SELECT entity_id, GREATEST(c_latest_limit_increase_ts, c_latest_limit_decrease_ts) AS latest_change_ts,
  COALESCE(c_latest_limit_decrease_ts, c_latest_limit_increase_ts) AS decrease_or_increase_ts
FROM src_limit_change_backfill"""
    s["op_top_sample"] = """
SELECT order_transaction_id, consumer_consumer_uuid, consumer_total_amount_amount FROM src_order
WHERE status = 'APPROVED' ORDER BY consumer_total_amount_amount DESC, order_transaction_id ASC LIMIT 100"""
    s["op_day_states_orders"] = "SELECT fe19.*, fe21_amt.c_order_amt_180d FROM fe19 LEFT JOIN fe21_amt USING (consumer_uuid)"
    s["op_day_states_payment_type"] = "SELECT * FROM fe18"
    return {k: with_ctes(v, ctx) for k, v in s.items()}
