"""States by ingestion day against full scans, over simulated days."""

import random
from datetime import date, datetime, timedelta

from instalytics import default_ctx
from instalytics.context import HORIZON_HALF
from instalytics.plans import consumer
from instalytics.plans.daystates import days_between, fe18_from_states, fe19_from_states, order_states, payment_states, spend_from_states
from instalytics.sources.schemas import SCHEMAS

DAY_MS = 86_400_000


def _same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _orders(spark, rnd, came, n):
    """Orders that came in on ``came``: most of that day, some up to 200 days late."""
    rows = []
    for _ in range(n):
        late = rnd.choice([0, 0, 0, 1, 3, 60, 179, 180, 200])
        ms = int((datetime(came.year, came.month, came.day) - datetime(1970, 1, 1)).total_seconds() * 1000) - late * DAY_MS + rnd.randrange(DAY_MS)
        status, reason = rnd.choice([("APPROVED", "APPROVED"), ("DECLINED", "INSUFFICIENT_FUNDS"), ("DECLINED", "OTHER")])
        rows.append({"order_transaction_id": rnd.randrange(10**9), "consumer_consumer_uuid": f"c{rnd.randrange(25)}",
                     "country_code": rnd.choice(["GB", "FR", "JP", "NZ", "BR", None]), "key_event_info_event_time": ms,
                     "consumer_total_amount_amount": None, "status": status, "status_reason": reason,
                     "key_token": rnd.choice(["t", None]), "par_region": rnd.choice(["GB", "GB", "US"]), "par_process_date": came, "amount": rnd.randrange(1, 9000)})
    df = spark.createDataFrame(rows, "order_transaction_id long, consumer_consumer_uuid string, country_code string, key_event_info_event_time long, "
                               "status string, status_reason string, key_token string, par_region string, par_process_date date, amount int")
    return df.selectExpr("*", "CAST(amount / 100 AS DECIMAL(20,2)) AS consumer_total_amount_amount")


def test_three_days_with_late_rows_equal_the_full_scan(spark, tmp_path):
    rnd = random.Random(21)
    first = date(2001, 8, 2)
    ctx = default_ctx(as_of=datetime(2001, 8, 2, 12))
    history = None
    for back in (181, 180, 179, 100, 30, 2, 1, 0):
        part = _orders(spark, rnd, first - timedelta(days=back), 40)
        history = part if history is None else history.unionByName(part)
    orders = history.cache()
    states = order_states(spark, str(tmp_path / "orders"))
    states.update(orders, ctx, days_between(ctx.horizon(HORIZON_HALF + 5), first))
    for step in range(3):
        now = first + timedelta(days=step)
        ctx = default_ctx(as_of=datetime(now.year, now.month, now.day, rnd.randrange(24)))
        if step:
            orders = orders.unionByName(_orders(spark, rnd, now, 60)).cache()
            states.update(orders, ctx, [now])
        if step == 2:  # a day is ingested again, with other rows
            again = first - timedelta(days=30)
            orders = orders.where(f"par_process_date <> DATE '{again}'").unionByName(_orders(spark, rnd, again, 25)).cache()
            states.update(orders, ctx, [again])
        read = states.read(ctx)
        full = consumer.fe19_cust_order_d180(orders, ctx)
        assert full.count() > 10
        _same(full, fe19_from_states(read, ctx))
        _same(consumer.approved_spend(orders, ctx), spend_from_states(read, ctx))
    assert states.expire(ctx, ctx.horizon(HORIZON_HALF)) == 3  # 181, 180 and 179 days before the first
    _same(consumer.fe19_cust_order_d180(orders, ctx), fe19_from_states(states.read(ctx), ctx))


def test_a_day_reads_its_own_partition_only(spark, tmp_path):
    rnd = random.Random(3)
    ctx = default_ctx()
    days = [ctx.today - timedelta(days=i) for i in range(4)]
    for d in days:
        _orders(spark, rnd, d, 20).write.mode("append").partitionBy("par_region", "par_process_date").parquet(str(tmp_path / "order"))
    orders = spark.read.parquet(str(tmp_path / "order"))
    states = order_states(spark, str(tmp_path / "states"))
    seen = []
    keep = states.partial
    states.partial = lambda rows, c: seen.append(rows) or keep(rows, c)
    states.update(orders, ctx, [days[0]])
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(par_region" in plan or "PartitionFilters: [" in plan and str(days[0]) in plan
    assert states._days(ctx) == [days[0]]


def test_payment_types_merge_and_grow(spark, tmp_path):
    ctx = default_ctx()
    t = ctx.today
    rows = [(f"c{i % 7}", "CREDIT" if i in (3, 9, 30) else "DEBIT" if i % 2 else None, "GB" if i % 3 else "US", t - timedelta(days=i % 40)) for i in range(200)]
    paid = spark.createDataFrame(rows, "key_consumer_consumer_uuid string, payment_method_credit_card_card_type string, par_region string, par_process_date date")
    assert set(paid.columns) <= {f.name for f in spark.createDataFrame([], SCHEMAS["payment_processed"]).schema}
    states = payment_states(spark, str(tmp_path / "paid"))
    states.update_merged(paid, ctx, ctx.horizon(10))
    states.update(paid, ctx, days_between(ctx.horizon(9), t))
    _same(consumer.fe18_cust_pymt_method(paid, ctx), fe18_from_states(states.read(ctx), ctx))
    states.merge_until(ctx, ctx.horizon(1))
    assert states._days(ctx) == [ctx.horizon(1), t]
    _same(consumer.fe18_cust_pymt_method(paid, ctx), fe18_from_states(states.read(ctx), ctx))
