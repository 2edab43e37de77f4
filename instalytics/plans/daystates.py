"""Features over long horizons from partial states by ingestion day.

A daily run of FE18, FE19 and FE21's spend reads 180 ingestion days or more to
add one. Here each ingestion day is reduced once to mergeable partial
aggregates, kept in a ``SnapshotTable`` by region and ingestion day; a run
updates the days that are new (or were ingested again: a day is replaced whole)
and merges the states that its window still holds.

States are exact for any later run clock: an order's state row carries the local
day of its events, which depends on event time and country alone, so the
local-day window is tested on states; events that come late are in the day they
came in. Days beyond every horizon expire; where history has no lower bound
(payment types), old days are merged into one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..context import HORIZON_HALF, Ctx
from ..functions.conditional import any_when, count_when
from ..functions.timecols import date_in_local_window, local_date
from .consumer import ATTEMPT_REASONS, D10, D20
from .snapshot import SnapshotTable

DAY = ["par_region", "par_process_date"]


class DayStates:
    """Partial aggregates of a source by ingestion day. ``partial(rows, ctx)``
    reduces rows to states that keep the day's columns; ``merge(states)`` reduces
    states of several days of one kind, without the day (only where days may be
    merged)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partial: Callable[[DataFrame, Ctx], DataFrame],
                 merge: Callable[[DataFrame], DataFrame] | None = None):
        self.table = SnapshotTable(spark, path, StructType.fromDDL(schema), DAY)
        self.partial, self.merge = partial, merge

    def _days(self, ctx: Ctx) -> list[date]:
        _, live = self.table.live()
        at = f"par_region={ctx.region}/par_process_date="
        return sorted(date.fromisoformat(f.removeprefix(at)) for f in live if f.startswith(at))

    def _own(self, ctx: Ctx, days: Iterable[date]) -> list[dict]:
        return [{"par_region": ctx.region, "par_process_date": d} for d in days]

    def update(self, source: DataFrame, ctx: Ctx, days: Iterable[date]) -> None:
        """Replace the states of these ingestion days; only their partitions of
        the source are read."""
        days = sorted(set(days))
        rows = source.where((F.col("par_region") == F.lit(ctx.region)) & F.col("par_process_date").isin(days))
        self.table.replace(self.partial(rows, ctx).repartition("par_process_date"), self._own(ctx, days))

    def update_merged(self, source: DataFrame, ctx: Ctx, until: date) -> None:
        """The states of all ingestion days up to ``until`` as those of that day."""
        rows = source.where((F.col("par_region") == F.lit(ctx.region)) & (F.col("par_process_date") <= F.lit(until)))
        self._put_merged(self.partial(rows, ctx), ctx, until)

    def merge_until(self, ctx: Ctx, until: date) -> None:
        """Merge the states of the days up to ``until`` into that day's."""
        self._put_merged(self.read(ctx).where(F.col("par_process_date") <= F.lit(until)), ctx, until)

    def _put_merged(self, states: DataFrame, ctx: Ctx, until: date) -> None:
        one = self.merge(states).select("*", F.lit(ctx.region).alias("par_region"), F.lit(until).alias("par_process_date"))
        self.table.replace(one, self._own(ctx, {until, *[d for d in self._days(ctx) if d <= until]}))

    def expire(self, ctx: Ctx, before: date) -> int:
        """Drop the days before ``before``; how many there were."""
        old = [d for d in self._days(ctx) if d < before]
        if old:
            self.table.replace(self.table.read().where("false"), self._own(ctx, old))
        return len(old)

    def read(self, ctx: Ctx) -> DataFrame:
        return self.table.read().where(F.col("par_region") == F.lit(ctx.region))


ORDER_STATE = ("consumer_uuid string, country_code string, local_day date, approved_online long, insufficient_online long, "
               f"attempts_online long, approved long, spend {D20}, par_region string, par_process_date date")


def order_partial(order: DataFrame, ctx: Ctx) -> DataFrame:
    """Orders per ingestion day, consumer, country and local day of the order."""
    tok, ok = F.col("key_token").isNotNull(), F.col("status") == "APPROVED"
    day = local_date("country_code", "key_event_info_event_time", ctx).alias("local_day")
    return order.groupBy(F.col("consumer_consumer_uuid").alias("consumer_uuid"), "country_code", day, *DAY).agg(
        count_when(tok & ok).alias("approved_online"),
        count_when(tok & (F.col("status_reason") == "INSUFFICIENT_FUNDS")).alias("insufficient_online"),
        count_when(tok & F.col("status_reason").isin(*ATTEMPT_REASONS)).alias("attempts_online"),
        count_when(ok).alias("approved"),
        F.sum(F.when(ok, F.col("consumer_total_amount_amount").cast(D10))).cast(D20).alias("spend"))


def order_states(spark: SparkSession, path: str) -> DayStates:
    return DayStates(spark, path, ORDER_STATE, order_partial)


def _in_window(states: DataFrame, ctx: Ctx) -> DataFrame:
    return states.where((F.col("par_process_date") >= F.lit(ctx.horizon(HORIZON_HALF)))
                        & date_in_local_window("local_day", "country_code", ctx, HORIZON_HALF))


def fe19_from_states(states: DataFrame, ctx: Ctx) -> DataFrame:
    """FE19 from the states of 180 ingestion days."""
    return _in_window(states, ctx).groupBy("consumer_uuid").agg(
        F.sum("approved_online").alias("c_order_cnt_180d"),
        F.sum("insufficient_online").alias("c_topaz_decl_insufficent_funds_cnt_180d"),
        F.sum("attempts_online").alias("c_order_attempt_cnt_180d"))


def spend_from_states(states: DataFrame, ctx: Ctx) -> DataFrame:
    """FE21's spend (``consumer.approved_spend``) from the states of 180 ingestion days."""
    return _in_window(states, ctx).where("approved > 0").groupBy("consumer_uuid").agg(F.sum("spend").cast(D20).alias("c_order_amt_180d"))


PAYMENT_STATE = "consumer_uuid string, credit int, par_region string, par_process_date date"


def payment_partial(payment_processed: DataFrame, ctx: Ctx) -> DataFrame:
    return payment_processed.groupBy(F.col("key_consumer_consumer_uuid").alias("consumer_uuid"), *DAY).agg(
        any_when(F.col("payment_method_credit_card_card_type") == "CREDIT").alias("credit"))


def payment_states(spark: SparkSession, path: str) -> DayStates:
    return DayStates(spark, path, PAYMENT_STATE, payment_partial, lambda s: s.groupBy("consumer_uuid").agg(F.max("credit").alias("credit")))


def fe18_from_states(states: DataFrame, ctx: Ctx) -> DataFrame:
    """FE18 from all states up to the run date."""
    one = states.where(F.col("par_process_date") <= F.lit(ctx.today)).groupBy("consumer_uuid").agg(F.max("credit").alias("_credit"))
    return one.select("consumer_uuid", F.when(F.col("_credit") == 1, F.lit("CREDIT")).otherwise(F.lit("DEBIT")).alias("c_best_payment_type"))


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]
