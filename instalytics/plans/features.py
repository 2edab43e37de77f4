"""All 33 features over one set of sources, built lazily and at most once.

``FeatureSet(src, ctx)["fe23"]`` returns the DataFrame of FE23, building
its inputs first. With a ``RunStore`` the re-used intermediates are written
once and read back, which cuts their lineage (a lost executor then re-reads
files instead of re-running the upstream joins) and lets other features and
sessions of the same run find them; with ``ctx.materialize`` alone they are
written for this set only."""

from __future__ import annotations

import threading
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import Ctx
from ..sources.bundle import Sources
from . import consumer, instalments, latefees, limits, master, overdue, utilisation
from .materialize import materialize
from .store import RunStore

# Intermediates read by several features.
REUSED = ("payments", "instalments", "spend", "fe01", "fe05", "fe06", "fe08", "fe09", "fe14", "fe23", "fe26", "fe31", "orders_rollup")


# Stored by key: the overdue joins read FE05 by instalment without an exchange of it.
BUCKETED = {"fe05": ("instalment_id",)}
# What the master reads of these, each from other sources: written at the same time.
MASTER_READS = ("fe23", "fe26", "fe31", "fe14", "fe09", "orders_rollup")


class FeatureSet:
    def __init__(self, src: Sources, ctx: Ctx, store: RunStore | None = None):
        self.src, self.ctx, self.store = src, ctx, store
        self._cache, self._locks, self._all = {}, defaultdict(threading.RLock), threading.Lock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._all:
            lock = self._locks[name]
        with lock:  # features depend on each other without cycles
            if name not in self._cache:
                self._cache[name] = self._kept(name) if name in REUSED else getattr(self, "_" + name)()
            return self._cache[name]

    def _kept(self, name: str) -> DataFrame:
        build = getattr(self, "_" + name)
        if self.store is not None:
            return self.store.table(name, build, BUCKETED.get(name, ()))
        return materialize(build(), name) if self.ctx.materialize else build()

    def prefetch(self, names) -> None:
        """Build these at the same time, where they are written; what two of them
        need is built once."""
        if self.store is None and not self.ctx.materialize:
            return
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(self.__getitem__, names))

    def result(self, name: str) -> DataFrame:
        """The feature as a result: its inputs are materialised, itself not."""
        return self._cache[name] if name in self._cache else getattr(self, "_" + name)()

    def as_dict(self, names) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}

    # -- instalments
    def _instalments(self):
        return instalments.instalment_rows(self.src.payment_scheduled, self.src.order, self.ctx)

    def _fe01(self):
        return instalments.fe01_instal_invoice(self["instalments"])

    def _fe02(self):
        return instalments.fe02_due_date_history(self.src.due_date_changed, self["fe01"], self.ctx)

    def _fe03(self):
        return instalments.fe03_due_date_valid(self["fe02"])

    def _payments(self):
        return instalments.successful_payments(self.src.payment_processed, self.ctx)

    def _fe04(self):
        return instalments.fe04_instal_events(self.src.instalment_payment, self["payments"], self["fe01"], self.ctx)

    def _fe05(self):
        self.prefetch(("fe01", "payments"))
        return instalments.fe05_instal_events_agg(self["fe01"], self["fe04"], self["fe03"], self.ctx)

    # -- limits
    def _fe06(self):
        return limits.fe06_order_d360(self.src.order, self.ctx)

    def _fe07(self):
        return limits.fe07_line_change(self.src.decision_value_change, self.src.limit_change_backfill, self.ctx)

    def _fe08(self):
        return limits.fe08_line_change_window(self["fe06"], self["fe07"], self.ctx)

    def _fe09(self):
        return limits.fe09_de_limit(self.src.decision_vars, self.src.rules_engine_result, self.ctx)

    def _fe10(self):
        return limits.fe10_cust_approved_limit(self.src.order, self["fe09"], self.ctx)

    def _fe11(self):
        return limits.fe11_order_attempt(self["fe09"], self.src.pre_approval, self.ctx)

    def _fe12(self):
        return limits.fe12_limit_check(self.src.credit_limit_result, self.ctx)

    def _fe13(self):
        return limits.fe13_otb(self["fe11"], self["fe12"])

    # -- late fees
    def _fe14(self):
        return latefees.fe14_latefee_invoice(self.src.late_fee_applied, self["instalments"], self.ctx)

    def _fe15(self):
        s = self.src
        self.prefetch(("fe14", "payments"))
        return latefees.fe15_latefee_events(s.late_fee_payment, self["payments"], s.late_fee_waived,
                                            s.late_fee_refunded, self["fe14"], self.ctx)

    def _fe16(self):
        return latefees.fe16_latefee_events_agg(self["fe15"], self.src.consumer, self.ctx)

    def _fe17(self):
        return latefees.fe17_cust_latefee(self["fe16"], self.ctx)

    # -- consumer
    def _fe18(self):
        return consumer.fe18_cust_pymt_method(self.src.payment_processed, self.ctx)

    def _fe19(self):
        return consumer.fe19_cust_order_d180(self.src.order, self.ctx)

    def _fe20(self):
        return consumer.fe20_cust_account_limit(self.src.limit_daily, self.ctx)

    def _fe20m(self):
        # master form: only the wanted days are scanned (same 0 defaults)
        return consumer.fe20_cust_account_limit(self.src.limit_daily, self.ctx, keep_empty=False)

    def _spend(self):
        return consumer.approved_spend(self.src.order, self.ctx)

    def _fe21(self):
        return consumer.fe21_cust_approved_order_d180(self["spend"])

    def _fe22(self):
        return consumer.fe22_cust_base(self.src.consumer, self.ctx)

    # -- overdue
    def _fe23(self):
        return overdue.fe23_instal_ovd_d360(self.src.became_overdue, self.src.schedule_override, self["fe05"],
                                            self.ctx)

    def _fe24(self):
        return overdue.fe24_cust_ovd_d360(self["fe23"])

    def _fe25(self):
        return overdue.fe25_cust_instal_d360(self["fe05"], self["fe23"], self.ctx)

    def _fe26(self):
        return overdue.fe26_instal_ontime_d180(self["fe05"], self["fe23"], self.ctx)

    def _fe27(self):
        return overdue.fe27_cust_ontime_d180(self["fe26"])

    def _fe28(self):
        return overdue.fe28_cust_ovd_d180(self["fe23"], self["fe26"], self.ctx)

    def _fe29(self):
        return overdue.fe29_cust_late_expt_d360(self["fe23"], self.ctx)

    def _fe30(self):
        return overdue.fe30_cust_ovd_limit_d360(self["fe08"], self["fe23"], self.ctx)

    # -- utilisation
    def _fe31(self):
        self.prefetch(("fe08", "fe09"))
        return utilisation.fe31_util_d180(self["fe08"], self["fe13"], self.ctx)

    def _fe32(self):
        return utilisation.fe32_cust_util_d180(self["fe06"], self["fe31"], self.ctx)

    # -- master forms of the order features: one scan / shuffle of orders
    def _orders_rollup(self):
        return consumer.order_rollup(self.src.order, self.ctx)

    def _fe10m(self):
        base = self["orders_rollup"].where("_has_latest = 1").select(
            F.col("consumer_uuid").alias("consumer_consumer_uuid"), "country_code", "latest_order_datetime")
        return limits.limit_asof(base, self["fe09"], self.ctx)

    def _fe19m(self):
        return consumer.fe19_from_rollup(self["orders_rollup"])

    def _fe21m(self):
        return consumer.fe21_from_rollup(self["orders_rollup"])

    # -- master
    def _fe33(self):
        self.prefetch(MASTER_READS)
        names = {"fe22": "fe22", "fe10": "fe10m", "fe17": "fe17", "fe18": "fe18", "fe19": "fe19m", "fe20m": "fe20m",
                 "fe21": "fe21m", "fe24": "fe24", "fe25": "fe25", "fe27": "fe27", "fe28": "fe28", "fe29": "fe29",
                 "fe30": "fe30", "fe32": "fe32"}
        return master.fe33_consumer_master({k: self[v] for k, v in names.items()}, self.ctx)
