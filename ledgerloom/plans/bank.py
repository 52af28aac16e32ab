"""The bank's tables: raw, staging, marts and views, each built and written on first use."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame

from ledgerloom.operators.checks import Check
from ledgerloom.plans import fixed_values as fixed
from ledgerloom.plans import marts, staging
from ledgerloom.plans.quality import bank_check_log, unreconciled
from ledgerloom.plans.views import VIEWS
from ledgerloom.sources.tables import in_parallel, write_table

_SIMPLE_STAGES = {
    "stg_district": staging.stage_district,
    "stg_account": staging.stage_account,
    "stg_client": staging.stage_client,
    "stg_disp": staging.stage_disp,
    "stg_card": staging.stage_card,
    "stg_loan": staging.stage_loan,
    "stg_order": staging.stage_order,
}
#: Tables that are not written on their own: both are parts of the table ``trans``.
_PARTS_OF_TRANS = ("stg_trans", "rej_trans")
#: Tables that the profile joins, in the order of ``account_base``.
_PARTS_OF_PROFILE = ("stg_account", "stg_disp", "stg_client", "stg_district", "stg_card", "stg_loan", "mart_account_month")
_PARTITIONS = {"trans": ["is_kept"], "mart_account_month": marts.MONTH_PARTITIONS}
TABLE_NAMES = (
    *_SIMPLE_STAGES,
    "stg_trans",
    "rej_trans",
    "unreconciled_accounts",
    "mart_account_month",
    "mart_account_360",
)


class Bank(Mapping[str, DataFrame]):
    """Lookup of tables by name; ``bank["mart_account_360"]`` writes what it needs below ``folder``.

    ``raw`` holds the eight raw tables under their file names, ``months`` the first and last month of
    the month table. Tables are replaced as a whole, so a run can be repeated. A table is built by one
    thread; others that ask for it wait.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        folder: str,
        months: tuple[str, str] = (fixed.FIRST_MONTH, fixed.LAST_MONTH),
    ):
        self._raw = raw
        self._folder = folder.rstrip("/")
        self.months = months
        self._done: dict[str, DataFrame] = {}
        self._guard = threading.Lock()
        self._locks: dict[str, threading.RLock] = {}

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock(name):
            if name not in self._done:
                if name in _PARTS_OF_TRANS:
                    self._done[name] = staging.kept_or_rejected(self["trans"], name)
                else:
                    self._done[name] = write_table(self._build(name), f"{self._folder}/{name}", _PARTITIONS.get(name, ()))
            return self._done[name]

    def _lock(self, name: str) -> threading.RLock:
        with self._guard:
            return self._locks.setdefault(name, threading.RLock())

    def __iter__(self) -> Iterator[str]:
        return iter([*(f"raw_{name}" for name in self._raw), *TABLE_NAMES, *VIEWS])

    def __len__(self) -> int:
        return len(self._raw) + len(TABLE_NAMES) + len(VIEWS)

    def _build(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self._raw[name.removeprefix("raw_")]
        if name in _SIMPLE_STAGES:
            return _SIMPLE_STAGES[name](self[name.replace("stg_", "raw_")])
        if name == "trans":
            return staging.tagged_trans(staging.split_trans(self["raw_trans"]))
        if name == "unreconciled_accounts":
            return unreconciled(self["stg_trans"])
        if name == "mart_account_month":
            return marts.build_account_month(self["stg_account"], self["stg_trans"], *self.months)
        if name == "mart_account_360":
            # Hardly any needs another, so a small one does not wait for the month table.
            in_parallel([lambda name=name: self[name] for name in _PARTS_OF_PROFILE])
            return marts.with_tier(marts.account_base(*[self[name] for name in _PARTS_OF_PROFILE]))
        if name in VIEWS:
            return VIEWS[name](self)
        raise KeyError(name)

    def build(self) -> None:
        """Write all tables; tables that do not need each other are written side by side.

        The views are small results that several reports read, so they are written as well.
        """
        steps = [
            [f"raw_{name}" for name in self._raw],
            [*_SIMPLE_STAGES, "trans"],
            ["unreconciled_accounts", "mart_account_month"],
            ["mart_account_360"],
            [*VIEWS],
        ]
        for step in steps:
            in_parallel([lambda name=name: self[name] for name in step])

    def check_log(self, run_ts: dt.datetime | None = None, more: Sequence[Check] = ()) -> DataFrame:
        """Result of all checks; the first call runs them and writes the log."""
        with self._lock("dq_log"):
            if "dq_log" not in self._done:
                self._done["dq_log"] = write_table(bank_check_log(self, run_ts, more), f"{self._folder}/dq_log")
            return self._done["dq_log"]
