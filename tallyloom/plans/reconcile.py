"""The reconciliation program: two or three raw ledgers in, reports out."""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import comparing as cmp
from tallyloom.functions import parsing as ps
from tallyloom.operators import dedup as dd
from tallyloom.operators import matching as mt
from tallyloom.operators import paircounts as pc
from tallyloom.operators import presence as pr
from tallyloom.operators import summary as sm
from tallyloom.operators.skew import DEFAULT_GUARD, SkewGuard, heavy_keys
from tallyloom.session import drop_folder, work_folder


#: Balances to a hundredth of a cent.
EXACT_MONEY = "decimal(28,4)"


class Reconciliation:
    """Frames of one reconciliation, each built on first use.

    ``system``, ``counterpart`` and ``schedule`` are raw text ledgers. ``grain`` is
    ``row`` (every joined row counts) or ``account`` (one row per key and ledger).
    With ``keep`` the cleaned ledgers are written once to the shared folder, for runs that
    make several reports from them; ``release`` removes them, and frames built on them end
    there. Compared frames can be far longer than the ledgers and are never kept.
    ``money`` is the type of balances: with a decimal, such as ``EXACT_MONEY``, gaps and the
    tolerance are compared without binary rounding, so that a gap of exactly the tolerance agrees.
    """

    def __init__(
        self,
        system: DataFrame,
        counterpart: DataFrame,
        schedule: DataFrame | None = None,
        tolerance: float = cmp.TOLERANCE,
        grain: str = "row",
        first_due_only: bool = False,
        guard: SkewGuard | None = DEFAULT_GUARD,
        keep: bool = False,
        money: str = "double",
    ):
        if grain not in ("row", "account"):
            raise ValueError("grain must be row or account")
        self.system, self.counterpart, self.schedule = system, counterpart, schedule
        self.tolerance = tolerance if money == "double" else Decimal(str(tolerance))
        self.grain, self.first_due_only, self.money = grain, first_due_only, money
        self.guard, self.keep = guard, keep
        self._landed: list[str] = []
        self._heavy: dict[str, list] = {}

    def _land(self, df: DataFrame, name: str) -> DataFrame:
        if not self.keep:
            return df
        spark = df.sparkSession
        folder = work_folder(spark, f"ledger-{name}")
        self._landed.append(folder)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    def release(self) -> None:
        while self._landed:
            drop_folder(self.system.sparkSession, self._landed.pop())

    # ---- cleaned ledgers

    @cached_property
    def typed(self) -> DataFrame:
        return self._land(dd.typed_counterpart(self.counterpart, self.money), "typed")

    @cached_property
    def a(self) -> DataFrame:
        cleaned = mt.clean_system(self.system, self.money)
        return self._land(self._grained(cleaned, "day_a", "bal_a", "exact_bal", "acc_a"), "a")

    @cached_property
    def b(self) -> DataFrame:
        cleaned = mt.clean_counterpart(dd.dedup(self.typed))
        return self._land(self._grained(cleaned, "day_b", "bal_b", "acc_b"), "b")

    @cached_property
    def s(self) -> DataFrame:
        first = self.first_due_only or self.grain == "account"
        return self._land(mt.clean_schedule(self.schedule, first, self.money), "s")

    def _grained(self, cleaned: DataFrame, *order: str) -> DataFrame:
        return mt.one_per_account(cleaned, *order) if self.grain == "account" else cleaned

    def heavy(self, *names: str) -> list[list]:
        """Heavy keys of the ledgers named, from the account columns alone."""
        if self.guard is None or self.grain == "account":
            return [[] for _ in names]
        raw = {"a": self.system, "b": self.counterpart, "s": self.schedule}
        missing = [n for n in names if n not in self._heavy]
        if missing:
            if self.keep:
                keys = [getattr(self, n).select(mt.KEY) for n in missing]
            else:
                keys = [raw[n].select(ps.account_key("acc_no").alias(mt.KEY)) for n in missing]
            self._heavy.update(zip(missing, heavy_keys(keys, mt.KEY, self.guard)))
        return [self._heavy[n] for n in names]

    # ---- compared frames

    def _compare_ab(self, a: DataFrame, b: DataFrame, heavy: list[list]) -> DataFrame:
        return mt.compare_ab(a, b, self.tolerance, guard=self.guard, heavy=heavy)

    def _compare_sb(self, s: DataFrame, b: DataFrame, heavy: list[list]) -> DataFrame:
        return mt.compare_sb(s, b, self.tolerance, guard=self.guard, heavy=heavy)

    def _compare_three(self, a: DataFrame, b: DataFrame, s: DataFrame, heavy: list[list]) -> DataFrame:
        return mt.compare_three(a, b, s, self.tolerance, guard=self.guard, heavy=heavy)

    @cached_property
    def ab(self) -> DataFrame:
        return self._compare_ab(self.a, self.b, self.heavy("b", "a"))

    @cached_property
    def sb(self) -> DataFrame:
        return self._compare_sb(self.s, self.b, self.heavy("b", "s"))

    @cached_property
    def three(self) -> DataFrame:
        return self._compare_three(self.a, self.b, self.s, self.heavy("a", "b", "s"))

    # ---- what the counters read
    #
    # Counters need no row pairs: heavy accounts are counted by group, the rest joined.

    def _counted(self, names: str, frame: str, compare, count) -> list[DataFrame]:
        heavy = sorted(set().union(*self.heavy(*names)))
        if not heavy:
            return [getattr(self, frame)]
        ledgers = [getattr(self, n) for n in names]
        is_heavy = F.coalesce(F.col(mt.KEY).isin(heavy), F.lit(False))
        rest, hot = ([df.where(c) for df in ledgers] for c in (~is_heavy, is_heavy))
        return [compare(*rest, [[] for _ in names]), count(*hot, self.tolerance)]

    @cached_property
    def ab_counted(self) -> list[DataFrame]:
        return self._counted("ab", "ab", self._compare_ab, pc.heavy_ab_counts)

    @cached_property
    def sb_counted(self) -> list[DataFrame]:
        return self._counted("sb", "sb", self._compare_sb, pc.heavy_sb_counts)

    @cached_property
    def three_counted(self) -> list[DataFrame]:
        return self._counted("abs", "three", self._compare_three, pc.heavy_three_counts)

    # ---- one-row summaries

    @cached_property
    def ab_summary(self) -> DataFrame:
        return sm.ab_summary(self.system, self.b, *self.ab_counted)

    @cached_property
    def sb_summary(self) -> DataFrame:
        return sm.sb_summary(self.schedule, self.b, *self.sb_counted)

    @cached_property
    def three_summary(self) -> DataFrame:
        return sm.three_summary(self.a, self.b, self.s, *self.three_counted)

    @cached_property
    def dedup_report(self) -> DataFrame:
        return dd.dedup_report(self.typed)

    def unmatched(self, ledger: str, other: str) -> DataFrame:
        """Rows of one ledger (``a``, ``b``, ``s``) whose account another lacks."""
        rows = getattr(self, ledger)
        return pr.without_partner(rows, getattr(self, other), mt.KEY, self.heavy(ledger)[0])

    def presence(self) -> DataFrame:
        return pr.presence_buckets({"a": self.a, "b": self.b, "s": self.s}, mt.KEY)

    def matrix(self) -> DataFrame:
        """Metric by comparison; without a schedule only the first comparison is filled."""
        self.heavy(*("a", "b") if self.schedule is None else ("a", "b", "s"))
        if self.schedule is None:
            return sm.summary_matrix(self.ab_summary, None, None, self.dedup_report)
        return sm.summary_matrix(self.ab_summary, self.sb_summary, self.three_summary, self.dedup_report)
