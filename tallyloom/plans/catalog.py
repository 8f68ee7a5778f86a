"""Every registered query: a name, and how to build it from the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import comparing as cmp
from tallyloom.functions import labels as lb
from tallyloom.functions import parsing as ps
from tallyloom.operators import bands as bd
from tallyloom.operators import dedup as dd
from tallyloom.operators import instalment as ins
from tallyloom.operators import lookups as lk
from tallyloom.operators import matching as mt
from tallyloom.operators import sketches as sk
from tallyloom.operators import summary as sm
from tallyloom.operators import tabular as tb
from tallyloom.operators import topn as tn
from tallyloom.operators import waterfall as wf
from tallyloom.operators.literals import literal_rows
from tallyloom.operators.skew import SkewGuard, expand_copies
from tallyloom.plans.reconcile import EXACT_MONEY, Reconciliation
from tallyloom.session import fill_cores, settle, spread, tune, work_folder
from tallyloom.sinks import outputs as out
from tallyloom.sinks import versions as vs
from tallyloom.sources import delimited as dl
from tallyloom.sources import derived as dv
from tallyloom.sources import files as fl
from tallyloom.sources import rejects as rj

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Due principal of each year as a share of the loan, and the yearly payment.
DUE_SHARES = [0.015, 0.025, 0.03, 0.035, 0.04, 0.045, 0.05, 0.06, 0.07, 0.08, 0.09, 0.1, 0.11, 0.12]
PAYMENT_SHARE = 0.08
CONTRACT_DATE = "2024-06-15"


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(tune(spark), folder)

    QUERIES[build.__name__] = run
    return build


def ledgers(spark: SparkSession, folder: str, hot: int | None = None, **options) -> Reconciliation:
    orders = fill_cores(dv.table(spark, folder, "orders"))
    return Reconciliation(
        *(ledger(orders, hot) for ledger in (dv.system_ledger, dv.counterpart_ledger, dv.schedule_ledger)), **options
    )


def _settled(r: Reconciliation, report: Callable[[Reconciliation], DataFrame]) -> DataFrame:
    """A short report over kept frames, computed before the frames are let go."""
    try:
        return settle(report(r))
    finally:
        r.release()


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def _day(name: str) -> Column:
    return F.col(name).cast("date")


# ---- duplicates and conflicts ---------------------------------------------


@query
def dedup_b(spark, folder):
    return dd.dedup(ledgers(spark, folder).typed)


@query
def dedup_b_with_source(spark, folder):
    """The first copy of each row by file name, with its file and the number of copies."""
    return dd.first_rows(ledgers(spark, folder).typed)


@query
def dedup_report(spark, folder):
    return ledgers(spark, folder).dedup_report


@query
def conflict_accounts(spark, folder):
    return dd.conflict_accounts(ledgers(spark, folder).typed)


@query
def conflict_records(spark, folder):
    return dd.conflict_records(ledgers(spark, folder).typed)


# ---- system against counterpart -------------------------------------------


@query
def filter_active_group(spark, folder):
    return mt.active_only(ledgers(spark, folder).system)


@query
def normalize_key(spark, folder):
    schedule = ledgers(spark, folder).schedule
    return schedule.select("acc_no", ps.account_key("acc_no").alias("acc_key"))


@query
def reconcile_ab(spark, folder):
    return mt.ab_rows(ledgers(spark, folder).ab)


@query
def discrepancies_ab(spark, folder):
    return mt.ab_rows(ledgers(spark, folder).ab, errors_only=True)


@query
def classify_ab(spark, folder):
    return sm.class_counts(*ledgers(spark, folder).ab_counted)


@query
def summary_ab(spark, folder):
    return ledgers(spark, folder).ab_summary


@query
def summary_ab_by_account(spark, folder):
    return ledgers(spark, folder, grain="account").ab_summary


@query
def exact_balance_checks(spark, folder):
    return sm.exact_balance_checks(*ledgers(spark, folder).ab_counted)


@query
def balance_error_stats(spark, folder):
    return sm.balance_error_stats(ledgers(spark, folder).ab)


@query
def date_diff_stats(spark, folder):
    return sm.date_diff_stats(ledgers(spark, folder).ab)


@query
def error_histogram(spark, folder):
    return sm.error_histogram(ledgers(spark, folder).ab)


@query
def error_histogram_thinned(spark, folder):
    return sm.merged_bins(sm.error_histogram(ledgers(spark, folder).ab))


@query
def quality_metrics(spark, folder):
    return sm.quality_metrics(ledgers(spark, folder).ab_summary)


@query
def class_shares(spark, folder):
    return sm.class_shares(sm.class_counts(*ledgers(spark, folder).ab_counted))


@query
def debt_separation(spark, folder):
    return mt.debt_separation(ledgers(spark, folder).ab)


@query
def severity_bands(spark, folder):
    rows = mt.ab_rows(ledgers(spark, folder).ab, errors_only=True)
    marked = F.when(F.col("is_debt_separation"), F.lit("debt_separation")).otherwise(F.lit("plain"))
    return rows.select(
        "acc_no", "date_b", "bal_diff", cmp.severity(F.col("bal_diff")).alias("severity"), marked.alias("row_class")
    )


@query
def sketched_error_stats(spark, folder):
    """Statistics of each comparison from its daily sketches, and whether their ranks hold."""
    r = ledgers(spark, folder)
    errors = [
        expand_copies(frame.where(mt.is_error())).select(F.lit(name).alias("comparison"), F.col("day_b").alias("day"), F.col("bal_diff").alias("gap"))
        for name, frame in (("ab", r.ab), ("sb", r.sb))
    ]
    rows = settle(errors[0].unionByName(errors[1]))
    stats = settle(sk.statistics(sk.sketches(rows, ["comparison", "day"], "gap"), ["comparison"]))

    def holds(name: str, share: float) -> Column:
        below, upto = (F.count_if(c) / F.count(F.lit(1)) for c in (F.col("gap") < F.col(name), F.col("gap") <= F.col(name)))
        return (below <= share + sk.RANK_ERROR) & (upto >= share - sk.RANK_ERROR)

    # One row per comparison.
    ranked = rows.join(F.broadcast(stats), "comparison").groupBy("comparison").agg(
        *(F.max(c).alias(c) for c in ("n", "mean", "std", "min", "max")),
        reduce(lambda a, b: a & b, (holds(name, share) for name, share in sk.QUANTILES.items())).alias("within_error"),
    )
    return ranked.select(
        "comparison", "n", F.round("mean", 4).alias("mean"), F.round("std", 2).alias("std"), F.round("min", 4).alias("min"),
        F.round("max", 4).alias("max"), "within_error",
    )


@query
def scatter_sample(spark, folder):
    return tn.scatter_sample(mt.ab_rows(ledgers(spark, folder).ab, errors_only=True))


def _penny_gaps(spark, folder, hot: int | None = None, guard=SkewGuard()) -> Reconciliation:
    """The ledgers with gaps of one and two hundredths in every fifth system balance, compared exactly."""
    plain = ledgers(spark, folder, hot)
    cents = F.floor(F.col("pre_balance").cast("decimal(18,2)") * 100).cast("bigint") % 5
    more = F.when(cents == 1, F.lit("0.01")).when(cents == 2, F.lit("0.02")).otherwise(F.lit("0.00")).cast("decimal(18,2)")
    system = plain.system.withColumn("pre_balance", (F.col("pre_balance").cast("decimal(18,2)") + more).cast("string"))
    return Reconciliation(system, plain.counterpart, plain.schedule, guard=guard, money=EXACT_MONEY)


@query
def reconcile_ab_decimal(spark, folder):
    """Row by row in decimals: a gap of exactly the tolerance agrees."""
    rows = mt.ab_rows(_penny_gaps(spark, folder).ab)
    gap = F.col("bal_diff").cast("string")
    return rows.select("acc_no", "date_a", "date_b", gap.alias("bal_diff"), "bal_diff_pct", "bal_match", "mismatch")


@query
def classify_ab_decimal_hot(spark, folder):
    """Class counts in decimals with every third order under one account, counted by group."""
    r = _penny_gaps(spark, folder, hot=3, guard=SkewGuard(min_rows=50))
    return _plain_counts(sm.class_counts(*r.ab_counted))


@query
def scatter_cells(spark, folder):
    return tn.scatter_cells(mt.ab_rows(ledgers(spark, folder).ab, errors_only=True))


@query
def search_account(spark, folder):
    rows = mt.ab_rows(ledgers(spark, folder).ab, errors_only=True)
    return tb.search_column(rows, "acc_no", "99")


@query
def unmatched_b(spark, folder):
    return ledgers(spark, folder).unmatched("b", "a").select("acc_b", "acc_key", "date_b", "bal_b")


@query
def unmatched_a(spark, folder):
    return ledgers(spark, folder).unmatched("a", "b").select("acc_a", "acc_key", "day_a", "bal_a")


# ---- schedule and three ways ----------------------------------------------


@query
def reconcile_sb(spark, folder):
    return mt.sb_rows(ledgers(spark, folder).sb)


@query
def classify_sb(spark, folder):
    return sm.class_counts(*ledgers(spark, folder).sb_counted)


@query
def summary_sb(spark, folder):
    return ledgers(spark, folder).sb_summary


@query
def balance_error_stats_sb(spark, folder):
    return sm.balance_error_stats(ledgers(spark, folder).sb)


@query
def error_histogram_sb(spark, folder):
    return sm.error_histogram(ledgers(spark, folder).sb)


@query
def unmatched_s(spark, folder):
    return ledgers(spark, folder).unmatched("s", "b").select("acc_s", "acc_key", "day_s", "bal_s")


@query
def reconcile_three_way(spark, folder):
    return mt.three_rows(ledgers(spark, folder).three)


@query
def three_way_summary(spark, folder):
    return ledgers(spark, folder).three_summary


@query
def three_way_listing(spark, folder):
    """Perfect rows first, then discrepancies, in one list sorted by ranges."""
    rows = mt.three_rows(ledgers(spark, folder).three)
    return rows.orderBy(F.col("kind").desc(), *mt.THREE_COLUMNS)


@query
def presence_buckets(spark, folder):
    return ledgers(spark, folder).presence()


@query
def dashboard_totals(spark, folder):
    r = ledgers(spark, folder)
    return sm.dashboard_totals(r.ab_summary, r.sb_summary)


@query
def summary_matrix(spark, folder):
    return _settled(ledgers(spark, folder, keep=True), lambda r: r.matrix())


# ---- messy text -----------------------------------------------------------


@query
def parse_numbers(spark, folder):
    """Order totals written in many ways, read back."""
    o = dv.table(spark, folder, "orders").select("o_orderkey", _money("o_totalprice").alias("v"))
    plain, k = F.col("v").cast("string"), F.col("o_orderkey") % 8
    text = (
        F.when(k == 0, F.format_number("v", 2))
        .when(k == 1, F.concat(F.lit(" \t"), plain, F.lit(" ")))
        .when(k == 2, F.concat(F.lit("-"), plain))
        .when(k == 3, F.concat(plain, F.lit("d")))
        .when(k == 4, F.lit("N/A"))
        .when(k == 5, F.lit("-"))
        .when(k == 6, F.lit("nan"))
        .otherwise(plain)
    )
    return o.select("o_orderkey", text.alias("text")).select(
        "o_orderkey",
        ps.number("text").alias("amount"),
        ps.whole_number("text").alias("whole"),
        ps.is_unreadable_number("text").alias("unreadable"),
    )


@query
def parse_dates(spark, folder):
    """Order dates in the layouts of each ledger, sound and broken, read back."""
    o = dv.table(spark, folder, "orders").select("o_orderkey", _day("o_orderdate").alias("d"))
    k = F.col("o_orderkey") % 6
    iso = F.col("d").cast("string")
    ledger = (
        F.when(k == 0, F.concat(iso, F.lit(" 00:00:00")))
        .when(k == 1, F.date_format("d", "yyyy-M-d"))
        .when(k == 2, F.date_format("d", "dd/MM/yyyy"))
        .when(k == 3, F.concat(F.date_format("d", "yyyy/MM/dd"), F.lit(" 13:45:00")))
        .when(k == 4, F.date_format("d", "yyyy-'13'-dd"))
        .otherwise(F.lit("-"))
    )
    schedule = F.when(k < 3, F.date_format("d", "MM/dd/yyyy")).otherwise(iso)
    counterpart = F.when(k == 5, F.lit("30/02/2567")).otherwise(ps.buddhist_text("d", "d/M"))
    texts = o.select("o_orderkey", ledger.alias("l"), schedule.alias("s"), counterpart.alias("b"))
    return texts.select(
        "o_orderkey",
        ps.ledger_date("l").alias("ledger_date"),
        ps.schedule_date("s").alias("schedule_date"),
        ps.buddhist_date("b").alias("counterpart_date"),
        ps.iso_text(ps.ledger_date("l")).alias("iso_text"),
    )


@query
def buddhist_year(spark, folder):
    o = dv.table(spark, folder, "orders").withColumn("year_be", ps.buddhist_year(_day("o_orderdate")))
    return o.select("o_orderkey", "year_be", ps.gregorian_year("year_be").alias("year"))


# ---- loans ----------------------------------------------------------------


def _loans(spark, folder) -> DataFrame:
    loan = _money("o_totalprice")

    def share(part: float) -> Column:
        return (loan * F.lit(str(part)).cast("decimal(6,3)")).cast("decimal(18,2)")

    # A loan becomes a row per year, folded in an interpreted expression.
    return spread(dv.table(spark, folder, "orders")).select(
        "o_orderkey",
        loan.alias("loan"),
        share(PAYMENT_SHARE).alias("payment"),
        F.array(*[share(d) for d in DUE_SHARES]).alias("due"),
    )


@query
def waterfall_old(spark, folder):
    return wf.waterfall(_loans(spark, folder), "old", ["o_orderkey"])


@query
def waterfall_interim(spark, folder):
    return wf.waterfall(_loans(spark, folder), "interim", ["o_orderkey"])


@query
def waterfall_new(spark, folder):
    return wf.waterfall(_loans(spark, folder), "new", ["o_orderkey"])


@query
def schedule_head_tail(spark, folder):
    years = wf.head_and_tail(wf.waterfall(_loans(spark, folder), "old", ["o_orderkey"]))
    return years.select("o_orderkey", "year", "p_start", "p_end", "last_payment")


@query
def instalment_band(spark, folder):
    amount = _money("o_totalprice")
    return dv.table(spark, folder, "orders").select("o_orderkey", bd.instalment_payment(amount).alias("pay"))


@query
def band_lookup(spark, folder):
    loans = dv.table(spark, folder, "orders").select("o_orderkey", _money("o_totalprice").alias("amount"))
    bands = bd.instalment_bands(spark)
    return bd.band_join(loans, "amount", bands, "upper", ["pay"], cell=5_000, top=bd.TOP_AMOUNT, count=bd.INSTALMENT_BANDS)


@query
def instalment_plan(spark, folder):
    amount = _money("o_totalprice")
    years = F.lit(20) + F.col("o_custkey") % 30
    loans = dv.table(spark, folder, "orders").select(
        "o_orderkey",
        amount.alias("amount"),
        F.least(amount, F.lit(45_000)).alias("remaining"),
        (F.col("o_orderkey") % 2000).alias("interest"),
        F.add_months(_day("o_orderdate"), (years * -12).cast("int")).alias("birth_date"),
        F.lit(CONTRACT_DATE).cast("date").alias("as_of"),
    )
    return ins.instalment_plan(loans, ["o_orderkey"])


# ---- groups and shares ----------------------------------------------------


@query
def group_rollup(spark, folder):
    customer, nation, region = (dv.table(spark, folder, t) for t in ("customer", "nation", "region"))
    # Customers are counted per nation and segment before they meet the dimensions.
    counted = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(nation, counted.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    rows = joined.select(F.col("r_name").alias("section"), F.col("c_mktsegment").alias("grp"), "n")
    return tb.rollup_totals(rows, ["section", "grp"], {"accounts": F.sum("n")})


@query
def payment_count_bands(spark, folder):
    customer = dv.table(spark, folder, "customer")
    paid = dv.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("payments")
    )
    band = lb.payment_count_band(F.coalesce("payments", F.lit(0)))
    joined = customer.select("c_custkey").join(paid, "c_custkey", "left")
    return joined.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("accounts"))


@query
def budget_variance(spark, folder):
    price = _money("l_extendedprice")
    discounted = (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    lines = dv.table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("fiscal_year"), price.alias("was"), discounted.alias("now")
    )
    return tb.variance(lines, "fiscal_year", F.col("was"), F.col("now"))


@query
def segment_share(spark, folder):
    return tb.share_of_total(dv.table(spark, folder, "customer"), "c_mktsegment", _money("c_acctbal"))


@query
def deficit_by_resource(spark, folder):
    needs = F.create_map(
        F.lit("qty"), F.col("l_quantity").cast("bigint"), F.lit("line"), F.col("l_linenumber").cast("bigint")
    )
    return tb.sum_map_values(dv.table(spark, folder, "lineitem"), needs, "resource", "total")


@query
def deficit_by_property(spark, folder):
    needs = F.from_json("props", "map<string,bigint>")
    return tb.sum_map_values(dv.table(spark, folder, "events"), needs, "resource", "total")


@query
def filter_missions(spark, folder):
    """Events whose property map asks for something; every third asks for nothing."""
    asked = F.when(F.col("event_id") % 3 > 0, F.col("props")).otherwise(F.lit("{}"))
    events = dv.table(spark, folder, "events").withColumn("needs", F.from_json(asked, "map<string,bigint>"))
    return tb.filter_deficit(events, "needs", "deficit").select("event_id", F.size("needs").alias("needs"))


@query
def reward_by_keyword_class(spark, folder):
    classes = {"Ring": ["ring"], "Widget": ["widget", "gizmo"], "Gear": ["gear"]}
    return tb.sum_by_keyword(dv.table(spark, folder, "part"), "p_name", "p_size", classes, "Misc")


# ---- lookups and search ---------------------------------------------------


@query
def lookup_with_default(spark, folder):
    places = [("click", "Pointer"), ("view", "Screen"), ("purchase", "Till")]
    table = literal_rows(spark, ["event_type", "place"], places)
    events = dv.table(spark, folder, "events").select("event_id", "event_type")
    return lk.lookup_with_default(events, table, "event_type", "place", "Unknown Planet")


@query
def lookup_terms(spark, folder):
    """Pieces of part names, one per order, some of which are in no name."""
    orders = dv.table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 97).alias("c"))
    parts = dv.table(spark, folder, "part").select("p_partkey", "p_name")
    piece = F.substring(F.upper("p_name"), (1 + F.col("k") % 5).cast("int"), (F.col("k") % 9).cast("int"))
    term = F.when(F.col("c") == 0, F.concat(piece, F.lit("?"))).when(F.col("c") == 1, F.col("p_name")).otherwise(piece)
    terms = orders.join(parts, F.col("p_partkey") == F.col("k") % 200 + 1).select(term.alias("term"))
    return lk.lookup_terms(parts, terms, "term", "p_name", "p_partkey")


@query
def lookup_fuzzy(spark, folder):
    parts = dv.table(spark, folder, "part").select("p_partkey", "p_name")
    return lk.lookup_two_tier(parts, ["RED BOLT", "Widget", "gea", "new an", "zzz"], "p_name", "p_partkey")


@query
def search_any_column(spark, folder):
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    return tb.search_any(dv.table(spark, folder, "part").select(*columns), columns, "ING Brand#2")


@query
def filter_by_type(spark, folder):
    events = dv.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return tb.filter_category(events, "event_type", "error")


@query
def sorted_catalog(spark, folder):
    parts = dv.table(spark, folder, "part").orderBy("p_partkey")
    return parts.select("p_partkey", lb.padded_id(F.col("p_partkey")).alias("label"), "p_name")


@query
def display_labels(spark, folder):
    parts = dv.table(spark, folder, "part")
    return parts.select(
        "p_partkey",
        lb.shorten(F.col("p_name"), 6).alias("short_name"),
        lb.money_text(_money("p_retailprice")).alias("price"),
    )


@query
def display_dates(spark, folder):
    day = _day("o_orderdate")
    return dv.table(spark, folder, "orders").select(
        "o_orderkey",
        lb.relayout_date(day).alias("day_first"),
        lb.relayout_date(day, "MM/dd").alias("month_day"),
    )


@query
def focus_vs_rest(spark, folder):
    size = F.when(F.col("p_brand") == "Brand#7", F.col("p_size") / 40).otherwise(F.col("p_size") / 50)
    return dv.table(spark, folder, "part").select("p_partkey", F.round(size, 4).alias("size"))


@query
def threshold_labels(spark, folder):
    high = lb.threshold_label(F.col("p_size"), [(40, "high"), (20, "medium")], "low")
    top = lb.threshold_label(F.col("p_retailprice"), [(1000.0, "top")], "regular", inclusive=True)
    group = lb.mapped_label(F.col("p_type"), {"PROMO": "offer", "ECONOMY": "basic"}, "standard")
    return dv.table(spark, folder, "part").select(
        "p_partkey", high.alias("size_label"), top.alias("price_label"), group.alias("type_label")
    )


@query
def capacity_gap(spark, folder):
    value, need = F.col("s_acctbal"), F.lit(5000.0)
    return dv.table(spark, folder, "supplier").select(
        "s_suppkey",
        lb.percent_of(value, need).alias("percent"),
        F.round(lb.shortfall(value, need), 2).alias("shortfall"),
    )


# ---- intervals, series, trees ---------------------------------------------


def _part_intervals(spark, folder) -> DataFrame:
    """Per part its first and last year of shipping, with its category."""
    year = F.year("l_shipdate")
    spans = dv.table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.min(year).alias("start"), F.max(year).alias("end")
    )
    return spans.join(dv.table(spark, folder, "part").select("p_partkey", "p_type"), "p_partkey")


@query
def roadmap_by_category(spark, folder):
    spans = tb.with_span(_part_intervals(spark, folder), "start", "end")
    return spans.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("parts"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.sum("span").alias("years"),
    )


@query
def roadmap_years(spark, folder):
    return tb.explode_years(_part_intervals(spark, folder), "start", "end").select("p_partkey", "p_type", "year")


@query
def roadmap_year_matrix(spark, folder):
    return tb.year_matrix(_part_intervals(spark, folder), "p_type", "start", "end", "parts")


def _yearly(spark, folder) -> DataFrame:
    return dv.table(spark, folder, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.sum(_money("o_totalprice")).alias("revenue"), F.count(F.lit(1)).alias("orders")
    )


@query
def kpi_long(spark, folder):
    return tb.to_long(_yearly(spark, folder), ["year"], ["revenue", "orders"])


@query
def kpi_zipped(spark, folder):
    """The yearly numbers as index-aligned arrays, zipped to rows again."""
    row = F.struct("year", "revenue", F.col("orders").cast("decimal(38,2)").alias("orders"))
    # One entry per calendar year: the array is as long as the data has years.
    packed = _yearly(spark, folder).agg(F.sort_array(F.collect_list(row)).alias("r"))
    arrays = packed.select(
        F.col("r.year").alias("year"), F.col("r.revenue").alias("revenue"), F.col("r.orders").alias("orders")
    )
    return tb.zip_series(arrays, "year", ["revenue", "orders"]).withColumn("value", F.col("value").cast("double"))


@query
def kpi_last_value(spark, folder):
    return tb.last_value(tb.to_long(_yearly(spark, folder), ["year"], ["revenue", "orders"]), "year")


@query
def year_ordinal(spark, folder):
    years = dv.table(spark, folder, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return tb.year_ordinal(years, "year", ["o_custkey"])


def _phases(spark, folder) -> DataFrame:
    events = dv.table(spark, folder, "events").select("ts", "event_id", "event_type")
    return tb.phase_by_position(events, ["ts", "event_id"])


@query
def phase_by_position(spark, folder):
    return _phases(spark, folder).select("event_id", "event_type", "phase")


@query
def nest_children(spark, folder):
    return tb.nest_links(_phases(spark, folder), "phase", "event_id", "timeline")


@query
def nested_phases(spark, folder):
    """The phases as nested documents of a hundred events, the events' ids read back from each."""
    parts = tb.nested_parts(_phases(spark, folder), "phase", ["ts", "event_id"])
    ids = F.array_join(F.transform("children", lambda c: c["event_id"].cast("string")), ",")
    return parts.select("phase", "part", F.size("children").alias("events"), ids.alias("event_ids"))


@query
def edge_endpoints(spark, folder):
    nation, region = dv.table(spark, folder, "nation"), dv.table(spark, folder, "region")
    place = F.concat(F.lit("N"), F.col("n_nationkey"))
    area = F.concat(F.lit("R"), F.col("r_regionkey"))
    nodes = nation.select(place.alias("id"), F.col("n_name").alias("name"), F.lit(1).alias("grp")).unionByName(
        region.select(area.alias("id"), F.col("r_name").alias("name"), F.lit(2).alias("grp"))
    )
    edges = nation.select(place.alias("source"), F.concat(F.lit("R"), F.col("n_regionkey")).alias("target"))
    return lk.edge_endpoints(edges, nodes, "id", ["name", "grp"])


@query
def capability_systems(spark, folder):
    """Each nation's segments as a comma list, then one row per entry."""
    pairs = dv.table(spark, folder, "customer").select("c_nationkey", "c_mktsegment").distinct()
    # A nation's list is as long as there are segments.
    lists = pairs.groupBy("c_nationkey").agg(
        F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ", ").alias("segments")
    )
    return tb.split_list(lists, "segments", "segment")


# ---- extracts and outputs --------------------------------------------------


def _extract(spark, rows: DataFrame, layout: dl.Layout, name: str) -> str:
    """The ledger as delimited files in the shared folder, under its file headers."""
    path = work_folder(spark, name)
    heads = {alias: head for head, alias in layout.columns.items()}
    out.write_csv(rows.select(*[F.col(a).alias(h) for a, h in heads.items()]), path)
    return path


@query
def scan_system(spark, folder):
    ledger = ledgers(spark, folder).system
    return dl.load_system(spark, _extract(spark, ledger, dl.SYSTEM, "system"))


@query
def scan_counterpart(spark, folder):
    ledger = ledgers(spark, folder).counterpart
    return dl.load_counterpart(spark, _extract(spark, ledger, dl.COUNTERPART, "counterpart")).drop("source_file")


@query
def scan_schedule(spark, folder):
    ledger = ledgers(spark, folder).schedule
    return dl.load_schedule(spark, _extract(spark, ledger, dl.SCHEDULE, "schedule"))


@query
def row_estimate(spark, folder):
    """Data rows of the system extract, from the lines of all its bytes."""
    path = _extract(spark, ledgers(spark, folder).system, dl.SYSTEM, "system")
    totals = fl.folder_totals(fl.line_counts(spark, path))
    return totals.select((F.col("lines") - F.col("files")).alias("data_rows"))


def _files(spark, lines: DataFrame, heads: list[str], name: str, files: int = 3) -> str:
    """Text files that begin with the lines of ``heads``; ``lines`` has (k, value)."""
    path = work_folder(spark, name)
    first = literal_rows(spark, ["place", "value"], list(enumerate(heads)))
    first = first.withColumn("file", F.explode(F.sequence(F.lit(0), F.lit(files - 1))))
    rest = lines.select(F.lit(len(heads)).alias("place"), "value", F.pmod("k", F.lit(files)).cast("int").alias("file"))
    both = first.unionByName(rest).repartitionById(files, F.col("file")).sortWithinPartitions("place")
    both.select("value").write.text(path)
    return path


@query
def row_estimate_sampled(spark, folder):
    """Is the exact line count within the estimate's error, from at most the promised bytes?"""
    path = _extract(spark, ledgers(spark, folder).system, dl.SYSTEM, "system")
    ranges, width = 8, 1024
    sampled = fl.sampled_totals(fl.row_samples(spark, path, ranges, width))
    exact = fl.folder_totals(fl.line_counts(spark, path)).select("lines")
    both = sampled.select("*", exact.scalar().alias("lines"))
    return both.select(
        (F.col("lines") - F.col("files")).alias("data_rows"),
        (F.abs(F.col("rows") - F.col("lines")) <= F.col("error")).alias("within_error"),
        (F.col("bytes_read") <= F.col("files") * (ranges * width + 1)).alias("few_bytes_read"),
    )


def _numbered_schedule(spark, folder) -> DataFrame:
    return ledgers(spark, folder).schedule.withColumn("k", F.regexp_extract("acc_no", r"(\d+)$", 1).cast("bigint"))


def _schedule_lines(spark, folder, more: Column | None = None) -> DataFrame:
    """(k, value): the schedule's rows as lines, ``more`` behind them."""
    cells = [F.col(c) for c in dl.SCHEDULE.columns.values()]
    line = F.concat_ws(",", *cells)
    return _numbered_schedule(spark, folder).select("k", (F.concat(line, more) if more is not None else line).alias("value"))


@query
def scan_late_header(spark, folder):
    """The schedule below two title rows, one of which looks like data."""
    heads = ["monthly report", "", "7,2024-01-01,5", ",".join(dl.SCHEDULE.columns)]
    return dl.load_schedule(spark, _files(spark, _schedule_lines(spark, folder), heads, "late"))


@query
def rejected_rows(spark, folder):
    """Rows with a field too many: every tenth of the schedule."""
    more = F.when(F.col("k") % 10 == 0, F.lit(",beyond")).otherwise(F.lit(""))
    path = _files(spark, _schedule_lines(spark, folder, more), [",".join(dl.SCHEDULE.columns)], "rejected")
    return dl.rejected_lines(spark, path, dl.SCHEDULE).drop("source_file")


def _faulty_schedule(spark, folder, name: str) -> str:
    """The schedule with a line of each fault among ten, in three files."""
    cells = [F.col(c) for c in dl.SCHEDULE.columns.values()]
    line, place = F.concat_ws(",", *cells), F.col("k") % 10
    faulty = (
        F.when(place == 0, F.concat(line, F.lit(",beyond")))
        .when(place == 1, F.concat_ws(",", *cells[:-1]))
        .when(place == 2, F.concat(cells[0], F.lit(',"'), F.concat_ws(",", *cells[1:])))
        .when(place == 3, F.concat(line.cast("binary"), F.lit(b"\xff")).cast("string"))
        .otherwise(line)
    )
    lines = _numbered_schedule(spark, folder).select("k", faulty.alias("value"))
    # The mark says what the bytes are meant to be; without it the odd byte is a letter of a code page.
    return _files(spark, lines, [out.BYTE_ORDER_MARK + ",".join(dl.SCHEDULE.columns)], name)


@query
def scan_strict(spark, folder):
    """The lines without fault of a schedule in which four lines of ten have one."""
    return rj.read_strict(spark, _faulty_schedule(spark, folder, "strict"), dl.SCHEDULE).drop("source_file")


@query
def rejects_by_reason(spark, folder):
    """Kept and rejected lines of the same files; they add up to the lines."""
    counted = rj.rejects_by_reason(spark, _faulty_schedule(spark, folder, "reasons"), dl.SCHEDULE)
    return counted.groupBy("reason").agg(F.sum("rows").alias("rows"))


@query
def scan_quoted_text(spark, folder):
    """The system ledger with a line break inside its dates."""
    broken = F.replace("first_payment_date", F.lit(" "), F.lit("\n"))
    ledger = ledgers(spark, folder).system.withColumn("first_payment_date", broken)
    return dl.load_system(spark, _extract(spark, ledger, dl.SYSTEM, "quoted"))


def _counterpart_extract(spark, folder, name: str, suffix: str = "", charset: str = "UTF-8") -> str:
    path = work_folder(spark, name)
    ledger = ledgers(spark, folder).counterpart
    heads = {alias: head + suffix for head, alias in dl.COUNTERPART.columns.items()}
    if charset != "UTF-8":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    out.write_csv(ledger.select(*[F.col(a).alias(h) for a, h in heads.items()]), path, False, charset)
    return path


@query
def scan_mapped_columns(spark, folder):
    """The counterpart's extract with longer column names, found by their beginning."""
    return dl.load_counterpart(spark, _counterpart_extract(spark, folder, "mapped", " (ใหม่)")).drop("source_file")


@query
def scan_code_pages(spark, folder):
    """The counterpart's extract in a Thai code page."""
    path = _counterpart_extract(spark, folder, "pages", charset="x-windows-874")
    return dl.load_counterpart(spark, path).drop("source_file")


@query
def file_inventory(spark, folder):
    """Files and bytes of the system extract, and the bytes its digests have read."""
    path = _extract(spark, ledgers(spark, folder).system, dl.SYSTEM, "system")
    listed = fl.inventory(spark, path).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    digested = fl.digests(spark, path).agg(
        F.count_if(F.length("sha256_16") == 16).alias("digests"), F.sum("bytes").alias("digested")
    )
    both = listed.select("*", digested.select("digests").scalar().alias("digests"), digested.select("digested").scalar().alias("digested"))
    return both.select((F.col("files") == F.col("digests")).alias("all_digested"), (F.col("bytes") == F.col("digested")).alias("same_bytes"))


def _list_content(spark, written: dict[str, str]) -> DataFrame:
    amounts = {"debt_separation": "balance_b", "conflicts": "loan_balance"}
    parts = []
    for name, place in written.items():
        rows = spark.read.option("header", True).csv(place)
        account = F.col(rows.columns[0]) if "acc_no" not in rows.columns else F.col("acc_no")
        parts.append(
            rows.agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_distinct(account).alias("accounts"),
                F.min(account).alias("first_account"),
                F.max(account).alias("last_account"),
                F.coalesce(F.sum(F.col(amounts.get(name, "bal_b")).cast("double").cast("decimal(18,2)")), F.lit(0)).cast("double").alias("amount"),
            ).select(F.lit(name).alias("list"), "*")
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


@query
def written_lists(spark, folder):
    """Each result list after writing the lists and reading them back: rows and content."""
    path = work_folder(spark, "lists")
    r = ledgers(spark, folder, keep=True)
    try:
        written = out.write_lists(r, path)
    finally:
        r.release()
    return _list_content(spark, written)


@query
def published_lists(spark, folder):
    """The lists of the current version, read through its mark, after a run that failed half-way."""
    path = work_folder(spark, "versions")
    r = ledgers(spark, folder, keep=True)
    try:
        out.write_lists(r, path, versioned=True)
        broken = vs.Versions(spark, path).begin()
        out.write_csv(r.typed, broken.path("errors_ab"))  # never published
    finally:
        r.release()
    return _list_content(spark, vs.Versions(spark, path).outputs())


def _report(spark, folder, schema: str) -> DataFrame:
    payload = _settled(ledgers(spark, folder, keep=True), out.report_payload)
    return out.read_payload(payload, schema)


@query
def report_lists(spark, folder):
    """Size of each list as the report document names it, decoded again from its JSON."""
    names = ["errors_ab", "errors_sb", "debt_separation", "conflicts", "three_way_perfect", "three_way_discrepancies"]
    report = _report(spark, folder, f"list_rows struct<{', '.join(f'{n}: bigint' for n in names)}>")
    sizes = F.array(*[F.struct(F.lit(n).alias("list"), F.col(f"list_rows.{n}").alias("rows")) for n in names])
    return report.select(F.inline(sizes))


@query
def report_values(spark, folder):
    """Statistics, chart series and totals of the report document, decoded from its JSON."""
    share = "array<struct<mismatch: string, rows: bigint>>"
    bins = "array<struct<bin: int, rows: bigint>>"
    report = _report(
        spark,
        folder,
        "stats struct<ab: struct<matched_rows: bigint, unmatched_b: bigint, bad_balances: bigint>, "
        "sb: struct<matched_rows: bigint, unmatched_b: bigint, bad_balances: bigint>, three_way: struct<perfect: bigint>, "
        "totals: struct<total_rows: bigint, error_rows: bigint>>, "
        f"charts struct<classes_ab: {share}, classes_sb: {share}, classes_three_way: {share}, "
        f"histogram_ab: {bins}, histogram_sb: {bins}, balance_errors_sb: struct<n: bigint, mean: double, p99: double>>",
    )
    single = [
        "stats.ab.matched_rows", "stats.ab.unmatched_b", "stats.ab.bad_balances", "stats.sb.matched_rows",
        "stats.sb.unmatched_b", "stats.sb.bad_balances", "stats.three_way.perfect", "stats.totals.total_rows",
        "stats.totals.error_rows", "charts.balance_errors_sb.n", "charts.balance_errors_sb.mean", "charts.balance_errors_sb.p99",
    ]
    values = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in single]
    for name in ("ab", "sb", "three_way"):
        of = f"charts.classes_{name}"
        for k in ("perfect", "date_only", "balance_only", "both"):
            rows = F.element_at(F.map_from_arrays(f"{of}.mismatch", f"{of}.rows"), k)
            values.append(F.struct(F.lit(f"{of}.{k}").alias("name"), rows.cast("double").alias("value")))
    for name in ("ab", "sb"):
        total = F.aggregate(f"charts.histogram_{name}.rows", F.lit(0).cast("bigint"), lambda a, b: a + b)
        values.append(F.struct(F.lit(f"histogram_{name}").alias("name"), total.cast("double").alias("value")))
    return report.select(F.inline(F.array(*values)))


# ---- accounts that hold a large part of the rows ---------------------------


@query
def summary_ab_hot(spark, folder):
    """Every third order under one account, counted by group instead of by pair."""
    return _plain_counts(ledgers(spark, folder, hot=3, guard=SkewGuard(min_rows=50)).ab_summary)


@query
def three_way_hot(spark, folder):
    """Every hundredth order under one account in all three ledgers."""
    return _plain_counts(ledgers(spark, folder, hot=100, guard=SkewGuard(min_rows=10)).three_summary)


def _plain_counts(summary: DataFrame) -> DataFrame:
    """Counters as bigint; they are wider where groups are counted by products."""
    return summary.select(
        *[F.col(n).cast("bigint").alias(n) if kind.startswith("decimal") else F.col(n) for n, kind in summary.dtypes]
    )
