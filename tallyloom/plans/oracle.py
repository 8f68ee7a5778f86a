"""The same results as SQL over the same tables, written for DuckDB."""

from __future__ import annotations

LEDGERS = """
A as (
  select lpad(cast(o_orderkey as varchar), 10, '0') acc_no,
         case when o_orderkey % 7 = 0 then '0' else '1' end group_flag,
         strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' first_payment_date,
         cast(cast(o_totalprice as decimal(18,2)) as varchar) pre_balance,
         cast(cast(cast(o_totalprice as decimal(18,2))
              + case when o_orderkey % 11 = 0 then 100 else 0 end as decimal(18,2)) as varchar) exact_pre_balance
  from orders),
B0 as (
  select o_orderkey k,
         case when o_orderkey % 97 = 0 then null when o_orderkey % 101 = 0 then '000'
              else case when o_orderkey % 13 = 0 then 'B' else '' end || cast(o_orderkey as varchar) end acc_no,
         cast(o_orderdate as date) + case when o_orderkey % 5 = 0 then 30 else 0 end dt,
         cast(cast(o_totalprice as decimal(18,2))
              + case when o_orderkey % 3 = 0 then 250.75 else 0.00 end as decimal(18,2)) bal
  from orders),
B1 as (
  select k, acc_no, dt, bal, 'part1.csv' source_file from B0
  union all select k, acc_no, dt, bal, 'part2.csv' from B0 where k % 19 = 0
  union all select k, acc_no, dt, cast(bal + 1 as decimal(18,2)), 'part2.csv' from B0 where k % 23 = 0),
BT as (
  select acc_no, case when k % 89 = 0 then '30/02/2567'
                      else strftime(dt, '%d/%m') || '/' || cast(year(dt) + 543 as varchar) end start_date_be,
         case when k % 83 = 0 then 'N/A' else cast(bal as varchar) end balance_text, source_file from B1),
B as (
  select acc_no, start_date_be, try_cast(balance_text as double) loan_balance, source_file from BT),
D as (select distinct acc_no, start_date_be, loan_balance from B),
S as (
  select ' 00' || case when o_orderkey % 4 = 0 then 'S' else '' end || cast(o_orderkey as varchar) acc_no,
         case o_orderkey % 4 when 1 then strftime(d, '%Y-%m-%d') when 2 then strftime(d, '%d/%m/%Y')
              else strftime(d, '%Y/%m/%d') end due_payment_date,
         cast(cast(cast(o_totalprice as decimal(18,2))
              + case when o_orderkey % 9 = 0 then 500 else 0 end as decimal(18,2)) as varchar) capital_remain
  from (select *, cast(o_orderdate as date) + case when o_orderkey % 6 = 0 then 15 else 0 end d from orders)),
CA as (
  select ltrim(trim(acc_no), '0') acc_key, acc_no acc_a,
         cast(try_strptime(split_part(first_payment_date, ' ', 1), '%Y-%m-%d') as date) day_a,
         cast(pre_balance as double) bal_a, cast(exact_pre_balance as double) exact_bal
  from A where group_flag = '1'),
CB as (
  select ltrim(trim(acc_no), '0') acc_key, acc_no acc_b, start_date_be date_b,
         try_cast(concat(cast(split_part(start_date_be, '/', 3) as int) - 543, '-',
                  split_part(start_date_be, '/', 2), '-', split_part(start_date_be, '/', 1)) as date) day_b,
         coalesce(loan_balance, 0) bal_b, loan_balance is null bad_b
  from D),
CS as (
  select ltrim(trim(acc_no), '0') acc_key, acc_no acc_s,
         cast(coalesce(try_strptime(due_payment_date, '%Y-%m-%d'), try_strptime(due_payment_date, '%d/%m/%Y'),
              try_strptime(due_payment_date, '%Y/%m/%d')) as date) day_s,
         cast(capital_remain as double) bal_s
  from S)
"""

_PAIR = """
  coalesce(day_x = day_b, false) date_match,
  case when day_x is not null and day_b is not null then abs(day_b - day_x) else 0 end date_diff_days,
  bal_b - bal_x bal_diff, abs(bal_b - bal_x) <= 0.01::double bal_match,
  round(case when bal_x <> 0 then abs(bal_b - bal_x) / abs(bal_x) * 100
        when bal_b <> 0 then 100 else 0 end, 4) bal_diff_pct
"""

_CLASS = """case when date_match and bal_match then 'perfect' when bal_match then 'date_only'
  when date_match then 'balance_only' else 'both' end mismatch"""

COMPARED = (
    LEDGERS
    + ", AB0 as (select *, day_a day_x, bal_a bal_x from CB join CA using (acc_key)), AB1 as (select *,"
    + _PAIR
    + """, bal_b - exact_bal exact_vs_b_diff, bal_a - exact_bal exact_vs_pre_diff,
       bal_a < exact_bal is_debt_separation from AB0), AB as (select *, """
    + _CLASS
    + " from AB1)"
    + ", SB0 as (select *, day_s day_x, bal_s bal_x from CB join CS using (acc_key)), SB1 as (select *,"
    + _PAIR
    + " from SB0), SB as (select *, "
    + _CLASS
    + " from SB1)"
    + """, T0 as (select *,
       coalesce(day_a = day_b and day_b = day_s, false) date_match,
       abs(bal_a - exact_bal) <= 0.01::double and abs(exact_bal - bal_b) <= 0.01::double
         and abs(bal_b - bal_s) <= 0.01::double bal_match
     from CA join CB using (acc_key) join CS using (acc_key)), T as (select *, """
    + _CLASS
    + " from T0)"
)

_AB_ROW = """acc_b acc_no, coalesce(cast(day_a as varchar), '') date_a, date_b, date_match, date_diff_days,
  bal_a, bal_b, bal_match, bal_diff, bal_diff_pct, exact_bal, exact_vs_b_diff, exact_vs_pre_diff,
  is_debt_separation, mismatch"""
_SB_ROW = """acc_b acc_no, coalesce(cast(day_s as varchar), '') date_s, date_b, date_match, date_diff_days,
  bal_s, bal_b, bal_match, bal_diff, bal_diff_pct, mismatch"""
_T_ROW = """case when mismatch = 'perfect' then 'perfect' else 'discrepancy' end kind, acc_a acc_no,
  coalesce(cast(day_a as varchar), '') date_a, date_b, coalesce(cast(day_s as varchar), '') date_s,
  bal_a bal_a_pre, exact_bal bal_a_exact, bal_b, bal_s, date_match all_dates_match,
  bal_match all_balances_match"""

_COUNTS = """count(*) matched_rows, count(*) filter (where mismatch = 'perfect') perfect,
  count(*) filter (where mismatch = 'date_only') date_only,
  count(*) filter (where mismatch = 'balance_only') balance_only,
  count(*) filter (where mismatch = 'both') "both" """

_RATES = """
  coalesce(round(matched_rows * 100.0::double / nullif(rows_b, 0), 2), 0) match_rate_pct,
  coalesce(round((date_only + balance_only + "both") * 100.0::double / nullif(matched_rows, 0), 2), 0) error_rate_pct,
  coalesce(round(perfect * 100.0::double / nullif(matched_rows, 0), 2), 0) accuracy_rate_pct"""

_AB_SUMMARY = f"""
  select *, {_RATES} from (
  select (select count(*) from A) rows_a, (select count(*) from A where group_flag = '1') active_rows_a,
    (select count(*) from D) rows_b, (select count(*) from D where acc_no is null) rows_b_no_key,
    (select count(*) from CB where acc_key = '') rows_b_empty_key,
    (select count(*) from CB where not exists (select 1 from CA where CA.acc_key = CB.acc_key)) unmatched_b, {_COUNTS},
    count(*) filter (where abs(exact_vs_b_diff) > 0.01::double) exact_vs_b_mismatches,
    count(*) filter (where abs(exact_vs_pre_diff) > 0.01::double) exact_vs_pre_mismatches,
    count(*) filter (where is_debt_separation) debt_separation_cases, count(*) filter (where bad_b) bad_balances
  from AB)"""

_SB_SUMMARY = f"""
  select *, {_RATES} from (
  select (select count(*) from S) rows_s,
    (select count(*) from D) rows_b, (select count(*) from D where acc_no is null) rows_b_no_key,
    (select count(*) from CB where acc_key = '') rows_b_empty_key,
    (select count(*) from CB where not exists (select 1 from CS where CS.acc_key = CB.acc_key)) unmatched_b, {_COUNTS},
    count(*) filter (where bad_b) bad_balances
  from SB)"""

_T_SUMMARY = f"""
  select *, round(matched_rows * 100.0::double / greatest(active_rows_a, rows_b, rows_s), 2) match_rate_pct,
    round(perfect * 100.0::double / nullif(matched_rows, 0), 2) perfect_match_rate_pct from (
  select (select count(*) from CA) active_rows_a, (select count(*) from CB) rows_b,
    (select count(*) from CS) rows_s, {_COUNTS} from T)"""


def _with(body: str) -> str:
    return f"with {COMPARED} {body}"


def _stats_body(table: str) -> str:
    return (
        f"""select count(*) n, round(avg(bal_diff), 4) mean, round(quantile_cont(bal_diff, 0.5), 4) median,
        round(stddev_pop(bal_diff), 4) std, round(min(bal_diff), 4) "min", round(max(bal_diff), 4) "max",
        round(quantile_cont(bal_diff, 0.95), 4) p95, round(quantile_cont(bal_diff, 0.99), 4) p99
        from {table} where mismatch <> 'perfect'"""
    )


def _stats(table: str) -> str:
    return _with(_stats_body(table))


def _histogram_body(table: str) -> str:
    return (
        f"""with E as (select bal_diff v from {table} where mismatch <> 'perfect'),
        K as (select v from E where abs(v) < (select quantile_cont(abs(v), 0.99) from E)),
        R as (select case when min(v) = max(v) then min(v) - 0.5 else min(v) end lo,
                     case when min(v) = max(v) then max(v) + 0.5 else max(v) end hi from K),
        N as (select cast(least(floor((v - lo) * 50 / (hi - lo)), 49) + 1 as int) bin, count(*) n
              from K, R group by 1)
        select cast(g.bin as int) bin, round(lo + (hi - lo) / 50 * (g.bin - 1), 4) low_edge,
               round(lo + (hi - lo) / 50 * g.bin, 4) high_edge, coalesce(n, 0) "rows"
        from generate_series(1, 50) g(bin) cross join R left join N on N.bin = g.bin
        where lo is not null"""
    )


def _histogram(table: str) -> str:
    return _with(f"select * from ({_histogram_body(table)})")


_DUES = """dues as (select * from (values
  (1, 0.015), (2, 0.025), (3, 0.030), (4, 0.035), (5, 0.040), (6, 0.045), (7, 0.050), (8, 0.060),
  (9, 0.070), (10, 0.080), (11, 0.090), (12, 0.100), (13, 0.110), (14, 0.120)) d(year, share)),
loans as (select o_orderkey, cast(o_totalprice as decimal(18,2)) loan,
  cast(cast(o_totalprice as decimal(18,2)) * cast(0.08 as decimal(6,3)) as decimal(18,2)) payment from orders),
L as (select o_orderkey, loan, payment, year,
  cast(loan * cast(share as decimal(6,3)) as decimal(18,2)) p_due from loans, dues)"""

_M = "decimal(18,2)"

_OLD = f"""with recursive {_DUES}, W as (
  select o_orderkey, 0 as year, 0::{_M} p_start, 0::{_M} interest, 0::{_M} p_due, 0::{_M} total_due,
    0::{_M} penalty_accrued, payment, 0::{_M} cut_principal, loan p_end, 0::{_M} p_due_unpaid from loans
  union all
  select o_orderkey, year, p_start, interest, p_due, cast(interest + p_due as {_M}), penalty, payment, principal,
    cast(p_start - principal as {_M}),
    cast(greatest(0, carried + interest + p_due + penalty - payment) as {_M})
  from (select *, cast(payment - interest - penalty as {_M}) principal from (
    select W.o_orderkey, L.year, W.p_end p_start, cast(W.p_end * 0.01 as {_M}) interest, L.p_due, W.payment,
      W.p_due_unpaid carried, cast(W.p_due_unpaid * 0.005 as {_M}) penalty
    from W join L on L.o_orderkey = W.o_orderkey and L.year = W.year + 1 where W.p_end > 0)))
select o_orderkey, year, p_start, interest, p_due, total_due, penalty_accrued, payment,
  penalty_accrued cut_penalty, interest cut_interest, cut_principal, p_end, p_due_unpaid,
  year = max(year) over (partition by o_orderkey) last_payment from W where year > 0"""

_INTERIM = f"""with {_DUES}, P as (
  select *, cast(greatest(0, loan - payment * (year - 1)) as {_M}) p_start from L),
Q as (select *, cast(p_start * 0.01 as {_M}) interest, least(payment, p_start) cut_principal from P where p_start > 0)
select o_orderkey, year, p_start, interest, p_due, payment, cut_principal,
  cast(p_start - cut_principal as {_M}) p_end,
  cast(sum(interest) over (partition by o_orderkey order by year rows unbounded preceding) as {_M}) interest_unpaid,
  0::{_M} penalty_unpaid, year = max(year) over (partition by o_orderkey) last_payment from Q"""

_NEW = f"""with recursive {_DUES}, W as (
  select o_orderkey, 0 as year, 0::{_M} p_start, 0::{_M} interest, 0::{_M} p_due, 0::{_M} total_due, payment,
    0::{_M} cut_p_due, 0::{_M} cut_interest, 0::{_M} cut_p_extra, loan p_end from loans
  union all
  select o_orderkey, year, p_start, interest, p_due, cast(interest + p_due as {_M}), payment, cut_p_due,
    cut_interest, cast(payment - cut_p_due - cut_interest as {_M}),
    cast(p_start - payment + cut_interest as {_M})
  from (select *, least(cast(payment - cut_p_due as {_M}), interest) cut_interest from (
    select W.o_orderkey, L.year, W.p_end p_start, cast(W.p_end * 0.01 as {_M}) interest, L.p_due, W.payment,
      least(W.payment, L.p_due) cut_p_due
    from W join L on L.o_orderkey = W.o_orderkey and L.year = W.year + 1 where W.p_end > 0)))
select o_orderkey, year, p_start, interest, p_due, total_due, payment, cut_p_due, cut_interest,
  0::{_M} cut_penalty, cut_p_extra, p_end,
  year = max(year) over (partition by o_orderkey) last_payment from W where year > 0"""

_BANDS = """bands as (
  select 1700000 - 10000 * y upper, 10180 - 60 * y + case when y >= 103 then 20 when y >= 37 then 10 else 0 end pay
  from generate_series(0, 164) g(y) union all select 50000, 300 union all select 45000, 270),
banded as (select o_orderkey, cast(o_totalprice as decimal(18,2)) amount from orders)"""

_BAND_OF = f"""with {_BANDS} select o_orderkey, %s cast(arg_min(pay, upper) as int) pay
  from banded left join bands on upper >= amount group by all"""

_PLAN = f"""with recursive {_BANDS},
loans as (
  select o_orderkey, cast(o_totalprice as decimal(18,2)) amount,
    cast(least(cast(o_totalprice as decimal(18,2)), 45000) as double) remaining,
    cast(o_orderkey % 2000 as double) interest,
    cast(cast(o_orderdate as date) - to_months(cast((20 + o_custkey % 30) * 12 as int)) as date) birth,
    date '2024-06-15' as_of, date '2024-07-05' first_payment from orders),
-- the months of a small debt, one by one
P as (
  select o_orderkey, remaining bal, 0 n from loans where amount <= 45000
  union all
  select o_orderkey, bal + ((1.0::double / 100) / 12) * bal - 270, n + 1 from P where bal > 0),
paid as (select o_orderkey, max(n) n, arg_max(bal, n) over_paid from P group by 1),
Z as (
  select l.*, n + case when over_paid + interest > 0 then ceil((over_paid + interest) / 270) else 0 end payoff
  from loans l left join paid using (o_orderkey)),
-- pay days up to the birthday at 65, counted one by one
C as (
  select o_orderkey, count(j) reached from loans
  left join generate_series(0, 179) g(j)
    on first_payment + to_months(cast(j as int)) <= cast(birth + to_years(65) as date)
  group by 1),
pays as ({_BAND_OF.split("with ", 1)[1].split("banded as", 1)[1].split("from orders)", 1)[1] % ""})
select o_orderkey,
  day(birth) || '/' || month(birth) || '/' || (year(birth) + 543 + 65) age_limit_text,
  first_payment, '05/7/2567' first_payment_be, cast(reached as int) age_limit_months,
  cast(case when amount <= 45000 then payoff when reached >= 180 then 180 else 0 end as int) as months,
  case when amount <= 45000 then strftime(first_payment + cast((payoff - 1) * 30 as int), '%d/%m') || '/' ||
         (year(first_payment + cast((payoff - 1) * 30 as int)) + 543)
       when reached >= 180 then '05/05/2582' else '15/6/2567' end payoff_be,
  pay, false above_top_band, false never_paid_off
from Z join C using (o_orderkey) join pays using (o_orderkey)"""

_SPANS = """spans as (select l_partkey p_partkey, min(year(l_shipdate)) s, max(year(l_shipdate)) e
  from lineitem group by 1),
I as (select * from spans join part using (p_partkey))"""

_YEARLY = """Y as (select cast(year(o_orderdate) as int) as year,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) revenue, cast(count(*) as double) orders
  from orders group by 1)"""

_PHASES = """P as (select *, case when n <= 4 then 1 when n <= 6 then 2 when n <= 11 then 3 else 4 end phase
  from (select *, row_number() over (order by ts, event_id) n from events))"""

ORACLE = {
    "dedup_b": f"with {LEDGERS} select * from D",
    "dedup_b_with_source": f"""with {LEDGERS} select acc_no, start_date_be, loan_balance, min(source_file) source_file, count(*) copies
        from B group by 1, 2, 3""",
    "dedup_report": f"""with {LEDGERS}, G as (
        select acc_no, count(*) r, count(distinct (start_date_be, loan_balance)) p from B group by 1)
        select cast(sum(r) as bigint) original_rows, cast(sum(p) as bigint) kept_rows,
          cast(sum(r) - sum(p) as bigint) removed_rows,
          count(*) filter (where p > 1 and acc_no is not null) conflict_accounts,
          cast(coalesce(sum(r) filter (where p > 1 and acc_no is not null), 0) as bigint) conflict_records from G""",
    "conflict_accounts": f"""with {LEDGERS}
        select acc_no, count(*) "rows", count(distinct (start_date_be, loan_balance)) pairs
        from B where acc_no is not null group by 1 having count(distinct (start_date_be, loan_balance)) > 1""",
    "conflict_records": f"""with {LEDGERS} select * from B where acc_no in (
        select acc_no from B group by 1 having count(distinct (start_date_be, loan_balance)) > 1)""",
    "filter_active_group": f"with {LEDGERS} select * from A where try_cast(group_flag as bigint) = 1",
    "normalize_key": f"with {LEDGERS} select acc_no, regexp_replace(trim(acc_no), '^0+', '') acc_key from S",
    "reconcile_ab": _with(f"select {_AB_ROW} from AB"),
    "discrepancies_ab": _with(f"select {_AB_ROW} from AB where mismatch <> 'perfect'"),
    "classify_ab": _with(f"select {_COUNTS} from AB"),
    "summary_ab": _with(_AB_SUMMARY),
    "exact_balance_checks": _with(
        """select count(*) filter (where abs(exact_vs_b_diff) > 0.01::double) exact_vs_b_mismatches,
        count(*) filter (where abs(exact_vs_pre_diff) > 0.01::double) exact_vs_pre_mismatches,
        count(*) filter (where is_debt_separation) debt_separation_cases from AB"""
    ),
    "balance_error_stats": _stats("AB"),
    "balance_error_stats_sb": _stats("SB"),
    "date_diff_stats": _with(
        """select count(*) n, round(avg(date_diff_days), 4) mean,
        round(cast(quantile_cont(date_diff_days, 0.5) as double), 4) median,
        round(stddev_pop(date_diff_days), 4) std, cast(min(date_diff_days) as double) "min",
        cast(max(date_diff_days) as double) "max"
        from AB where mismatch <> 'perfect' and day_a is not null and day_b is not null"""
    ),
    "error_histogram": _histogram("AB"),
    "error_histogram_sb": _histogram("SB"),
    "error_histogram_thinned": f"""select cast(ceil(bin / 2.0) as int) bin, min(low_edge) low_edge,
        max(high_edge) high_edge, cast(sum("rows") as bigint) "rows" from ({_histogram("AB")}) group by 1""",
    "quality_metrics": _with(
        f"""select round(least(100.0::double, perfect * 100.0::double / matched_rows + 5), 1) integrity,
        round(matched_rows * 100.0::double / rows_b, 1) coverage,
        round(greatest(0.0::double, 100 - date_only::double / matched_rows * 100), 1) date_accuracy,
        round(greatest(0.0::double, 100 - balance_only::double / matched_rows * 100), 1) balance_accuracy
        from ({_AB_SUMMARY})"""
    ),
    "class_shares": _with(
        """select mismatch, count(*) "rows",
        round(count(*) * 100.0::double / (select count(*) from AB), 1) share_pct from AB group by 1"""
    ),
    "debt_separation": _with(
        """select acc_b acc_no, bal_a pre_balance, exact_bal exact_pre_balance, exact_vs_pre_diff difference,
        bal_b balance_b, 'แยกหนี้ - PRE_BALANCE < EXACT_PRE_BALANCE' remark from AB where is_debt_separation"""
    ),
    "severity_bands": _with(
        """select acc_b acc_no, date_b, bal_diff, case when abs(bal_diff) > 1000 then 'danger'
        when abs(bal_diff) > 100 then 'warning' else 'ok' end severity,
        case when is_debt_separation then 'debt_separation' else 'plain' end row_class
        from AB where mismatch <> 'perfect'"""
    ),
    "scatter_cells": _with(
        """select cast(floor(bal_diff / 100) * 100 as double) x, date_diff_days y, count(*) "rows" from AB
        where mismatch <> 'perfect' group by 1, 2"""
    ),
    "scatter_sample": _with(
        """select x, y, acc_no from (select bal_diff x, date_diff_days y, acc_b acc_no, row_number() over (order by md5(
          '=' || acc_b || '|=' || coalesce(cast(day_a as varchar), '') || '|' || coalesce('=' || date_b, '') || '|=' ||
          cast(cast(round(bal_a * 100) as bigint) as varchar) || '|=' || cast(cast(round(bal_b * 100) as bigint) as varchar))) n
          from AB where mismatch <> 'perfect') where n <= 500"""
    ),
    "sketched_error_stats": _with(
        """select comparison, count(*) n, round(avg(bal_diff), 4) mean, round(stddev_pop(bal_diff), 2) std,
          round(min(bal_diff), 4) "min", round(max(bal_diff), 4) "max", true within_error
        from (select 'ab' comparison, bal_diff, mismatch from AB union all select 'sb', bal_diff, mismatch from SB)
        where mismatch <> 'perfect' group by 1"""
    ),
    "search_account": _with(f"select {_AB_ROW} from AB where mismatch <> 'perfect' and acc_b like '%99%'"),
    "unmatched_b": f"""with {LEDGERS} select acc_b, acc_key, date_b, bal_b from CB
        where not exists (select 1 from CA where CA.acc_key = CB.acc_key)""",
    "unmatched_a": f"""with {LEDGERS} select acc_a, acc_key, day_a, bal_a from CA
        where not exists (select 1 from CB where CA.acc_key = CB.acc_key)""",
    "unmatched_s": f"""with {LEDGERS} select acc_s, acc_key, day_s, bal_s from CS
        where not exists (select 1 from CB where CS.acc_key = CB.acc_key)""",
    "reconcile_sb": _with(f"select {_SB_ROW} from SB"),
    "classify_sb": _with(f"select {_COUNTS} from SB"),
    "summary_sb": _with(_SB_SUMMARY),
    "reconcile_three_way": _with(f"select {_T_ROW} from T"),
    "three_way_summary": _with(_T_SUMMARY),
    "three_way_listing": _with(f"select {_T_ROW} from T"),
    "presence_buckets": f"""with {LEDGERS}, P as (
        select acc_key, bool_or(l = 'a') in_a, bool_or(l = 'b') in_b, bool_or(l = 's') in_s from (
          select acc_key, 'a' l from CA union all select acc_key, 'b' from CB where acc_key is not null union all select acc_key, 's' from CS)
        group by 1)
        select in_a, in_b, in_s, count(*) "keys" from P group by 1, 2, 3""",
    "dashboard_totals": _with(
        f"""select ab.rows_a + ab.rows_b + sb.rows_s total_rows, ab.matched_rows + sb.matched_rows matched_rows,
        ab.date_only + ab.balance_only + ab."both" + sb.date_only + sb.balance_only + sb."both" error_rows
        from ({_AB_SUMMARY}) ab, ({_SB_SUMMARY}) sb"""
    ),
    "summary_matrix": _with(
        f""", X as (select * from ({_AB_SUMMARY})), Y as (select * from ({_SB_SUMMARY})),
        Z as (select * from ({_T_SUMMARY})),
        N as (select count(*) n from (select acc_no from D where acc_no is not null group by 1 having count(*) > 1))
        select 'source_rows' metric, X.rows_a a_vs_b, Y.rows_s s_vs_b, null::bigint three_way from X, Y
        union all select 'filtered_rows', active_rows_a, null, null from X
        union all select 'counterpart_rows', rows_b, rows_b, null from X
        union all select 'matched_rows', X.matched_rows, Y.matched_rows, Z.matched_rows from X, Y, Z
        union all select 'perfect', X.perfect, Y.perfect, Z.perfect from X, Y, Z
        union all select 'date_only', X.date_only, Y.date_only, Z.date_only from X, Y, Z
        union all select 'balance_only', X.balance_only, Y.balance_only, Z.balance_only from X, Y, Z
        union all select 'conflict_accounts', n, null, null from N
        union all select 'debt_separation', debt_separation_cases, null, null from X"""
    ),
    "parse_numbers": """with O as (select o_orderkey, o_orderkey % 8 k, cast(o_totalprice as decimal(18,2)) v from orders),
        R as (select *, k in (3, 4, 5, 6) bad, case when k = 2 then -v::double else v::double end x from O)
        select o_orderkey, case when bad then 0 else x end amount,
          cast(trunc(case when bad then 0 else x end) as bigint) whole, bad unreadable from R""",
    "parse_dates": """with O as (select o_orderkey, o_orderkey % 6 k, cast(o_orderdate as date) d from orders)
        select o_orderkey, case when k < 4 then d end ledger_date,
          case when k < 3 and day(d) <= 12 then make_date(year(d), day(d), month(d)) else d end schedule_date,
          case when k < 5 then d end counterpart_date,
          coalesce(strftime(case when k < 4 then d end, '%Y-%m-%d'), '') iso_text from O""",
    "buddhist_year": """select o_orderkey, cast(year(o_orderdate) + 543 as int) year_be,
        cast(year(o_orderdate) as int) as year from orders""",
    "waterfall_old": _OLD,
    "waterfall_interim": _INTERIM,
    "waterfall_new": _NEW,
    "schedule_head_tail": f"""select o_orderkey, year, p_start, p_end, last_payment from ({_OLD})
        where year <= 3 or last_payment""",
    "instalment_band": _BAND_OF % "",
    "band_lookup": _BAND_OF % "amount,",
    "instalment_plan": _PLAN,
    "group_rollup": """select r_name section, c_mktsegment grp,
        case when grouping(r_name) = 1 then 2 when grouping(c_mktsegment) = 1 then 1 else 0 end as level,
        count(*) accounts from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey group by rollup (r_name, c_mktsegment)""",
    "payment_count_bands": """select case when n = 0 then '0' when n <= 20 then '1-20' else '21+' end band,
        count(*) accounts from (select c_custkey, count(o_orderkey) n from customer
        left join orders on o_custkey = c_custkey group by 1) group by 1""",
    "budget_variance": """with L as (select year(l_shipdate) y, cast(l_extendedprice as decimal(18,2)) o,
          cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(18,2)) n
          from lineitem)
        select cast(y as int) fiscal_year, cast(grouping(y) as int) as level, cast(sum(o) as decimal(38,2)) "old",
          cast(sum(n) as decimal(38,2)) "new", cast(sum(n) - sum(o) as decimal(38,2)) difference
        from L group by rollup (y)""",
    "segment_share": """select c_mktsegment, sum(cast(c_acctbal as decimal(18,2))) "value",
        round(cast(sum(cast(c_acctbal as decimal(18,2))) as double) * 100
          / (select cast(sum(cast(c_acctbal as decimal(18,2))) as double) from customer), 4) share_pct
        from customer group by 1""",
    "deficit_by_resource": """select 'qty' resource, cast(sum(cast(l_quantity as bigint)) as bigint) total from lineitem
        union all select 'line', cast(sum(l_linenumber) as bigint) from lineitem""",
    "deficit_by_property": """with E as (select unnest(json_keys(props)) resource, props from events)
        select resource, cast(sum(cast(json_extract(props, '$."' || resource || '"') as bigint)) as bigint) total
        from E group by 1""",
    "filter_missions": """select event_id, cast(len(json_keys(props)) as int) needs from events
        where event_id % 3 > 0 and len(json_keys(props)) > 0""",
    "reward_by_keyword_class": """with C as (select * from (values ('Ring'), ('Widget'), ('Gear'), ('Misc')) v("class")),
        P as (select case when p_name like '%ring%' then 'Ring' when p_name like '%widget%' or p_name like '%gizmo%'
          then 'Widget' when p_name like '%gear%' then 'Gear' else 'Misc' end "class", p_size from part)
        select "class", cast(coalesce(sum(p_size), 0) as bigint) total from C left join P using ("class") group by 1""",
    "lookup_with_default": """select event_id, event_type, case event_type when 'click' then 'Pointer'
        when 'view' then 'Screen' when 'purchase' then 'Till' else 'Unknown Planet' end place from events""",
    "lookup_fuzzy": """with T as (select * from (values ('RED BOLT'), ('Widget'), ('gea'), ('new an'), ('zzz')) v(term)),
        R as (select term, p_name, p_partkey, lower(p_name) = lower(term) is_exact,
          row_number() over (partition by term order by lower(p_name) = lower(term) desc, p_partkey) n
          from T join part on contains(lower(p_name), lower(term)))
        select term, coalesce(p_name, 'Unknown') found, p_partkey, coalesce(is_exact, false) is_exact
        from T left join (select * from R where n = 1) using (term)""",
    "lookup_terms": """with T as (
          select distinct case when o_custkey % 97 = 0 then piece || '?' when o_custkey % 97 = 1 then p_name else piece end term
          from (select *, substr(upper(p_name), cast(1 + o_orderkey % 5 as int), cast(o_orderkey % 9 as int)) piece
            from orders join part on p_partkey = o_orderkey % 200 + 1)),
        N as (select lower(p_name) low, min(struct_pack(p_partkey := p_partkey, p_name := p_name)) f from part group by 1),
        R as (select term, min(struct_pack(apart := low <> lower(term), f := f)) r from T join N on contains(low, lower(term)) group by 1)
        select term, coalesce(r.f.p_name, 'Unknown') found, r.f.p_partkey p_partkey, coalesce(not r.apart, false) is_exact
        from T left join R using (term)""",
    "search_any_column": """select p_partkey, p_name, p_brand, p_type, p_size from part
        where contains(lower(concat_ws(' ', p_partkey, p_name, p_brand, p_type, p_size)), 'ing brand#2')""",
    "filter_by_type": "select event_id, user_id, event_type, value from events where event_type = 'error'",
    "sorted_catalog": """select p_partkey, case when p_partkey > 99 then cast(p_partkey as varchar)
        else lpad(cast(p_partkey as varchar), 3, '0') end label, p_name from part order by 1""",
    "display_labels": """select p_partkey, case when length(p_name) > 6 then substr(p_name, 1, 6) || '...' else p_name end short_name,
        format('{:,.2f}', p_retailprice) price from part""",
    "display_dates": """select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') day_first,
        strftime(o_orderdate, '%m/%d') month_day from orders""",
    "focus_vs_rest": """select p_partkey, round(case when p_brand = 'Brand#7' then p_size::double / 40
        else p_size::double / 50 end, 4) size from part""",
    "threshold_labels": """select p_partkey, case when p_size > 40 then 'high' when p_size > 20 then 'medium' else 'low' end size_label,
        case when p_retailprice >= 1000 then 'top' else 'regular' end price_label,
        case p_type when 'PROMO' then 'offer' when 'ECONOMY' then 'basic' else 'standard' end type_label from part""",
    "capacity_gap": """select s_suppkey, cast(round(s_acctbal / 5000 * 100) as bigint) percent,
        round(greatest(0, 5000 - s_acctbal), 2) shortfall from supplier""",
    "roadmap_by_category": f"""with {_SPANS} select p_type, count(*) parts, cast(min(s) as int) "start",
        cast(max(e) as int) "end", cast(sum(e - s + 1) as bigint) as years from I group by 1""",
    "roadmap_years": f"""with {_SPANS} select p_partkey, p_type, cast(unnest(generate_series(s, e)) as int) as year from I""",
    "roadmap_year_matrix": f"""with {_SPANS} select p_type, cast(y as int) as year, count(*) parts
        from (select p_type, unnest(generate_series(s, e)) y from I) group by 1, 2""",
    "kpi_long": f"""with {_YEARLY} select year, 'revenue' metric, revenue "value" from Y
        union all select year, 'orders', orders from Y""",
    "kpi_zipped": f"""with {_YEARLY} select year, 'revenue' metric, revenue "value" from Y
        union all select year, 'orders', orders from Y""",
    "kpi_last_value": f"""with {_YEARLY} select 'revenue' metric, arg_max(revenue, year) "value", max(year) as year from Y
        union all select 'orders', arg_max(orders, year), max(year) from Y""",
    "year_ordinal": """select o_custkey, cast(y as int) as year,
        cast(y - min(y) over (partition by o_custkey) + 1 as int) ordinal
        from (select distinct o_custkey, year(o_orderdate) y from orders)""",
    "phase_by_position": f"with {_PHASES} select event_id, event_type, phase from P",
    "nest_children": f"""with {_PHASES} select 'timeline' parent, cast(phase as varchar) child, 1 depth from P group by 2
        union all select cast(phase as varchar), cast(event_id as varchar), 2 from P""",
    "nested_phases": f"""with {_PHASES}, R as (select *, (row_number() over (partition by phase order by ts, event_id) - 1) // 100 part from P)
        select phase, part, count(*) events, string_agg(cast(event_id as varchar), ',' order by ts, event_id) event_ids from R group by 1, 2""",
    "edge_endpoints": """select 'N' || n_nationkey source, 'R' || n_regionkey target, n_name source_name, 1 source_grp,
        r_name target_name, 2 target_grp from nation join region on n_regionkey = r_regionkey""",
    "capability_systems": "select distinct c_nationkey, c_mktsegment segment from customer",
}

ORACLE["summary_ab_by_account"] = (
    "with "
    + LEDGERS.replace("CA as (", "CA1 as (").replace("CB as (", "CB1 as (")
    + """, CA as (select * exclude n from (select *, row_number() over (partition by acc_key
           order by day_a, bal_a, exact_bal, acc_a) n from CA1) where n = 1),
         CB as (select * exclude n from (select *, row_number() over (partition by acc_key
           order by day_b nulls first, bal_b, acc_b, date_b) n from CB1) where n = 1)"""
    + COMPARED[len(LEDGERS) :]
    + _AB_SUMMARY.replace("(select count(*) from D)", "(select count(*) from CB)").replace(
        "(select count(*) from D where acc_no is null)", "(select count(*) from CB where acc_key is null)"
    )
)

_LISTS = [
    ("errors_ab", "AB where mismatch <> 'perfect'", "acc_b", "bal_b"),
    ("errors_sb", "SB where mismatch <> 'perfect'", "acc_b", "bal_b"),
    ("debt_separation", "AB where is_debt_separation", "acc_b", "bal_b"),
    (
        "conflicts",
        "B where acc_no in (select acc_no from B group by 1 "
        "having count(distinct (start_date_be, loan_balance)) > 1)",
        "acc_no",
        "loan_balance",
    ),
    ("three_way_perfect", "T where mismatch = 'perfect'", "acc_a", "bal_b"),
    ("three_way_discrepancies", "T where mismatch <> 'perfect'", "acc_a", "bal_b"),
]

_LIST_SIZES = _with(" union all ".join(f"""select '{n}' list, count(*) "rows" from {s}""" for n, s, _, _ in _LISTS))
_LIST_CONTENT = _with(
    " union all ".join(
        f"""select '{n}' list, count(*) "rows", count(distinct {account}) accounts, min({account}) first_account,
        max({account}) last_account, cast(coalesce(sum(cast({amount} as decimal(18,2))), 0) as double) amount from {s}"""
        for n, s, account, amount in _LISTS
    )
)


def _named(values: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as name, cast(({v}) as double) as value" for n, v in values.items())


_REPORT_VALUES = _with(
    f""", XA as (select * from ({_AB_SUMMARY})), XS as (select * from ({_SB_SUMMARY})),
    ES as ({_stats_body("SB")}), HA as ({_histogram_body("AB")}), HS as ({_histogram_body("SB")}) """
    + _named(
        {
            **{f"stats.{x}.{c}": f"select {c} from X{x[0].upper()}" for x in ("ab", "sb") for c in ("matched_rows", "unmatched_b", "bad_balances")},
            "stats.three_way.perfect": "select count(*) from T where mismatch = 'perfect'",
            "stats.totals.total_rows": "select XA.rows_a + XA.rows_b + XS.rows_s from XA, XS",
            "stats.totals.error_rows": """select XA.date_only + XA.balance_only + XA."both" + XS.date_only
                + XS.balance_only + XS."both" from XA, XS""",
            **{f"charts.balance_errors_sb.{c}": f"select {c} from ES" for c in ("n", "mean", "p99")},
            **{
                f"charts.classes_{name}.{k}": f"select count(*) from {table} where mismatch = '{k}'"
                for name, table in (("ab", "AB"), ("sb", "SB"), ("three_way", "T"))
                for k in ("perfect", "date_only", "balance_only", "both")
            },
            "histogram_ab": 'select sum("rows") from HA',
            "histogram_sb": 'select sum("rows") from HS',
        }
    )
)

_COUNTERPART_CELLS = f"""with {LEDGERS} select acc_no, start_date_be,
    case when balance_text <> 'N/A' then balance_text end loan_balance from BT"""


def _hot(every: int, body: str) -> str:
    """The same, with every ``every``-th order under one account in each ledger."""
    ledgers = LEDGERS
    is_hot = f"case when o_orderkey % {every} = 0 then 'H1'"
    plain = "lpad(cast(o_orderkey as varchar), 10, '0')"
    ledgers = ledgers.replace(f"{plain} acc_no", f"{is_hot} else {plain} end acc_no")
    ledgers = ledgers.replace("case when o_orderkey % 97 = 0 then null", f"{is_hot} when o_orderkey % 97 = 0 then null")
    ledgers = ledgers.replace(
        "' 00' || case when o_orderkey % 4 = 0 then 'S' else '' end || cast(o_orderkey as varchar) acc_no",
        f"""' 00' || {is_hot}
            else case when o_orderkey % 4 = 0 then 'S' else '' end || cast(o_orderkey as varchar) end acc_no""",
    )
    return f"with {ledgers}{COMPARED[len(LEDGERS):]} {body}"


def _penny_gaps(sql: str) -> str:
    """The same in decimals, with gaps of one and two hundredths in every fifth system balance."""
    more = "case cast(cast(pre_balance as decimal(18,2)) * 100 as bigint) % 5 when 1 then 0.01 when 2 then 0.02 else 0.00 end"
    for double, exact in {
        "cast(pre_balance as double) bal_a": f"cast(pre_balance as decimal(28,4)) + {more} bal_a",
        "cast(exact_pre_balance as double)": "cast(exact_pre_balance as decimal(28,4))",
        "try_cast(balance_text as double)": "try_cast(balance_text as decimal(28,4))",
        "0.01::double": "0.01::decimal(4,2)",
    }.items():
        sql = sql.replace(double, exact)
    return sql


ORACLE |= {
    "reconcile_ab_decimal": _penny_gaps(
        _with(
            """select acc_b acc_no, coalesce(cast(day_a as varchar), '') date_a, date_b,
            cast(cast(bal_diff as decimal(28,4)) as varchar) bal_diff, bal_diff_pct, bal_match, mismatch from AB"""
        )
    ),
    "classify_ab_decimal_hot": _penny_gaps(_hot(3, f"select {_COUNTS} from AB")),
    "scan_system": f"with {LEDGERS} select * from A",
    "scan_counterpart": _COUNTERPART_CELLS,
    "scan_mapped_columns": _COUNTERPART_CELLS,
    "scan_code_pages": _COUNTERPART_CELLS,
    "scan_late_header": f"with {LEDGERS} select * from S",
    "scan_quoted_text": f"""with {LEDGERS} select * replace (replace(first_payment_date, ' ', chr(10))
        as first_payment_date) from A""",
    "rejected_rows": f"""with {LEDGERS} select *, 'beyond' beyond_header from S
        where cast(regexp_extract(acc_no, '([0-9]+)$', 1) as bigint) % 10 = 0""",
    "scan_strict": f"""with {LEDGERS} select * from S
        where cast(regexp_extract(acc_no, '([0-9]+)$', 1) as bigint) % 10 > 3""",
    "rejects_by_reason": f"""with {LEDGERS} select case cast(regexp_extract(acc_no, '([0-9]+)$', 1) as bigint) % 10
          when 0 then 'long_line' when 1 then 'short_line' when 2 then 'open_quote' when 3 then 'undecodable' else 'kept' end reason,
          count(*) "rows" from S group by 1""",
    "file_inventory": "select count(*) > 0 all_digested, count(*) > 0 same_bytes from orders",
    "scan_schedule": f"with {LEDGERS} select * from S",
    "row_estimate": "select count(*) data_rows from orders",
    "row_estimate_sampled": "select count(*) data_rows, true within_error, true few_bytes_read from orders",
    "written_lists": _LIST_CONTENT,
    "published_lists": _LIST_CONTENT,
    "report_lists": _LIST_SIZES,
    "report_values": _REPORT_VALUES,
    "summary_ab_hot": _hot(3, _AB_SUMMARY),
    "three_way_hot": _hot(100, _T_SUMMARY),
}
