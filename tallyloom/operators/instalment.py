"""Instalment plan of a loan in closed form: first payment, age limit, payoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.parsing import buddhist_text, buddhist_year
from tallyloom.operators.bands import instalment_payment

# Fixed values of the plan.
PAY_DAY = 5
AGE_LIMIT = 65
MAX_MONTHS = 180
SMALL_DEBT = 45_000
SMALL_PAYMENT = 270
YEARLY_RATE = 0.01
FULL_TERM_END = "05/05/2582"


def first_payment(as_of: Column) -> Column:
    """The pay day of the month after the contract date."""
    return F.date_add(F.trunc(F.add_months(as_of, 1), "month"), PAY_DAY - 1)


def age_limit_text(birth: Column) -> Column:
    """The birthday at the age limit as day/month/Buddhist year, without padding."""
    year = buddhist_year(birth) + AGE_LIMIT
    return F.concat_ws("/", F.dayofmonth(birth), F.month(birth), year)


def months_to_age_limit(birth: Column, as_of: Column) -> Column:
    """Pay days from the first payment up to the birthday at the age limit, 0..180."""
    first = first_payment(as_of)
    start = F.year(first) * 12 + F.month(first)
    end = (F.year(birth) + AGE_LIMIT) * 12 + F.month(birth)
    reached = F.when(F.dayofmonth(birth) >= PAY_DAY, F.lit(1)).otherwise(F.lit(0))
    return F.least(F.lit(MAX_MONTHS), F.greatest(F.lit(0), end - start + reached))


def payoff_months(balance: Column, interest: Column) -> Column:
    """Months at the small payment until principal, then left-over interest, is paid.

    The balance earns monthly interest while it is paid down; what is overpaid in the
    last month counts against the interest, which itself earns nothing. Null where the
    payment never covers the monthly interest.
    """
    balance, interest = balance.cast("double"), interest.cast("double")
    r, pay = F.lit(YEARLY_RATE / 12), F.lit(float(SMALL_PAYMENT))
    share = balance * r / pay
    n = F.when(balance > 0, F.ceil(-F.log(1.0 - share) / F.log(1.0 + r))).otherwise(F.lit(0))
    growth = F.pow(1.0 + r, n)
    left = balance * growth - pay * (growth - 1.0) / r
    rest = left + interest
    more = F.when(rest > 0, F.ceil(rest / pay)).otherwise(F.lit(0))
    return F.when(share < 1, n + more).cast("int")


def instalment_plan(loans: DataFrame, keys: list[str]) -> DataFrame:
    """The plan of each loan.

    ``loans`` has ``amount``, ``remaining``, ``interest``, ``birth_date`` and ``as_of``.
    """
    amount, as_of = F.col("amount"), F.col("as_of")
    small = amount <= SMALL_DEBT
    planned = loans.withColumns(
        {
            "first_payment": first_payment(as_of),
            "age_limit_months": months_to_age_limit(F.col("birth_date"), as_of),
            "pay": instalment_payment(amount),
            "_payoff": payoff_months(F.col("remaining"), F.col("interest")),
        }
    )
    whole_term = F.col("age_limit_months") >= MAX_MONTHS
    months = F.when(small, F.col("_payoff")).when(whole_term, F.lit(MAX_MONTHS)).otherwise(F.lit(0))
    payoff_day = F.date_add(F.col("first_payment"), (F.col("_payoff") - 1) * 30)
    today = F.concat_ws("/", F.dayofmonth(as_of), F.month(as_of), buddhist_year(as_of))
    last = (
        F.when(small, buddhist_text(payoff_day, "dd/MM"))
        .when(whole_term, F.lit(FULL_TERM_END))
        .otherwise(today)
    )
    return planned.select(
        *keys,
        age_limit_text(F.col("birth_date")).alias("age_limit_text"),
        "first_payment",
        F.concat(F.lit("05/"), F.month("first_payment"), F.lit("/"), buddhist_year("first_payment")).alias(
            "first_payment_be"
        ),
        "age_limit_months",
        months.alias("months"),
        last.alias("payoff_be"),
        "pay",
        F.col("pay").isNull().alias("above_top_band"),
        (small & F.col("_payoff").isNull()).alias("never_paid_off"),
    )


