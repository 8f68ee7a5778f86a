"""Lookup of an amount in a table of bands."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.operators.literals import literal_rows

# Fixed values of the instalment bands: the top band and its payment, the steps from
# band to band, where the payment gets its roundings, and the two lowest bands.
TOP_AMOUNT, AMOUNT_STEP = 1_700_000, 10_000
TOP_PAYMENT, PAYMENT_STEP = 10_180, 60
ROUNDINGS = [(37, 10), (103, 20)]
LOW_BANDS = [(45_000, 270), (50_000, 300)]
LAST_REGULAR = 164


def instalment_bands(spark: SparkSession) -> DataFrame:
    """The 167 bands: up to ``upper`` the payment is ``pay``."""
    y = F.col("id")
    extra = F.lit(0)
    for start, amount in ROUNDINGS:
        extra = F.when(y >= start, F.lit(amount)).otherwise(extra)
    regular = spark.range(0, LAST_REGULAR + 1).select(
        (TOP_AMOUNT - AMOUNT_STEP * y).cast("decimal(18,2)").alias("upper"),
        (TOP_PAYMENT - PAYMENT_STEP * y + extra).cast("int").alias("pay"),
    )
    low = literal_rows(spark, ["upper", "pay"], [(Decimal(a), p) for a, p in LOW_BANDS])
    low = low.withColumn("upper", F.col("upper").cast("decimal(18,2)"))
    return regular.unionByName(low)


#: How many they are.
INSTALMENT_BANDS = LAST_REGULAR + 1 + len(LOW_BANDS)
#: Cells, and bands, up to which the grid is broadcast.
MOST_CELLS = 100_000


def instalment_payment(amount: Column) -> Column:
    """The band's payment in closed form: nothing for zero, null above the top band."""
    # A band reaches up to and including its upper amount.
    y = F.floor((F.lit(TOP_AMOUNT) - amount) / F.lit(AMOUNT_STEP))
    extra = F.lit(0)
    for start, more in ROUNDINGS:
        extra = F.when(y >= start, F.lit(more)).otherwise(extra)
    (lowest, low_pay), (second, second_pay) = LOW_BANDS
    pay = (
        F.when(amount == 0, F.lit(0))
        .when((amount > 0) & (amount <= lowest), F.lit(low_pay))
        .when(amount <= second, F.lit(second_pay))
    )
    regular = F.lit(TOP_PAYMENT) - F.lit(PAYMENT_STEP) * y + extra
    return pay.when(amount <= TOP_AMOUNT, regular).cast("int")


def band_join(
    rows: DataFrame, amount: str, bands: DataFrame, upper: str, payload: list[str], cell: int, top: int, count: int | None = None
) -> DataFrame:
    """Each row with the payload of the lowest band whose upper end reaches its amount.

    Amounts are non-negative. The range condition becomes an equality on grid cells of
    width ``cell``, with the exact condition on top, so no row meets every band. The
    spread-out band table has at most ``top / cell`` rows more than there are bands;
    rows above the last band keep a null payload. ``count`` is the number of bands, for a caller
    who knows it; else a job counts them.
    """
    if top / cell > MOST_CELLS:
        raise ValueError("cell is too small: the band grid would not stay small")
    # The grid is broadcast only while the band table itself is small.
    count = bands.limit(MOST_CELLS + 1).count() if count is None else count
    small = F.broadcast if count <= MOST_CELLS else (lambda df: df)
    below = F.lag(upper).over(Window.orderBy(upper))  # the band table itself is small
    grid = (
        bands.withColumn("_lower", F.coalesce(below, F.lit(-1).cast("decimal(18,2)")))
        .withColumn(
            "_cell",
            F.explode(
                F.sequence(
                    F.greatest(F.floor(F.col("_lower") / cell).cast("bigint"), F.lit(0).cast("bigint")),
                    F.ceil(F.col(upper) / cell).cast("bigint"),
                )
            ),
        )
        .select("_cell", "_lower", F.col(upper).alias("_upper"), *payload)
    )
    keyed = rows.withColumn("_cell", F.floor(F.col(amount) / cell).cast("bigint"))
    hit = (
        (keyed["_cell"] == grid["_cell"])
        & (keyed[amount] > grid["_lower"])
        & (keyed[amount] <= grid["_upper"])
    )
    return keyed.join(small(grid), hit, "left").select(*[keyed[c] for c in rows.columns], *payload)
