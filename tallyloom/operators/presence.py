"""Which ledgers hold an account, and the rows without a partner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.skew import spread_nulls


def presence_flags(ledgers: dict[str, DataFrame], key: str) -> DataFrame:
    """One row per key with a flag per ledger: one shuffle of keys, no outer joins.

    Flags combine on the map side, so a key with very many rows costs one row per task.
    """
    tagged = None
    for name, frame in ledgers.items():
        flags = [F.lit(name == other).alias(f"in_{other}") for other in ledgers]
        part = frame.where(F.col(key).isNotNull()).select(key, *flags)
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(*[F.max(f"in_{n}").alias(f"in_{n}") for n in ledgers])


def presence_buckets(ledgers: dict[str, DataFrame], key: str) -> DataFrame:
    names = [f"in_{n}" for n in ledgers]
    return presence_flags(ledgers, key).groupBy(*names).agg(F.count(F.lit(1)).alias("keys"))


def without_partner(rows: DataFrame, other: DataFrame, key: str, heavy: Sequence = ()) -> DataFrame:
    """Rows whose key the other ledger does not hold; rows without a key count too.

    Rows of ``heavy`` keys stay where they are: the other ledger's copy of those few
    keys goes to them. All others meet by key.
    """
    keys = other.where(F.col(key).isNotNull()).select(F.col(key).alias("_join")).distinct()

    def missing(part: DataFrame, known: DataFrame) -> DataFrame:
        return part.withColumn("_join", spread_nulls(key)).join(known, "_join", "left_anti").drop("_join")

    if not heavy:
        return missing(rows, keys)
    is_heavy = F.coalesce(F.col(key).isin(*heavy), F.lit(False))
    few = F.broadcast(keys.where(F.col("_join").isin(*heavy)))  # at most one row per heavy key
    return missing(rows.where(~is_heavy), keys).unionByName(missing(rows.where(is_heavy), few))
