"""Helpers the operators of this folder share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import drop_folder, settle, work_folder

__all__ = ["drop_folder", "read", "remainder", "settle", "work_folder", "worker_store"]


#: Rows that go to a Python worker at a time: long texts make batches large.
BATCH_ROWS = 2_000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; Python workers of the session take rows BATCH_ROWS at a time from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key's text modulo ``parts``: the fold a row belongs to."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts))


def worker_store() -> dict:
    """What one Python worker keeps from task to task (tokenizers, word caches)."""
    return sys.modules.setdefault("_worker_store", types.ModuleType("_worker_store")).__dict__
