"""Statistics from sketches that were merged."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import sketches as sk


def test_merged_sketches_equal_the_rows(spark):
    rng = random.Random(5)
    values = [(k % 40, rng.choice([0.0, 250.75, rng.gauss(0, 1000)])) for k in range(60_000)]
    rows = spark.createDataFrame(values, "day int, gap double").repartition(13)
    daily = sk.sketches(rows, ["day"], "gap")
    weekly = sk.merged(daily.withColumn("week", F.floor(F.col("day") / 7)), ["week"])
    array = np.sort([v for _, v in values])
    for parts in (daily, weekly):
        s = sk.statistics(parts, wanted={"p10": 0.1, **sk.QUANTILES}).first()
        assert s.n == len(array) and s.min == array[0] and s.max == array[-1]
        assert abs(s.mean - array.mean()) < 1e-6 and abs(s["std"] - array.std()) < 1e-3
        for name, share in {"p10": 0.1, **sk.QUANTILES}.items():
            low, high = np.searchsorted(array, s[name]), np.searchsorted(array, s[name], side="right")
            assert low / len(array) <= share + sk.RANK_ERROR and high / len(array) >= share - sk.RANK_ERROR
    assert max(len(r.sketch) for r in daily.select("sketch").collect()) < 40_000


def test_a_day_can_be_added_later(spark):
    rows = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (3, None)], "day int, gap double")
    kept = sk.sketches(rows.where("day < 2"), ["day"], "gap").unionByName(sk.sketches(rows.where("day >= 2"), ["day"], "gap"))
    s = sk.statistics(kept).first()
    assert (s.n, s.mean, s.min, s.max, s.median) == (3, 3.0, 1.0, 5.0, 3.0)
    by_day = {r.day: (r.n, r.median) for r in sk.statistics(kept, ["day"]).collect()}
    assert by_day[2] == (1, 5.0) and by_day[3] == (0, None)
    assert sk.statistics(kept.limit(0), ["day"]).collect() == []
