"""Samples by digest, and lookups by a table of terms."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import lookups as lk
from tallyloom.operators import topn as tn


def test_sample_does_not_depend_on_how_the_rows_lie(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 7).cast("string").alias("t"))
    want = sorted(tn.hash_sample(rows.repartition(3), 300).collect())
    assert len(want) == 300 and want == sorted(tn.hash_sample(rows.repartition(300), 300).collect())
    assert want == sorted(tn.hash_sample(rows.orderBy(F.col("id").desc()), 300).collect())
    ids = [r.id for r in want]
    assert 7_000 < sum(ids) / 300 < 13_000 and len(set(ids)) == 300


def test_sample_is_whole_where_there_are_no_more_rows(spark):
    rows = spark.createDataFrame([(1, None), (1, ""), (1, None), (2, "a")], "k int, t string")
    assert tn.hash_sample(rows, 10).count() == 4
    assert tn.hash_sample(rows.limit(0), 10).collect() == []
    hot = spark.range(9_000).select((F.col("id") % 3).alias("k"))
    assert tn.hash_sample(hot, 100).count() == 100


def by_hand(rows, terms, default="Unknown"):
    out = set()
    for t in set(terms) - {None}:
        hits = [(v.lower() != t.lower(), k, v) for k, v in rows if v is not None and t.lower() in v.lower()]
        best = min(hits, default=None)
        out.add((t, best[2], best[1], not best[0]) if best else (t, default, None, False))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_terms_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choice("abcAB é你 ") for _ in range(rng.randint(0, n)))

    rows = [(k, text(14)) for k in range(400)] + [(500, None), (501, "Exact Match"), (502, "an exact match indeed"), (503, "EXACT MATCH")]
    terms = [text(6) for _ in range(300)] + ["exact match", "act", "zzz", "zzzz", "", None, "indeed", "abcx"]
    table = spark.createDataFrame(rows, "k long, v string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in terms], "t string")
    found = lk.lookup_terms(table, wanted, "t", "v", "k")
    assert {tuple(r) for r in found.select("term", "found", "k", "is_exact").collect()} == by_hand(rows, terms)


def test_many_terms_need_no_nested_loop(spark):
    names = spark.range(5_000).select("id", F.concat(F.lit("part number "), F.md5(F.col("id").cast("string").cast("binary"))).alias("name"))
    pieces = F.substring(F.md5((F.col("id") % 5_000).cast("string").cast("binary")), F.lit(3), (F.col("id") / 10_000 + 8).cast("int"))
    terms = spark.range(100_000).select(F.concat(pieces, F.when(F.col("id") % 10_000 < 5_000, F.lit("")).otherwise(F.lit("z"))).alias("term"))
    found = lk.lookup_terms(names, terms, "term", "name", "id")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        found.explain("formatted")
    assert "NestedLoop" not in text.getvalue() and "Cartesian" not in text.getvalue()
    counted = found.agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("hits"), F.count_if(F.contains("found", F.col("term"))).alias("right")).first()
    assert counted.n == terms.distinct().count() and counted.hits == counted.right > 49_000 and counted.n > 99_000


def test_empty_tables(spark):
    table, wanted = spark.createDataFrame([(1, "abc")], "k long, v string"), spark.createDataFrame([("b",)], "t string")
    assert lk.lookup_terms(table.limit(0), wanted, "t", "v", "k").collect()[0].found == "Unknown"
    assert lk.lookup_terms(table, wanted.limit(0), "t", "v", "k").collect() == []
