import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import check
from llm_tables import no_documents, odd_documents
from tallyloom.llm import lexical_search as ls
from tallyloom.llm.queries import ORACLE, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def by_hand(docs, items, best=50):
    """{position of the item: [(doc_id, score)]}, document by document."""
    counts = [(k, terms(t)) for k, t in docs]
    counts = [(k, Counter(w), len(w)) for k, w in counts if w]
    total = sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = {}
    for i, (_, text) in enumerate(items):
        scored = []
        for k, c, n in counts:
            m = 100 - 50 + 50 * n * len(counts) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) & set(c)
            )
            if score > 0:
                scored.append((-score, k is None, k, score))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out[i] = [(k, score) for _, _, k, score in scored[:best]]
    return out


def listed(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


def expected(docs, items, best=50):
    held = by_hand(docs, items, best)
    return sorted(((items[i][0], rank, k, s) for i, rows in held.items() for rank, (k, s) in enumerate(rows, 1)), key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_terms():
    for text in ("A b-C dÉ́f\x00g_h 1a2 你好。x\x7fy İ z", "", " ", "\x85 a"):
        assert [t.decode() for t in ls.terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("tile", [(3, 4, 7), (256, 2048, 512)])
def test_against_brute_force(spark, monkeypatch, tile):
    for name, value in zip(("ITEMS", "TERMS", "DOCS"), tile):
        monkeypatch.setattr(ls, name, value)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)] + ["É", "Zz", "你好"]
    docs = [(k, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.randint(0, 40)))) for k in range(300)]
    docs += [(900 - k, "w1 w2 w3") for k in range(120)] + [(None, "w1 w2 w3"), (901, None), (5, docs[5][1])]
    items = [(k, " ".join(rng.choices(words + ["unknown"], k=rng.randint(0, 12)))) for k in range(20)]
    items += [(50, "w1 W2 w3"), (51, "nothing here"), (52, None), (3, "zz É"), (53, "")]
    for best in (1, 50):
        assert listed(ls.search(*tables(spark, docs, items), best=best)) == expected(docs, items, best)


def test_ties_across_tasks_keep_the_smallest_ids(spark):
    docs = [(k, "same text") for k in random.Random(1).sample(range(10_000), 3_000)] + [(-1 - k, "other") for k in range(3_000)]
    found = ls.search(*tables(spark, docs, [(7, "same")]))
    assert [r.doc_id for r in found.orderBy("rank").collect()] == sorted(k for k, _ in docs if k >= 0)[:50]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = [(k, f"a{k % 7} b{k % 11} c") for k in range(200)], [(k, f"a{k % 9} c b{k}") for k in range(30)]
    monkeypatch.setattr(ls, "BLOCK_BYTES", 40)
    assert listed(ls.search(*tables(spark, docs, items))) == expected(docs, items)


def test_columns_are_exact():
    weights = np.array([10**6] * 50_000)
    runs = ls.exact_columns(np.arange(50_000), weights, width=1 << 30)
    assert len(runs) > 5 and np.concatenate(runs).tolist() == list(range(50_000))
    assert all(int(weights[r].sum()) * ls.IMPACT < ls.EXACT for r in runs)
    assert all(len(r) <= ls.TERMS for r in ls.exact_columns(np.arange(5000), weights // 10**6))


def test_odd_and_empty_tables(spark):
    odd, none = odd_documents(spark), no_documents(spark)
    items = odd.withColumnRenamed("doc_id", "item_id")
    pairs = [(r.doc_id, r.text) for r in odd.collect()]
    assert listed(ls.search(odd, items)) == expected(pairs, pairs)
    assert ls.search(none, items).collect() == [] and ls.search(odd, none.withColumnRenamed("doc_id", "item_id")).collect() == []


def test_query_equals_its_sql(spark, folder):
    found = QUERIES["op11_lexical_search"](spark, folder)
    assert found.count() > 1000
    assert check.differences(found, check.connect(folder), ORACLE["op11_lexical_search"]) == []
