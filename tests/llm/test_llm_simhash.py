import os
import random
import sys

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_tables import no_documents, odd_documents
from tallyloom.llm import simhash


def plain_fingerprint(text):
    words = []
    word = ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=3):
    """Smallest position in the component of each fingerprint, by all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= distance):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def clouds(seed, count):
    """Fingerprints in chains and dense clouds, and some far from all others."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(count)} | {0, 1, (1 << 64) - 1}
    for centre in [rng.getrandbits(64) for _ in range(6)]:
        x = centre
        for _ in range(40):
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
        for _ in range(120):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(0, 64, 3), rng.randint(1, 4))))
    return sorted(out)


@pytest.mark.parametrize("place", [4, simhash.PLACE])
def test_components_against_all_pairs(spark, place):
    values = clouds(place, 400)
    want = plain_groups(values)
    rows = [(simhash._signed(v),) for v in values]
    found = simhash.components(simhash.links(spark.createDataFrame(rows, "fp long").repartition(3), place=place)).collect()
    names = {r.node: r.root for r in found}
    groups, expected = {}, {}
    for k, v in enumerate(values):
        groups.setdefault(names.get(simhash._signed(v), simhash._signed(v)), set()).add(k)
        expected.setdefault(want[k], set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_masks_lose_no_pair():
    rng = random.Random(4)
    for count in (10, 10**7, 10**11):
        masks = simhash.first_masks(count)
        for _ in range(200):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            met = [m for m in masks if x & m == y & m]
            assert met
            finer = simhash.second_masks(met[0])
            assert any(x & m == y & m for m in finer)
            assert all(64 - m.bit_count() <= 12 for m in finer)


def test_pivot_distances_are_within_the_distance():
    refs = simhash.references(63)
    assert len(set(refs.tolist())) == 63 and {int(r).bit_count() for r in refs} == {32}


def test_fingerprints_and_groups_of_documents(spark, folder):
    odd = odd_documents(spark).selectExpr("doc_id + 100000 as doc_id", "text")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").unionAll(odd)
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    prints = sorted({f for _, f in rows})
    group = dict(zip(prints, plain_groups(prints)))
    least = {}
    for key, f in rows:
        if key is not None:
            least[group[f]] = min(key, least.get(group[f], key))
    want = sorted(((k, f"{f:016x}", least.get(group[f])) for k, f in rows), key=repr)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == want


def test_odd_tables(spark):
    assert simhash.near_duplicates(no_documents(spark)).collect() == []
    out = simhash.near_duplicates(odd_documents(spark)).collect()
    assert len(out) == 10
    blank = [r for r in out if r.doc_id in (3, 4, 5)]
    assert {(r.fingerprint, r.component_id) for r in blank} == {("0" * 16, 3)}


def test_components_of_long_chains_and_stars(spark):
    rows = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 320)] + [(5, 5), (7, 200)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert found == {**{k: 100 for k in range(100, 161)}, **{k: 7 for k in range(200, 320)}, 7: 7}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).collect() == []
