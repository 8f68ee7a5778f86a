"""Near-duplicate groups by SimHash, pairs found with pivot distance tables.

Fingerprints are 64 majority bits over the XXH64 of a text's word shingles. Different
fingerprints meet where all but ``distance`` of their bit groups are equal (some groups must
be, if at most that many bits differ, so no pair is lost); there the table of their Hamming
distances to many reference fingerprints discards pairs by their largest coordinate
difference, and the rest are verified bit by bit. Each meeting place gives a spanning set of
links, not all pairs. A place with more than ``PLACE`` members is dealt again by all the
ways to keep nine of twelve groups of the other bits, which leaves at most 4,096 members, as
fingerprints are different. Groups are the connected components of the links.

Defined cases: a null text or one without words has fingerprint zero and links like any
other; equal fingerprints are one node, so copies never meet in a task; a group's name is its
smallest id, ids that are null are left aside unless there are no others; repeated rows stay;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import settle

SHINGLE, DISTANCE, SEED, BITS = 3, 3, 42, 64
#: Members of a meeting place that are compared there.
PLACE = 4_096
#: Rows compared at a time; a place is never cut.
CHUNK = 100_000
#: Mean members of a place at which more bit groups are used.
CROWD = 64
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 20


def words_of(data: bytes) -> list[bytes]:
    """Words between ASCII blanks, A-Z lowered."""
    return data.lower().split()


def shingle_digests(data: bytes | None, size: int = SHINGLE) -> list[bytes]:
    words = words_of(data) if data else []
    if not words:
        return []
    if len(words) < size:
        return [xxhash.xxh64_digest(b" ".join(words), SEED)]
    digest, join = xxhash.xxh64_digest, b" ".join
    return [digest(join(run), SEED) for run in zip(*(words[k:] for k in range(size)))]


#: A byte's bits, each in a lane of eight bits of its own; 255 bytes add up without overflow.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def bit_counts(data: bytes) -> np.ndarray:
    """How often each of the 64 bits is set in 8-byte digests, first bit first."""
    digests = np.frombuffer(data, dtype=np.uint8).reshape(-1, 8)
    total = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(digests), COUNTED):
        part = digests[start : start + COUNTED]
        heads = np.arange(0, len(part), 255)
        for k in range(8):
            sums = np.add.reduceat(_LANES[part[:, k]], heads)
            total[8 * k : 8 * k + 8] += sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint_of(data: bytes | None, size: int = SHINGLE) -> int:
    """The signed 64-bit integer with the fingerprint's bits."""
    digests = shingle_digests(data, size)
    if not digests:
        return 0
    majority = 2 * bit_counts(b"".join(digests)) > len(digests)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def whole(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, size) for t in texts], dtype="int64")

    return whole(text.cast("binary"))


def references(count: int = 48) -> np.ndarray:
    """Reference fingerprints: Walsh functions, bit i of number j the parity of i & j.

    Their distances are half of a Walsh transform, so over all 64 of them the squared
    coordinate differences of a pair sum to 64 times its distance.
    """
    i = np.arange(BITS, dtype=np.uint64)
    parity = np.bitwise_count(i[:, None] & i[None, :]) & 1
    rows = np.packbits(parity.astype(np.uint8), axis=1).view(">u8").ravel().astype(np.uint64)
    return rows[1 : 1 + count]


def spanning_links(place: np.ndarray, prints: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Positions (member, earlier member) that span every component within each place.

    ``place`` is sorted. Pairs are taken by their gap in the order; those already in one
    component are skipped, those with a coordinate too far apart discarded.
    """
    n = len(prints)
    table = [np.bitwise_count(prints ^ r).astype(np.int8) for r in references()]
    label = np.arange(n)
    first, gap = np.arange(n), 0
    while True:
        gap += 1
        first = first[first < n - gap]
        first = first[place[first] == place[first + gap]]
        if not len(first):
            break
        a = first[label[first] != label[first + gap]]
        for column in table:
            if not len(a):
                break
            a = a[np.abs(column[a] - column[a + gap]) <= distance]
        a = a[np.bitwise_count(prints[a] ^ prints[a + gap]) <= distance]
        while len(a):
            x, y = label[a], label[a + gap]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
            a = a[label[a] != label[a + gap]]
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _masks(groups: int, spare: int, bits: list[int]) -> list[int]:
    """A mask for each way to leave out ``spare`` of the groups that ``bits`` are split into."""
    parts = [list(p) for p in np.array_split(np.array(bits), groups)]
    return [
        sum(1 << int(b) for part in kept for b in part) for kept in combinations(parts, groups - spare)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def first_masks(count: int, distance: int = DISTANCE) -> list[int]:
    """As few bit groups as keep places small for so many different fingerprints."""
    groups = distance + 1
    while groups < 12 and count / 2 ** (BITS * (groups - distance) // groups) > CROWD:
        groups += 1
    return _masks(groups, distance, list(range(BITS)))


def second_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    others = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | more for more in _masks(12, distance, others)]


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    """(fp, mask, kept): one row per mask."""
    held = F.explode(F.array(*(F.lit(_signed(m)) for m in masks)))
    rows = prints.select("fp", held.alias("mask"))
    return rows.withColumn("kept", F.col("fp").bitwiseAND(F.col("mask")))


def _links(keyed: DataFrame, distance: int) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def ready(rows: pd.DataFrame) -> pd.DataFrame:
            prints = rows["fp"].to_numpy(np.int64).view(np.uint64)
            place = _runs(rows).cumsum()
            member, root = spanning_links(place, prints, distance)
            signed = prints.view(np.int64)
            return pd.DataFrame({"a": signed[member], "b": signed[root]})

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < CHUNK:
                continue
            rows = pd.concat(held, ignore_index=True)
            last = int(np.flatnonzero(_runs(rows))[-1])
            if last:
                yield ready(rows[:last])
            held, size = [rows[last:]], len(rows) - last
        if size:
            yield ready(pd.concat(held, ignore_index=True))

    return (
        keyed.repartition("mask", "kept").sortWithinPartitions("mask", "kept", "fp").mapInPandas(find, "a long, b long")
    )


def _runs(rows: pd.DataFrame) -> np.ndarray:
    """True where a new place begins."""
    mask, kept = rows["mask"].to_numpy(), rows["kept"].to_numpy()
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (mask[1:] != mask[:-1]) | (kept[1:] != kept[:-1])
    return new


def links(prints: DataFrame, distance: int = DISTANCE, place: int = PLACE) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints (column fp, all different) that
    a chain of steps of at most ``distance`` bits connects."""
    count = prints.count()
    masks = first_masks(count, distance)
    keyed = _keyed(prints, masks)
    crowded = keyed.groupBy("mask", "kept").count().filter(F.col("count") > place).select("mask", "kept")
    crowded = settle(crowded, count * len(masks) // place)
    if crowded.isEmpty():
        return _links(keyed, distance)
    calm = keyed.join(crowded, ["mask", "kept"], "left_anti")
    again = [(_signed(m), _signed(n)) for m in masks for n in second_masks(m, distance)]
    finer = prints.sparkSession.createDataFrame(again, "mask long, finer long")
    dealt = (
        keyed.join(crowded, ["mask", "kept"], "left_semi")
        .join(F.broadcast(finer), "mask")
        .select("fp", F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("kept"))
    )
    return _links(calm, distance).unionAll(_links(dealt, distance))


def components(edges: DataFrame, nodes: int | None = None) -> DataFrame:
    """(node, root) of every node of the links, root the component's smallest node.

    ``nodes`` is their number, if it is known.

    Large-star and small-star in turn until the links no longer change; each turn is one
    checkpoint, and a node's neighbours are only ever aggregated, never listed.
    """
    links_now = settle(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), nodes
    )
    before = None
    while True:
        state = links_now.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        both = links_now.unionAll(links_now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links_now = settle(small.unionAll(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), state[0])
    return links_now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        links_now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE, place: int = PLACE
) -> DataFrame:
    """(doc_id, fingerprint, component_id, root) of every row; a fingerprint of the component is its root."""
    rows = settle(docs.select(F.col(key).alias("doc_id"), fingerprint(F.col(text), size).alias("fp")))
    prints = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), rows.count())
    linked = components(links(prints.select("fp"), distance, place), prints.count())
    named = prints.join(linked, prints["fp"] == linked["node"])
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "root").select("fp", "component_id", "root")
    every = prints.join(named, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return rows.join(every, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id", "root")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE, place: int = PLACE
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    return groups(docs, key, text, size, distance, place).drop("root")
