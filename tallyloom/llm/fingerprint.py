"""Merkle trees over a document's sections and paragraphs.

A paragraph is a line with its line end, a leaf a phrase of a paragraph with the punctuation
and blanks behind it. A phrase of more than 160 characters is cut where a hash of the last four
says so, so that the cuts move along with the text whatever its script is. A section ends behind a blank line,
before a line that begins with ``#``, and behind a paragraph whose digest is divisible by
16, so that texts without marks have sections too and an edit changes only its own. Leaves
cover the whole text: equal roots mean equal texts. A fingerprint is the root and, section by
section, the leaves' digests with their sizes, so two fingerprints alone tell how alike their
texts are, by the characters of the leaves they share, and where an edit begins.

Defined cases: a null text counts as empty; two empty texts are alike by 1, an empty and
another by 0; very long texts only make more leaves; equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks that end a phrase, in the scripts that have some.
MARKS = ".,;:!?。、，；：！？…؟،؛।॥။།"
PHRASE = re.compile(f"[^{MARKS}]*[{MARKS}]*\\s*")
#: Characters of a phrase that is not cut, of the shortest and the longest piece of one that is.
WHOLE, SHORTEST, LONGEST = 160, 16, 1_024
#: Factors of the last four characters, and of their sum; a cut where its first six bits are 0.
FACTORS, MIX, TURN = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F), 0x9E3779B97F4A7C15, 58
#: Bytes of a leaf's digest in a fingerprint.
SHORT = 6
#: Documents of one stretch of the order in which neighbours are compared, and the stretches
#: beyond which they rather grow: their bounds are the only thing the driver holds.
STRETCH, MOST_STRETCHES = 10_000, 50_000
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, sections long, paragraphs long, leaves long, edit_at long"
)


def _hash(kind: bytes, data: bytes) -> bytes:
    return hashlib.blake2b(kind + data, digest_size=16).digest()


def phrases(line: str) -> list[str]:
    """The leaves of a paragraph."""
    return [piece for phrase in PHRASE.findall(line) for piece in (pieces(phrase) if len(phrase) > WHOLE else [phrase]) if piece]


def pieces(phrase: str) -> list[str]:
    codes = np.frombuffer(phrase.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    mixed = sum(codes[3 - k : len(codes) - k] * np.uint64(f) for k, f in enumerate(FACTORS)) * np.uint64(MIX)
    out, start = [], 0
    for end in [*(np.flatnonzero(mixed >> np.uint64(TURN) == 0) + 4).tolist(), len(phrase)]:
        while end - start > LONGEST:
            out.append(phrase[start : start + LONGEST])
            start += LONGEST
        if end - start >= SHORTEST or end == len(phrase):
            out.append(phrase[start:end])
            start = end
    return out


class Tree:
    """sections: [(digest, [(paragraph digest, [(leaf digest, length), ...]), ...]), ...]"""

    def __init__(self, text: str, memo: dict | None = None):
        memo = {} if memo is None else memo
        sections, current = [], []
        for line in text.split("\n") if text else []:
            node = memo.get(line)
            if node is None:
                full = line + "\n"
                leaves = [(_hash(b"l", p.encode()), len(p)) for p in phrases(full)]
                node = memo[line] = (_hash(b"p", b"".join(d for d, _ in leaves)), leaves)
            if current and line.startswith("#"):
                sections.append(current)
                current = []
            current.append(node)
            if not line.strip() or node[0][-1] % 16 == 0:
                sections.append(current)
                current = []
        if current:
            sections.append(current)
        self.sections = [(_hash(b"s", b"".join(d for d, _ in s)), s) for s in sections]
        self.root = _hash(b"r", b"".join(d for d, _ in self.sections)).hex()

    def paragraphs(self) -> list:
        return [p for _, s in self.sections for p in s]

    @cached_property
    def fingerprint(self) -> str:
        """``root:section|section…``, a section being ``digest.size`` of its leaves."""
        shown = ("_".join(f"{d[:SHORT].hex()}.{n:x}" for _, inner in s for d, n in inner) for _, s in self.sections)
        return f"{self.root}:{'|'.join(shown)}"

    @cached_property
    def leaves(self) -> Counter:
        return leaves_of(self.fingerprint)


def leaves_of(fingerprint: str) -> Counter:
    """Characters by leaf, read from a fingerprint."""
    sizes: Counter = Counter()
    for leaf in fingerprint.partition(":")[2].replace("|", "_").split("_"):
        digest, _, size = leaf.partition(".")
        if size:
            sizes[digest] += int(size, 16)
    return sizes


def likeness(a: str, b: str, x: Counter | None = None, y: Counter | None = None) -> float:
    """Of two fingerprints: shared characters of leaves over all characters, twice; 1 for equal ones.

    ``x`` and ``y`` are their leaves, where they have been read before.
    """
    if a == b:
        return 1.0
    x, y = leaves_of(a) if x is None else x, leaves_of(b) if y is None else y
    if len(y) < len(x):
        x, y = y, x
    shared = sum(min(size, y[digest]) for digest, size in x.items() if digest in y)
    return 2.0 * shared / (x.total() + y.total())


def alike(a: Tree, b: Tree) -> float:
    return likeness(a.fingerprint, b.fingerprint, a.leaves, b.leaves)


def edit_start(a: Tree, b: Tree) -> int | None:
    """Where the first leaf that differs begins, found from the root down; None if equal."""
    if a.root == b.root:
        return None
    at = 0
    mine, other = a.sections, b.sections
    for depth in range(3):
        k = 0
        while k < min(len(mine), len(other)) and mine[k][0] == other[k][0]:
            at += _size(mine[k], depth)
            k += 1
        if depth == 2 or k >= min(len(mine), len(other)):
            break
        mine, other = mine[k][1], other[k][1]
    return at


def _size(node, depth: int) -> int:
    if depth == 2:
        return node[1]
    return sum(_size(child, depth + 1) for child in node[1])


def edited(text: str, following: str) -> str:
    """The last third (rounded down) replaced by as much of the following text's beginning."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def in_stretches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(stretch, guest, doc_id, body) in descending order, in one shuffle of the texts.

    Stretch bounds are ids of the table (approximate quantiles, one per ``STRETCH`` rows);
    a stretch begins with its bound, and the rows with that id also go, as guests, to the
    end of the stretch before, so that each row finds its successor in its own stretch.
    The first stretch's guests end the last one. Rows without an id have no successor and
    are spread by content.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    ids = rows.select("doc_id").filter("doc_id is not null")
    total, top = ids.agg(F.count("doc_id"), F.max("doc_id")).first()
    parts = min(MOST_STRETCHES, max(1, -(-total // STRETCH)))
    shares = [k / parts for k in range(1, parts)]
    inner = []
    if shares:
        inner = ids.agg(F.percentile_approx("doc_id", shares, F.lit(max(1000, 20 * parts))).alias("b")).first()["b"]
    bounds = sorted({b for b in inner if b < top} | ({top} if total else set()), reverse=True)
    if not bounds:
        rows = rows.select(F.lit(-1).cast("long").alias("stretch"), F.lit(0).alias("guest"), "doc_id", "body")
    else:
        ascending, last = np.array(sorted(bounds), dtype=np.int64), len(bounds) - 1

        @F.pandas_udf("struct<stretch: long, bound: boolean>")
        def place(ids: pd.Series) -> pd.DataFrame:
            """The stretch whose bound is the smallest one not below the id."""
            at = np.searchsorted(ascending, ids.to_numpy(np.int64), side="left")
            return pd.DataFrame({"stretch": last - at, "bound": ascending[at] == ids.to_numpy(np.int64)})

        # Ids are never null inside the function, whatever stands for the missing ones.
        rows = rows.withColumn("__place", place(F.coalesce("doc_id", F.lit(top))))
        stretch = F.when(
            F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("body"), F.lit(parts))
        ).otherwise(F.col("__place.stretch"))
        before = F.when(F.col("__place.stretch") == 0, F.lit(last)).otherwise(F.col("__place.stretch") - 1)
        own = F.struct(stretch.cast("long").alias("stretch"), F.lit(0).alias("guest"))
        guest = F.struct(before.cast("long").alias("stretch"), F.lit(1).alias("guest"))
        is_bound = F.col("__place.bound") & F.col("doc_id").isNotNull()
        places = F.when(is_bound, F.array(own, guest)).otherwise(F.array(own))
        rows = rows.select(F.explode(places).alias("place"), "doc_id", "body").select("place.*", "doc_id", "body")
    return rows.repartition("stretch").sortWithinPartitions(
        "stretch", "guest", F.col("doc_id").desc(), "body"
    )


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row against the row behind it; keeps one row from batch to batch."""

    def row(mine, tree, after, after_tree):
        changed = edited(mine[3], after)
        memo = {}
        other = Tree(changed, memo)
        parts = tree.paragraphs()
        return (
            mine[2], len(mine[3]), hashlib.sha256(changed.encode()).hexdigest(), tree.fingerprint, other.fingerprint,
            alike(tree, other), alike(tree, after_tree), len(tree.sections), len(parts),
            sum(len(inner) for _, inner in parts), edit_start(tree, other),
        )

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    empty = Tree("")
    waiting = None
    for batch in batches:
        out = []
        for stretch, guest, key, body in batch.itertuples(index=False, name=None):
            tree = Tree(body)
            if waiting is not None:
                mine, mine_tree = waiting
                if mine[0] == stretch and stretch >= 0:
                    out.append(row(mine, mine_tree, body, tree))
                else:
                    out.append(row(mine, mine_tree, "", empty))
            waiting = None if guest else ((stretch, guest, None if pd.isna(key) else int(key), body), tree)
        yield _frame(out, names)
    if waiting is not None:
        yield _frame([row(*waiting, "", empty)], names)


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    for name in ("doc_id", "edit_at"):
        frame[name] = frame[name].astype("Int64")
    return frame


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint, beside that of its edited text and of its successor.

    The successor is the next row in descending order of id (rows of one id by text); behind
    the smallest id comes the greatest. A row without an id has an empty successor.
    """
    return in_stretches(docs, key, text).mapInPandas(_compare, SCHEMA)
