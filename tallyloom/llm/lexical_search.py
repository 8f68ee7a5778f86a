"""Ranked search of all documents for each item of a query table, by dense matrix products.

Terms are runs of ASCII letters and digits and of all signs beyond ASCII; only A to Z are
lowered. With N documents that have a term, L terms in them, n terms in a document and df
documents that hold a term, a term weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))`` and its tf
occurrences in a document have the impact ``10^9 tf div (1000 tf + 20 m)``, where
``m = 50 + (50 n N) div L``. A document's score is the sum of weight times impact over the
different terms of the item.

The items come in blocks of about ``BLOCK_BYTES`` of text. One pass counts df of a block's
vocabulary, the next multiplies tiles: rows of items by compact columns of the vocabulary (only
terms that some document holds), times columns of the vocabulary by the impacts of ``DOCS``
documents, in float64 by BLAS. Impacts stay below 10^6, and a tile's columns are cut where the
weights add up to 2^53 / 10^6, so every partial sum is an exact integer; tiles are added as
64-bit integers. Of each product an item keeps its ``best`` documents: all that reach the
score of the last one kept are compared again with their ids, so ties are never lost. Tasks
hand on ``best`` rows an item at most; they meet in ``MERGE`` groups first, then by item.

Defined cases: a null or empty text has no terms and is never found; an item without known
terms has no rows; repeated documents are found each, repeated items searched each; a null
document id ranks behind others of its score; an empty table on either side gives no rows;
texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BEST = 50
#: Bytes of item texts looked for in one pass over the documents.
BLOCK_BYTES = 1 << 19
#: Rows and columns of a tile of items, documents of a tile, bytes of text read for it at most.
ITEMS, TERMS, DOCS, PORTION = 256, 2_048, 512, 1 << 22
#: Above every impact, and the bound of exact integers in float64.
IMPACT, EXACT = 10**6, 1 << 53
#: Groups in which the tasks' rows meet first.
MERGE = 64
#: A to Z lowered; other ASCII signs than letters and digits are blanks; further bytes as they are.
BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def terms_of(data: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return data.translate(BYTES).split() if data else []


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Block:
    """Items of one pass and their vocabulary; weights come with the statistics."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        self.terms = [sorted({number(t, len(self.vocabulary)) for t in terms_of(body.encode())}) for body in texts]


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Block]:
    """The items in blocks by their hash, each of about BLOCK_BYTES of text."""
    rows = items.select(F.col(key).alias("id"), F.col(text).alias("body")).filter("body is not null")
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(1, -(-size // BLOCK_BYTES))
    for k in range(parts):
        held = rows.filter(F.pmod(F.xxhash64("id", "body"), F.lit(parts)) == k).orderBy("id", "body").collect()
        block = Block([r["id"] for r in held], [r["body"] for r in held])
        if block.vocabulary:
            yield block


def statistics(docs: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and df by term number of the block."""
    vocabulary = block.vocabulary

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with_terms, total, df = 0, 0, np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for body in batch["body"]:
                words = terms_of(body)
                if words:
                    with_terms, total = with_terms + 1, total + len(words)
                    df[list(map(vocabulary.__getitem__, vocabulary.keys() & set(words)))] += 1
        held = np.flatnonzero(df)
        yield pd.DataFrame({"term": [-2, -1, *held.tolist()], "n": [with_terms, total, *df[held].tolist()]})

    counted = docs.select("body").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = {r["term"]: r["n"] for r in counted.collect()}  # one row per term of the block at most
    df = np.array([sums.get(k, 0) for k in range(len(vocabulary))], dtype=np.int64)
    return sums.get(-2, 0), sums.get(-1, 0), df


class Tiles:
    """Weights of a block as dense tiles of ITEMS rows and exact columns."""

    def __init__(self, block: Block, weights: np.ndarray):
        self.items = len(block.terms)
        self.tiles: list[tuple[int, np.ndarray, np.ndarray]] = []  # first item, terms, weights of items by terms
        for first in range(0, self.items, ITEMS):
            rows = block.terms[first : first + ITEMS]
            used = np.array(sorted({t for terms in rows for t in terms if weights[t] > 0}), dtype=np.int64)
            for columns in exact_columns(used, weights):
                place = {t: k for k, t in enumerate(columns.tolist())}
                dense = np.zeros((len(rows), len(columns)))
                for k, terms in enumerate(rows):
                    mine = [t for t in terms if t in place]
                    dense[k, [place[t] for t in mine]] = weights[mine]
                self.tiles.append((first, columns, dense))

    def scores(self, tf: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Items by documents; the entries are (doc, term, impact), tf the number of documents."""
        total = np.zeros((self.items, tf), dtype=np.int64)
        for first, columns, dense in self.tiles:
            at = np.searchsorted(columns, term).clip(max=len(columns) - 1)
            mine = columns[at] == term
            tile = np.zeros((len(columns), tf))
            tile[at[mine], doc[mine]] = impact[mine]
            total[first : first + len(dense)] += (dense @ tile).astype(np.int64)
        return total


def exact_columns(terms: np.ndarray, weights: np.ndarray, width: int = TERMS) -> list[np.ndarray]:
    """Terms in runs whose weighted impacts cannot add up to 2^53."""
    runs, run, total = [], [], 0
    for t in terms.tolist():
        if run and (len(run) == width or (total + int(weights[t])) * IMPACT >= EXACT):
            runs.append(np.array(run))
            run, total = [], 0
        run.append(t)
        total += int(weights[t])
    return [*runs, np.array(run)] if run else runs


class Best:
    """Each item's best documents so far, by score, then by id (null ids last)."""

    def __init__(self, items: int, best: int):
        self.best = best
        self.least = np.ones(items, dtype=np.int64)  # a score must be above 0
        none = np.zeros(0, dtype=np.int64)
        self.kept = [(none, none, none) for _ in range(items)]  # scores, missing ids, ids

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        reach = scores >= self.least[:, None]
        for item in np.flatnonzero(reach.any(axis=1)):
            new = np.flatnonzero(reach[item])
            score = np.concatenate([self.kept[item][0], scores[item, new]])
            gone = np.concatenate([self.kept[item][1], missing[new]])
            name = np.concatenate([self.kept[item][2], ids[new]])
            first = np.lexsort((name, gone, -score))[: self.best]
            self.kept[item] = score[first], gone[first], name[first]
            if len(first) == self.best:
                self.least[item] = score[first[-1]]

    def rows(self, keys: list) -> pd.DataFrame:
        sizes = [len(score) for score, _, _ in self.kept]
        score, gone, name = (np.concatenate(part) for part in zip(*self.kept))
        ids = pd.array(name, dtype="Int64")
        ids[gone == 1] = pd.NA
        item = np.repeat(np.arange(len(sizes)), sizes)
        return pd.DataFrame({"item": item, "key": pd.Series([keys[k] for k in item], dtype=object), "doc_id": ids, "score": score})


def _tiles_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """(ids, terms) of documents with terms, DOCS at most and about PORTION bytes at a time."""
    ids, words, size = [], [], 0
    for batch in batches:
        for name, body in zip(batch["id"], batch["body"]):
            found = terms_of(body)
            if found:
                ids.append(name)
                words.append(found)
                size += len(body)
            if len(ids) == DOCS or size >= PORTION:
                yield ids, words
                ids, words, size = [], [], 0
    if ids:
        yield ids, words


def search_block(docs: DataFrame, block: Block, best: int, kind: str) -> DataFrame:
    """(item number, its key, doc_id, score): every task's best rows."""
    with_terms, total, df = statistics(docs, block)
    weights = np.array([term_weight(with_terms, n) if n else 0 for n in df.tolist()], dtype=np.int64)
    vocabulary = block.vocabulary

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles, kept, size = Tiles(block, weights), Best(len(block.terms), best), len(vocabulary)
        for names, words in _tiles_of(batches):
            sizes = [len(w) for w in words]
            numbers = np.concatenate([np.fromiter(map(vocabulary.get, w, repeat(-1)), dtype=np.int64, count=len(w)) for w in words])
            pair = (np.repeat(np.arange(len(words)), sizes) * size + numbers)[numbers >= 0]
            pair, tf = np.unique(pair, return_counts=True)
            doc, term = np.divmod(pair, size)
            # The product 50 n N may pass 64 bits, so it is taken in Python's integers.
            m = np.array([50 + 50 * n * with_terms // total for n in sizes], dtype=np.int64)
            impact = (10**9 * tf) // (1000 * tf + 20 * m[doc])
            missing = np.array([pd.isna(name) for name in names], dtype=np.int64)
            ids = np.array([0 if gone else int(name) for name, gone in zip(names, missing)], dtype=np.int64)
            kept.add(tiles.scores(len(words), doc, term, impact), ids, missing)
        yield kept.rows(block.ids)

    return docs.mapInPandas(multiply, f"item int, key {kind}, doc_id long, score long")


def best_of(rows: DataFrame, best: int, *by: str) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", best: int = BEST
) -> DataFrame:
    """(item key, rank, doc_id, score): each item's best documents with a score above 0."""
    kind = items.schema[item_key].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"`{item_key}` {kind}, rank int, doc_id long, score long")
    bodies = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("body"))
    for block in item_blocks(items, item_key, item_text):
        rows = search_block(bodies, block, best, kind).withColumn("part", F.spark_partition_id() % MERGE)
        ranked = best_of(best_of(rows, best, "item", "part"), best, "item")
        found = found.unionAll(ranked.select(F.col("key").alias(item_key), "rank", "doc_id", "score"))
    return found
