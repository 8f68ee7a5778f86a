"""Passages of a benchmark in documents, found by latent semantic retrieval.

Texts are cut into passages of two adjoining blocks of ``BLOCK`` words. Passages are TF-IDF
vectors over the words of the benchmark; document frequencies count the blocks of all
documents. A randomised SVD, distributed over the passages of all different texts and the
benchmark's own, gives ``RANK`` latent dimensions. In these every passage of every document is
compared by cosine with every passage of the benchmark (given in blocks of items). Places
where ``RUN_SHARE`` of an item's runs of ``RUN`` words stand are candidates too, whatever their
words weigh, so that no word-for-word copy is missed; such places are left out of the document
frequencies, so that an item does not lose its weight by standing in many documents. The
candidates are checked: the longest common subsequence of words between the item and the
words around the passage must hold ``LCS_SHARE`` of the item, and that of the item's answer
(its last sentence) ``ANSWER_SHARE`` of the answer, unless the answer has fewer than
``LEAST_WORDS`` words or the item is there by ``SURE_SHARE``. Replaced, added or left-out words only
lower these shares.

Words are runs of letters and digits, ASCII punctuation aside. A passage whose words weigh
less than ``LEAST_WEIGHT`` of an item's passage is no candidate by cosine, and one too light
for all of them is not projected. The cosine of a match by runs may be any.

Defined cases: a null or empty text holds nothing, an item with fewer than ``LEAST_WORDS``
words is not looked for; repeated documents each get their rows, repeated item ids count as
items of their own; an empty table on either side gives an empty result; texts of any length
are read whole; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import drop_folder, work_folder

BLOCK = 24
RANK, OVERSAMPLE = 160, 16
COSINE = 0.55
LCS_SHARE, ANSWER_SHARE, SURE_SHARE = 0.75, 0.6, 0.9
LEAST_WORDS = 5
LEAST_WEIGHT = 0.4
#: Words of a run, and share of an item's runs that make a place a candidate without a weight.
RUN, RUN_SHARE = 3, 0.2
#: Bits of the table that tells runs of no item, and pairs of runs and items looked at at a time.
RUN_BITS, RUN_PAIRS = 20, 1 << 21
#: A word weighs log((blocks + SMOOTH) / (its blocks + 1)) - COMMON, and nothing below that:
#: words in more than about 2 % of the blocks are as good as stop words.
SMOOTH, COMMON = 10_000, 4.0
#: Different texts of a ``basis_sample``, and items compared in one pass.
SAMPLE_DOCS = 2_000
ITEMS = 2_000
#: Passages compared, and bytes of text cut into words, at a time.
ROWS, PORTION = 8_192, 1 << 21
#: ASCII letters lowered, ASCII punctuation and controls blank, other bytes as they are.
BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def words_of(data: bytes | None) -> list[bytes]:
    """Words of a lowered text in UTF-8."""
    return data.translate(BYTES).split() if data else []


def lowered(text: Column) -> Column:
    """What words_of reads."""
    return F.lower(text).cast("binary")


def portions(bodies, portion: int = PORTION) -> Iterator[list[bytes | None]]:
    """Texts in turn, about ``portion`` bytes at a time."""
    held, size = [], 0
    for body in bodies:
        held.append(body)
        size += len(body or b"")
        if size >= portion:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Texts:
    """Numbered words of many texts, in one array."""

    numbers: np.ndarray
    starts: np.ndarray  # of each text, and the end
    first_block: np.ndarray  # of each text, and the number of blocks

    @classmethod
    def read(cls, bodies, vocabulary: dict[bytes, int]) -> Texts:
        split = [words_of(body) for body in bodies]
        sizes = np.array([len(w) for w in split], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        numbers = np.empty(starts[-1], dtype=np.int32)
        for k, words in enumerate(split):
            numbers[starts[k] : starts[k + 1]] = np.fromiter(map(vocabulary.get, words, repeat(-1)), dtype=np.int32, count=len(words))
        blocks = -(-sizes // BLOCK)
        return cls(numbers, starts, np.concatenate([[0], np.cumsum(blocks)]))

    def entries(self, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(block, word number) of the benchmark's words (with a weight), in order of block."""
        at = np.flatnonzero(self.numbers >= 0)
        if weight is not None:
            at = at[weight[self.numbers[at]] > 0]
        text = np.searchsorted(self.starts, at, side="right") - 1
        block = self.first_block[text] + (at - self.starts[text]) // BLOCK
        return block, self.numbers[at]

    def passages(self) -> np.ndarray:
        """For each block: does the next one belong to the same text?"""
        more = np.ones(self.first_block[-1], dtype=bool)
        ends = self.first_block[1:][np.diff(self.first_block) > 0] - 1
        more[ends] = False
        return more


@dataclass
class Runs:
    """Which items hold a run of RUN words."""

    size: int  # of the vocabulary
    keys: np.ndarray  # of the runs, ascending
    starts: np.ndarray  # of each run's items, and the end
    items: np.ndarray
    known: np.ndarray  # by slot: may a run be there?
    needed: np.ndarray  # runs that make an item's candidate
    span: np.ndarray  # words they stand in

    @classmethod
    def of(cls, items: list[list[int]], size: int) -> Runs:
        sizes = np.array([len(numbers) for numbers in items], dtype=np.int64)
        held = [(k, np.unique(run_keys(np.array(numbers), size))) for k, numbers in enumerate(items) if len(numbers) >= LEAST_WORDS]
        item = np.repeat(np.array([k for k, _ in held], dtype=np.int64), [len(keys) for _, keys in held])
        key = np.concatenate([np.zeros(0, dtype=np.int64), *(keys for _, keys in held)])
        order = np.argsort(key, kind="stable")
        keys, starts = np.unique(key[order], return_index=True)
        known = np.zeros(1 << RUN_BITS, dtype=bool)
        known[run_slots(keys)] = True
        distinct = np.bincount(item, minlength=len(items))
        needed = (RUN_SHARE * distinct).astype(np.int64).clip(1)
        return cls(size, keys, np.append(starts, len(key)), item[order], known, needed, sizes + BLOCK)

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, item, does it begin a candidate?) of the runs that stand close enough together."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
        if len(numbers) >= RUN and len(self.keys):
            key = run_keys(numbers, self.size)
            at = np.flatnonzero(self.known[run_slots(key)])
            for k in range(RUN):
                at = at[numbers[at + k] >= 0]
            run = np.searchsorted(self.keys, key[at]).clip(max=len(self.keys) - 1)
            held = self.keys[run] == key[at]
            at, run = at[held], run[held]
            many = self.starts[run + 1] - self.starts[run]
            turn = (np.cumsum(many) - many) // RUN_PAIRS
            for part in np.unique(turn):
                a, b = np.searchsorted(turn, part), np.searchsorted(turn, part, side="right")
                low = np.searchsorted(at, at[a] - self.span.max())
                high = np.searchsorted(at, at[b - 1] + self.span.max(), side="right")
                word, item, dense, first = self._dense(at[low:high], run[low:high], many[low:high], len(numbers))
                mine = dense & (word >= at[a]) & (word <= at[b - 1])
                found.append((word[mine], item[mine], first[mine]))
        return tuple(np.concatenate(part) for part in zip(*found))

    def _dense(self, at: np.ndarray, run: np.ndarray, many: np.ndarray, count: int):
        word = np.repeat(at, many)
        item = self.items[np.repeat(self.starts[run] - (np.cumsum(many) - many), many) + np.arange(len(word))]
        place = item * (count + int(self.span.max()) + 1) + word
        order = np.argsort(place)
        word, item, place = word[order], item[order], place[order]
        here = np.arange(len(place))
        after = np.searchsorted(place, place + self.span[item]) - here
        before = here + 1 - np.searchsorted(place, place - self.span[item], side="right")
        first = after >= self.needed[item]
        return word, item, first | (before >= self.needed[item]), first


def run_keys(numbers: np.ndarray, size: int) -> np.ndarray:
    """A number for the run that begins at each word."""
    wide = numbers.astype(np.int64)
    key = wide[: len(wide) - RUN + 1]
    for k in range(1, RUN):
        key = key * size + wide[k : len(wide) - RUN + 1 + k]
    return key


def run_slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - RUN_BITS)).astype(np.int64)


@dataclass
class Items:
    """The benchmark's items of one pass: words, masks of positions, passages."""

    ids: list
    texts: list[str]
    vocabulary: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self):
        self.words = [words_of(t.lower().encode()) for t in self.texts]
        self.answers = [answer_of(t) for t in self.texts]
        for words in self.words:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.masks, self.answer_masks = [], []
        for words, answer in zip(self.words, self.answers):
            self.masks.append(positions([self.vocabulary[w] for w in words]))
            self.answer_masks.append(positions([self.vocabulary[w] for w in answer]))
        self.runs = Runs.of([[self.vocabulary[w] for w in words] for words in self.words], len(self.vocabulary))
        # Passages of 2 * BLOCK words, half of one apart, as (item, word numbers).
        self.passage_item, self.passage_words = [], []
        for k, words in enumerate(self.words):
            if len(words) < LEAST_WORDS:
                continue
            numbers = [self.vocabulary[w] for w in words]
            for start in range(0, max(1, len(numbers) - BLOCK), BLOCK):
                self.passage_item.append(k)
                self.passage_words.append(numbers[start : start + 2 * BLOCK])


def answer_of(text: str) -> list[bytes]:
    """Words of the last sentence that has a word."""
    sentences = [words_of(part.lower().encode()) for part in re.split(r"[.?!]\s", text)]
    return next((words for words in reversed(sentences) if words), [])


def positions(numbers: list[int]) -> dict[int, int]:
    """Bit mask of the places where each word number stands."""
    masks: dict[int, int] = {}
    for k, number in enumerate(numbers):
        masks[number] = masks.get(number, 0) | 1 << k
    return masks


def common_subsequence(masks: dict[int, int], size: int, words: np.ndarray) -> int:
    """Length of the longest common subsequence, one integer operation per word."""
    rows = (1 << size) - 1
    v = rows
    for number in words.tolist():
        mask = masks.get(number)
        if mask:
            hit = v & mask
            v = ((v + hit) | (v - hit)) & rows
    return size - v.bit_count()


@dataclass
class Index:
    items: Items
    weight: np.ndarray  # IDF by word number
    basis: np.ndarray  # word number by dimension, times the weight
    queries: np.ndarray  # latent unit vectors of the items' passages
    least: np.ndarray  # squared weight a passage needs to hold so much of each


def block_frequencies(docs: DataFrame, text: str, items: Items) -> tuple[np.ndarray, int]:
    """In how many blocks of all documents each word of the benchmark occurs, and all blocks.

    Words in runs that an item may have brought there do not count.
    """
    vocabulary, size, runs = items.vocabulary, len(items.vocabulary), items.runs

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, found = 0, np.zeros(size, dtype=np.int64)
        for bodies in (part for batch in batches for part in portions(batch["body"])):
            texts = Texts.read(bodies, vocabulary)
            copied = np.unique(runs.places(texts.numbers)[0])
            for k in range(RUN):
                texts.numbers[copied + k] = -1
            block, word = texts.entries()
            pairs = np.sort(block * size + word)
            found += np.bincount(pairs[np.flatnonzero(np.diff(pairs, prepend=-1))] % size, minlength=size)
            total += int(texts.first_block[-1])
        held = np.flatnonzero(found)
        yield pd.DataFrame({"word": [*held.tolist(), -1], "n": [*found[held].tolist(), total]})

    counted = docs.select(lowered(F.col(text)).alias("body")).mapInPandas(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency, total = np.zeros(size, dtype=np.int64), 0
    for row in counted.collect():  # at most one row per word of the items
        if row["word"] < 0:
            total = row["n"]
        else:
            frequency[row["word"]] = row["n"]
    return frequency, total


def weighted_words(docs: DataFrame, text: str, items: Items, weight: np.ndarray) -> DataFrame:
    """One row per different text: its digest and, block by block, its words with a weight (-1 ends a block)."""
    vocabulary = items.vocabulary

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bodies in (part for batch in batches for part in portions(batch["body"])):
            texts = Texts.read(bodies, vocabulary)
            block, word = texts.entries(weight)
            last = np.flatnonzero(np.diff(block, append=-1))
            laid = np.insert(word, last + 1, -1).astype(np.int32)
            # Where each text's words and marks begin.
            entry = np.searchsorted(block, texts.first_block)
            begin = entry + np.searchsorted(last, entry)
            kept = np.flatnonzero(np.diff(begin)).tolist()
            digests = [hashlib.blake2b(bodies[k], digest_size=16).digest() for k in kept]
            yield pd.DataFrame({"digest": digests, "words": [laid[begin[k] : begin[k + 1]].tobytes() for k in kept]})

    return docs.select(lowered(F.col(text)).alias("body")).mapInPandas(read, "digest binary, words binary").distinct()


def latent_basis(words: DataFrame, items: Items, weight: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the weighted passages A, by a randomised range finder.

    Two passes over ``weighted_words``, summed by task: ``A' (A omega)``, then ``(A q)' (A q)``. The
    benchmark's passages, made as heavy together as the documents, are added on the driver.
    """
    size = len(items.vocabulary)
    width = min(size, rank + OVERSAMPLE)
    start = np.random.default_rng(0).standard_normal((size, width)).astype(np.float32)
    passage = np.repeat(np.arange(len(items.passage_words)), [len(w) for w in items.passage_words])
    own = np.concatenate(items.passage_words).astype(np.int64)

    def passed(right: np.ndarray, gram: bool) -> tuple[np.ndarray, float]:
        height = width if gram else size

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((height + 1, width))  # the last row begins with the mass
            for streams in (part for batch in batches for part in portions(batch["words"], PORTION // 16)):
                laid = np.frombuffer(b"".join(streams), dtype=np.int32)
                ends = laid < 0
                block, word = (np.cumsum(ends) - ends)[~ends], laid[~ends].astype(np.int64)
                total[:height] += product(block, word, weight, right, gram)
                total[height, 0] += float((weight[word].astype(np.float64) ** 2).sum())
            yield from as_rows(total)

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((height + 1, width))
            for batch in batches:
                np.add.at(total, batch["row"].to_numpy(), np.frombuffer(b"".join(batch["sums"]), dtype=np.float64).reshape(-1, width))
            yield from as_rows(total)

        def as_rows(total: np.ndarray) -> Iterator[pd.DataFrame]:
            held = np.flatnonzero(total.any(axis=1))
            for part in np.array_split(held, -(-len(held) // ROWS) or 1):
                yield pd.DataFrame({"row": part.astype(np.int32), "sums": [total[k].tobytes() for k in part]})

        # Tasks' sums meet by row, so the driver gets one matrix of words by dimensions.
        kind = "row int, sums binary"
        sums = np.zeros((height + 1, width))
        for part in words.mapInPandas(run, kind).repartition("row").mapInPandas(add, kind).collect():
            sums[part["row"]] += np.frombuffer(part["sums"], dtype=np.float64)
        return sums[:height], float(sums[height, 0])

    total, mass = passed(start, gram=False)
    share = max(mass, 1.0) / max(float((weight[own].astype(np.float64) ** 2).sum()), 1e-9)
    total += share * product(passage, own, weight, start, gram=False)
    q = np.linalg.qr(total)[0].astype(np.float32)
    gram = passed(q, gram=True)[0] + share * product(passage, own, weight, q, gram=True)
    _, turn = np.linalg.eigh(gram)
    return np.ascontiguousarray((q @ turn[:, ::-1][:, :rank]).astype(np.float32))


def product(block: np.ndarray, word: np.ndarray, weight: np.ndarray, right: np.ndarray, gram: bool) -> np.ndarray:
    """For the sparse matrix A of the entries: ``(A right)' (A right)``, or ``A' (A right)``."""
    total = np.zeros((right.shape[1] if gram else len(weight), right.shape[1]))
    if not len(block):
        return total
    head, y = block_sums(block, word, right * weight[:, None])
    if gram:
        return y.T.astype(np.float64) @ y
    row = np.searchsorted(head, block)
    order = np.argsort(word, kind="stable")
    heads = np.flatnonzero(np.diff(word[order], prepend=-1))
    found = word[order[heads]]
    total[found] = added(y, row[order], heads) * weight[found, None]
    return total


def block_sums(block: np.ndarray, word: np.ndarray, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks that have entries (ascending), and each one's sum of rows of ``weighted``."""
    heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    y = np.empty((len(heads), weighted.shape[1]), dtype=np.float32)
    ends = np.append(heads[1:], len(block))
    for a in range(0, len(heads), ROWS // 8):
        b = min(a + ROWS // 8, len(heads))
        y[a:b] = added(weighted, word[heads[a] : ends[b - 1]], heads[a:b] - heads[a])
    return block[heads], y


def added(rows: np.ndarray, index: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of ``rows[index]`` by stretches that begin at ``heads``, all stretches side by side."""
    sizes = np.diff(heads, append=len(index))
    order = np.argsort(-sizes, kind="stable")
    at, sizes = heads[order], sizes[order]
    sums = rows[index[at]]
    for k in range(1, int(sizes[0])):
        longer = np.searchsorted(-sizes, -k)
        sums[:longer] += rows[index[at[:longer] + k]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def basis_sample(docs: DataFrame, text: str) -> DataFrame:
    """About SAMPLE_DOCS different texts, whatever copies they have: for a trial basis, no query takes it."""
    digest = F.xxhash64(F.col(text))
    count = docs.agg(F.approx_count_distinct(digest)).first()[0]
    chosen = docs if count <= SAMPLE_DOCS else docs.filter(digest < int(SAMPLE_DOCS / count * 2**64) - 2**63)
    return chosen.select(lowered(F.col(text)).alias("body")).distinct()


def build_index(docs: DataFrame, items: Items, text: str = "text", rank: int = RANK) -> Index | None:
    if not items.passage_words:
        return None
    frequency, total = block_frequencies(docs, text, items)
    weight = (np.log((total + SMOOTH) / (frequency + 1.0)) - COMMON).clip(0).astype(np.float32)
    spark = docs.sparkSession
    folder = work_folder(spark, "basis")
    try:
        weighted_words(docs, text, items, weight).write.parquet(folder)
        basis = latent_basis(spark.read.parquet(folder), items, weight, rank) * weight[:, None]
    finally:
        drop_folder(spark, folder)
    queries = np.stack([basis[w].sum(axis=0) for w in items.passage_words])
    queries /= np.linalg.norm(queries, axis=1, keepdims=True).clip(1e-9)
    masses = np.array([(weight[w].astype(np.float64) ** 2).sum() for w in items.passage_words])
    return Index(items, weight, basis, queries, LEAST_WEIGHT * masses)


def candidates(texts: Texts, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first block, item, cosine) of all pairs at COSINE or more, and of those that share runs."""
    count = int(texts.first_block[-1])
    word, item, first = index.items.runs.places(texts.numbers)
    text = np.searchsorted(texts.starts, word[first], side="right") - 1
    place = texts.first_block[text] + (word[first] - texts.starts[text]) // BLOCK
    of_items = len(index.items.texts)
    place, shared = np.divmod(np.unique(place * of_items + item[first]), of_items)
    block, word = texts.entries(index.weight)
    mass = np.bincount(block, weights=index.weight[word].astype(np.float64) ** 2, minlength=count).astype(np.float64)
    more = texts.passages()
    both = mass.copy()
    both[:-1] += np.where(more[:-1], mass[1:], 0.0)
    # An item's passage without any weight is found by its runs alone.
    heavy = both >= np.min(index.least, where=index.least > 0, initial=np.inf)
    used = heavy.copy()
    used[place] = True
    used[1:] |= used[:-1] & more[:-1]
    keep = used[block]
    row, y = np.full(count + 1, -1), np.zeros((0, index.queries.shape[1]), dtype=np.float32)
    if keep.any():
        head, y = block_sums(block[keep], word[keep], index.basis)
        row[head] = np.arange(len(head))
    y = np.vstack([y, np.zeros(y.shape[1], dtype=np.float32)])  # row -1

    def latent(first: np.ndarray) -> np.ndarray:
        x = y[row[first]] + y[np.where(more[first], row[first + 1], -1)]
        return x / np.linalg.norm(x, axis=1, keepdims=True).clip(1e-9)

    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    passage_item = np.array(index.items.passage_item)
    heavy = np.flatnonzero(heavy)
    for k in range(0, len(heavy), ROWS):
        first = heavy[k : k + ROWS]
        score = latent(first) @ index.queries.T
        at, query = np.nonzero(score >= COSINE)
        enough = both[first[at]] >= index.least[query]
        at, query = at[enough], query[enough]
        found.append((first[at], passage_item[query], score[at, query]))
    for k in range(0, len(place), ROWS):
        first, item = place[k : k + ROWS], shared[k : k + ROWS]
        x, best = latent(first), np.full(len(first), -1.0)
        query, last = np.searchsorted(passage_item, item), np.searchsorted(passage_item, item, side="right")
        while (left := np.flatnonzero(query < last)).size:
            best[left] = np.maximum(best[left], (x[left] * index.queries[query[left]]).sum(axis=1))
            query[left] += 1
        found.append((first, item, best))
    return tuple(np.concatenate(part) for part in zip(*found))


def contained_items(bodies, index: Index) -> list[list[tuple]]:
    """For every text (position in items, cosine, lcs share, answer share, word offset), checked."""
    texts = Texts.read(bodies, index.items.vocabulary)
    out: list[list[tuple]] = [[] for _ in range(len(texts.starts) - 1)]
    block, item, score = candidates(texts, index)
    if not len(block):
        return out
    items = index.items
    text = np.searchsorted(texts.first_block, block, side="right") - 1
    order = np.lexsort((block, -score, item, text))
    done: set[tuple[int, int]] = set()
    tried: set[tuple[int, int]] = set()
    for k in order.tolist():
        t, i = int(text[k]), int(item[k])
        if (t, i) in done or (int(block[k]), i) in tried:
            continue
        tried.add((int(block[k]), i))
        size = len(items.words[i])
        at = int(block[k] - texts.first_block[t]) * BLOCK
        low = texts.starts[t] + max(0, at - size)
        high = min(texts.starts[t + 1], texts.starts[t] + at + 2 * BLOCK + size)
        words = texts.numbers[low:high]
        words = words[words >= 0]
        share = common_subsequence(items.masks[i], size, words) / size
        if share < LCS_SHARE:
            continue
        wanted = len(items.answers[i])
        answer = common_subsequence(items.answer_masks[i], wanted, words) / wanted
        if answer < ANSWER_SHARE and wanted >= LEAST_WORDS and share < SURE_SHARE:
            continue
        done.add((t, i))
        out[t].append((i, float(score[k]), share, answer, at))
    return out


def in_documents(text: Column, index: Index, id_type: str = "long") -> Column:
    """array(struct(item_id, cosine, lcs_share, answer_share, near_word)) of a text."""
    kind = f"array<struct<item_id: {id_type}, cosine: double, lcs_share: double, answer_share: double, near_word: long>>"

    @F.pandas_udf(kind)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for bodies in portions(batch):
                found += contained_items(bodies, index)
            yield pd.Series([[dict(zip(("item_id", "cosine", "lcs_share", "answer_share", "near_word"), (index.items.ids[r[0]], *r[1:]))) for r in rows] for rows in found])

    return find(lowered(text))


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", items: int = ITEMS) -> Iterator[Items]:
    """The benchmark in blocks of about ``items``, each small enough for every task."""
    rows = benchmark.select(F.col(key).alias("id"), F.col(text).alias("body")).filter("body is not null")
    parts = max(1, -(-rows.count() // items))
    for k in range(parts):
        block = rows.filter(F.pmod(F.xxhash64("id", "body"), F.lit(parts)) == k).orderBy("id", "body").collect()
        if block:
            yield Items([r["id"] for r in block], [r["body"] for r in block])


def with_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", rank: int = RANK, into: str = "matches"
) -> DataFrame:
    """Every document with the array of the items it holds.

    What one block of items found is written, with the documents, before the next one's index
    is built, so that no more than one index is held or sent to tasks.
    """
    spark, id_type = docs.sparkSession, benchmark.schema[item_key].dataType.simpleString()
    searched, landed = False, None
    for items in item_blocks(benchmark, item_key, item_text):
        if not any(len(words) >= LEAST_WORDS for words in items.words):
            continue
        if searched:
            before, landed = landed, work_folder(spark, "matches")
            docs.write.parquet(landed)
            docs = spark.read.parquet(landed)
            if before:
                drop_folder(spark, before)
        index = build_index(docs, items, text, rank)
        found = in_documents(F.col(text), index, id_type)
        docs = docs.withColumn(into, F.concat(into, found) if searched else found)
        searched = True
    kind = f"array<struct<item_id:{id_type},cosine:double,lcs_share:double,answer_share:double,near_word:bigint>>"
    return docs if searched else docs.withColumn(into, F.array().cast(kind))
