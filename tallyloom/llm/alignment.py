"""Alignment of two tokenizers' tokens over whole texts, and how often token pairs are linked.

A text is encoded by a byte-level tokenizer (A, of a blank and the text) and by a piece
tokenizer (B, which adds the blank itself). Offsets where tokens of both end cut the text into
groups; all A-B pairs of a group are links.

Both encodings are taken of the whole text first. Then the text is split at anchors: offsets
where tokens of both sides begin with a blank, verified as common ends by the running
lengths of the tokens. The windows between anchors are short runs of ids that come again and
again, so a window's groups and links are found once and remembered by its ids (``REMEMBERED``
bytes, windows seen twice, no longer than ``LONGEST`` ids; any other is aligned anew).

Corpus counts (in how many documents a pair is linked) are one aggregate over each document's
different pairs. Pairs that are in most documents would make a join of documents with counts
lean on few keys, so the ``FREQUENT`` most common ones at most go to the tasks as a sorted
table, and only the rest, each with a small share of the rows, is joined by shuffle.

Defined cases: a null or empty text, and one whose tokens do not spell the blank and the text
(signs that B's model rewrites), has no tokens: counts are 0 and the groups empty; strings of
special tokens are plain text; repeated rows count as documents each; null ids are kept; an
empty table gives an empty result; texts of any length are read whole; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import drop_folder, settle, work_folder, worker_store
from tallyloom.llm.encoding import _byte_letters, tokenizer_path

BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Fixed value: how the byte-level tokenizer cuts a text before it merges bytes.
CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same cuts in a plainly spaced text, without looking ahead.
PLAIN_CUTS = CUTS.replace(r"|\s+(?!\S)|\s+", r"|\s")
#: Pieces do not go on over a blank that follows another sign.
PIECE_CUTS = " [^ ]*"
#: Signs without a blank, or blanks, from which the slower but steady encoder is used.
LONG_RUN = 400
#: Bytes of windows that a worker remembers, the most ids of one, and what an entry takes beside them.
REMEMBERED, LONGEST, ENTRY = 112 << 20, 64, 270
#: Links of a group that are listed one by one.
MANY_LINKS = 1_024
SEEN_MASK = (1 << 21) - 1
#: Pairs sent to tasks with their counts (17 bytes each).
FREQUENT = 1 << 18
#: Bytes of text aligned at a time, and rows that a task may number.
PORTION, TASK_ROWS = 1 << 20, 1 << 36
SPACE = "▁"
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<long>, times array<long>"


class ByteTokens:
    """A: ids of a text, and the bytes of every id."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        byte = {letter: b for b, letter in _byte_letters().items()}
        special = {t["id"] for t in whole["added_tokens"]}
        self.path, self.steady = path, None
        self.spelt = [b""] * (1 + max([*model["vocab"].values(), *special]))
        for token, number in model["vocab"].items():
            if number not in special:
                self.spelt[number] = bytes(byte[letter] for letter in token)
        # Merging by rank gives the same ids where ranks and numbers are in one order.
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][left + right] for left, right in merges]
        self.quick = self.plain = None
        if made == sorted(made) and len(set(made)) == len(made) and (not made or made[0] >= 256):
            ranks = {spelt: number for number, spelt in enumerate(self.spelt) if spelt}
            self.quick, self.plain = (
                tiktoken.Encoding("bytes", pat_str=cuts, mergeable_ranks=ranks, special_tokens={}) for cuts in (CUTS, PLAIN_CUTS)
            )

    def __call__(self, text: str, spaced: tuple[bool, bool] | None = None) -> list[int]:
        """``spaced`` is that of the text, or of the text without one blank before it."""
        long_run, plain = spaced or spacing(text)
        if self.quick and not long_run:
            return (self.plain if plain else self.quick).encode_ordinary(text)
        if self.steady is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.steady = Tokenizer.from_file(self.path)
            self.steady.encode_special_tokens = True
        return self.steady.encode(text, add_special_tokens=False).ids


def spacing(text: str) -> tuple[bool, bool]:
    """Has the text long runs, and is it plainly spaced: by single blanks of any kind or two line ends, inside only?"""
    sizes = list(map(len, text.split()))
    more = len(text) - sum(sizes) - len(sizes)
    # A blank at an end, or any more in a run, counts here; two line ends count once on both sides.
    return more > LONG_RUN or max(sizes, default=0) > LONG_RUN, more + 1 == text.count("\n\n")


class PieceTokens:
    """B: ids of a text (none if they do not spell the blank and the text), and the bytes of every id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.path, self.model = path, SentencePieceProcessor(model_file=path)
        self.spelt = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            self.spelt.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(number) else piece.replace(SPACE, " ").encode())

    def __call__(self, text: str, spaced: tuple[bool, bool] | None = None) -> list[int]:
        long_run, plain = spaced or spacing(text)
        # The quick encoder spells whatever it reads.
        if self.quick and plain and not long_run and SPACE not in text:
            encoding, one, parts = self.quick
            ranks = encoding.encode_ordinary(" " + text)
            ids = list(map(one.__getitem__, ranks))
            return ids if -1 not in ids else list(chain.from_iterable(map(parts.__getitem__, ranks)))
        ids = self.model.encode(text)
        return ids if b"".join(map(self.spelt.__getitem__, ids)) == f" {text}".encode() else []

    @cached_property
    def quick(self):
        """An encoder by rank, and by rank the id (-1: several) and all ids; None if the model is not of the kind it copies.

        Bytes become signs first, by ranks below those of all pieces; then pieces merge in order of their
        scores, as in the model. What a sign not in the vocabulary begins with becomes its bytes' ids.
        """
        import tiktoken

        try:
            from sentencepiece import sentencepiece_model_pb2 as layout
        except ImportError:  # without protobuf
            return None
        with open(self.path, "rb") as file:
            whole = layout.ModelProto.FromString(file.read())
        kind, rules, types = whole.trainer_spec, whole.normalizer_spec, layout.ModelProto.SentencePiece
        if kind.model_type != kind.BPE or not kind.byte_fallback or kind.treat_whitespace_as_suffix:
            return None
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces):
            return None
        if any(p.type in (types.USER_DEFINED, types.UNUSED) for p in whole.pieces):
            return None
        byte = {self.spelt[number]: number for number, p in enumerate(whole.pieces) if p.type == types.BYTE}
        # Runs of blanks are left to the model.
        normal = {number: p for number, p in enumerate(whole.pieces) if p.type == types.NORMAL and (p.piece == SPACE or p.piece.strip(SPACE))}
        merged = sorted((number for number, p in normal.items() if len(p.piece) > 1), key=lambda number: -normal[number].score)
        if any(normal[a].score == normal[b].score for a, b in pairwise(merged)) or any(SPACE in p.piece.lstrip(SPACE) for p in normal.values()):
            return None
        # A chunk that is a piece is taken whole, so it must be the model's choice too.
        if any(self.model.encode(p.piece[1:]) != [n] for n, p in normal.items() if p.piece[:1] == SPACE != p.piece):
            return None
        signs = {self.spelt[n]: n for n, p in normal.items() if len(p.piece) == 1}
        parts = {key: (number,) for key, number in byte.items()}
        for sign, number in signs.items():
            for k in range(2, len(sign)):
                parts[sign[:k]] = tuple(byte[sign[i : i + 1]] for i in range(k))
            parts[sign] = (number,)
        parts |= {self.spelt[number]: (number,) for number in merged}
        ranks = {key: rank for rank, key in enumerate(parts)}
        one = [ids[0] if len(ids) == 1 else -1 for ids in parts.values()]
        return tiktoken.Encoding("pieces", pat_str=PIECE_CUTS, mergeable_ranks=ranks, special_tokens={}), one, list(parts.values())


def align(a: list[int], b: list[int], a_size: list[int], b_size: list[int]) -> list[tuple[list[int], list[int]]]:
    """Groups of two token runs that spell the same bytes."""
    groups, i, j, first_i, first_j = [], 0, 0, 0, 0
    a_end, b_end = a_size[a[0]], b_size[b[0]]
    while True:
        if a_end == b_end:
            groups.append((a[first_i : i + 1], b[first_j : j + 1]))
            i, j = i + 1, j + 1
            if i == len(a):
                return groups
            first_i, first_j = i, j
            a_end, b_end = a_end + a_size[a[i]], b_end + b_size[b[j]]
        elif a_end < b_end:
            i += 1
            a_end += a_size[a[i]]
        else:
            j += 1
            b_end += b_size[b[j]]


class Aligner:
    """Both tokenizers, and the windows remembered by their ids."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokens(a_path), PieceTokens(b_path)
        self.a_size, self.b_size = ([len(s) for s in t.spelt] for t in (self.a, self.b))
        self.a_sizes, self.b_sizes = np.array(self.a_size), np.array(self.b_size)
        self.a_blank, self.b_blank = (np.array([s[:1] == b" " for s in t.spelt]) for t in (self.a, self.b))
        self.kind = np.dtype(np.uint16 if max(len(self.a_size), len(self.b_size)) < 0xFFFF else np.uint32)
        self.mark = int(np.iinfo(self.kind).max)
        self.signs = [f"{number}{sign}" for number in range(max(len(self.a_size), len(self.b_size))) for sign in ",|;"]
        self.windows: dict[bytes, tuple[str, bytes]] = {}
        self.seen, self.bytes = bytearray(SEEN_MASK + 1), 0

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both; none if they do not spell the blank and the text."""
        if text:
            spaced = spacing(text)
            # A merges bytes and nothing else, so its tokens always spell the text.
            if b := self.b(text, spaced):
                return self.a(" " + text, spaced), b
        return [], []

    def align(self, key: bytes) -> list[tuple[list[int], list[int]]]:
        ids = memoryview(key).cast(self.kind.char).tolist()
        cut = ids.index(self.mark)
        return align(ids[:cut], ids[cut + 1 :], self.a_size, self.b_size)

    def align_all(self, keys: list[bytes]) -> list[tuple[str, bytes]]:
        """For each window (groups as text, codes of the linked pairs, each as often as it is linked).

        All windows are aligned together: a window's tokens spell as many bytes on both sides, so
        running lengths go on from one to the next. Both are empty where a group has too many
        links to list.
        """
        ids = np.frombuffer(b"".join(keys), dtype=self.kind).astype(np.int64)
        size = np.array([len(k) for k in keys]) // self.kind.itemsize
        window, mark = np.repeat(np.arange(len(keys)), size), np.flatnonzero(ids == self.mark)
        in_a = np.arange(len(ids)) < mark[window]
        in_b = ~in_a
        in_b[mark] = False
        a, b = ids[in_a], ids[in_b]
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        at = np.searchsorted(b_end, a_end).clip(max=len(b) - 1)
        a_last = b_end[at] == a_end  # of its group
        b_last = np.zeros(len(b), dtype=bool)
        b_last[at[a_last]] = True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        many_a, many_b = np.bincount(a_group), np.bincount(b_group)
        first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        # Tokens in order of their groups, each with the sign behind it.
        shown = np.empty(len(a) + len(b), dtype=np.int64)
        shown[np.arange(len(a)) + first_b[a_group]] = 3 * a + a_last
        shown[np.arange(len(b)) + (first_a + many_a)[b_group]] = 3 * b + 2 * b_last
        signs = list(map(self.signs.__getitem__, shown.tolist()))
        # Every token of A with every token of B in its group.
        a_window = window[in_a]
        large = np.zeros(len(keys), dtype=bool)
        large[a_window[(many_a * many_b > MANY_LINKS)[a_group]]] = True
        linked = np.where(large[a_window], 0, many_b[a_group])
        left = np.repeat(np.arange(len(a)), linked)
        inner = np.arange(len(left)) - np.repeat(np.cumsum(linked) - linked, linked)
        codes = (a[left] * len(self.b_size) + b[first_b[a_group[left]] + inner]).tobytes()
        text_ends = np.cumsum(size - 1).tolist()
        code_ends = (8 * np.cumsum(np.bincount(a_window, weights=linked, minlength=len(keys)).astype(np.int64))).tolist()
        return [
            ("", b"") if big else ("".join(signs[i:j])[:-1], codes[k:n])
            for big, (i, j), (k, n) in zip(large.tolist(), pairwise([0, *text_ends]), pairwise([0, *code_ends]))
        ]

    def learn(self, texts: list[list[bytes]]) -> dict[bytes, tuple[str, bytes]]:
        """All windows of the texts, each looked up once; new ones seen before are remembered from now on."""
        known = self.windows.get
        table = {key: known(key) for key in set(chain.from_iterable(texts))}
        new = [key for key, found in table.items() if found is None]
        for key, found in zip(new, self.align_all(new) if new else []):
            table[key] = found
            place = hash(key) & SEEN_MASK
            if not self.seen[place]:
                self.seen[place] = 1
            elif len(key) <= LONGEST * self.kind.itemsize and self.bytes < REMEMBERED:
                self.bytes += ENTRY + len(key) + len(found[0]) + len(found[1])
                self.windows[key] = found
        return table

    def links(self, keys: list[bytes], table: dict[bytes, tuple[str, bytes]]) -> tuple[str, np.ndarray, np.ndarray]:
        """(groups as text, codes of the different pairs, how often each is linked) of a text."""
        found = [table[key] for key in keys]
        listed = [codes for _, codes in found]
        code, times = np.unique(np.frombuffer(b"".join(listed), dtype=np.int64), return_counts=True)
        if b"" not in listed:
            return ";".join([shown for shown, _ in found]), code, times
        # A group of very many tokens is counted, not listed.
        counts, whole = dict(zip(code.tolist(), times.tolist())), []
        for key, (shown, codes) in zip(keys, found):
            if codes:
                whole.append(shown)
                continue
            for a, b in self.align(key):
                whole.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
                in_b = Counter(b)
                for left, n in Counter(a).items():
                    for right, m in in_b.items():
                        at = left * len(self.b_size) + right
                        counts[at] = counts.get(at, 0) + n * m
        order = sorted(counts)
        return ";".join(whole), np.array(order), np.array([counts[c] for c in order])

    def cut(self, texts: list[tuple[list[int], list[int]]]) -> list[list[bytes]]:
        """The window keys of each text; texts have tokens."""
        sizes = [[len(t[side]) for t in texts] for side in (0, 1)]
        a, b = (np.fromiter(chain.from_iterable(t[side] for t in texts), np.int64, sum(sizes[side])) for side in (0, 1))
        a_start, b_start = np.cumsum(self.a_sizes[a]) - self.a_sizes[a], np.cumsum(self.b_sizes[b]) - self.b_sizes[b]
        first_a, first_b = (np.cumsum([0, *s[:-1]]) for s in sizes)
        # A text's begin is an anchor whatever stands there.
        in_a, in_b = self.a_blank[a], self.b_blank[b]
        in_a[first_a] = in_b[first_b] = True
        in_a, in_b = np.flatnonzero(in_a), np.flatnonzero(in_b)
        at = np.searchsorted(b_start[in_b], a_start[in_a]).clip(max=len(in_b) - 1)
        verified = b_start[in_b[at]] == a_start[in_a]
        in_a, in_b = np.append(in_a[verified], len(a)), np.append(in_b[at[verified]], len(b))
        # A window's ids of A, a mark, its ids of B, and so on, in one array.
        many = len(in_a) - 1
        turn = np.arange(many)
        laid = np.empty(len(a) + len(b) + many, dtype=self.kind)
        laid[np.arange(len(a)) + np.repeat(in_b[:-1] + turn, np.diff(in_a))] = a
        laid[in_a[1:] + in_b[:-1] + turn] = self.mark
        laid[np.arange(len(b)) + np.repeat(in_a[1:] + turn + 1, np.diff(in_b))] = b
        edges = ((in_a + in_b + np.arange(many + 1)) * laid.itemsize).tolist()
        whole = laid.tobytes()
        keys = [whole[i:j] for i, j in pairwise(edges)]
        ends = [*np.searchsorted(in_a, first_a).tolist(), many]
        return [keys[i:j] for i, j in pairwise(ends)]


def _aligner(a_path: str, b_path: str) -> Aligner:
    store, key = worker_store(), ("aligner", a_path, b_path)
    if key not in store:
        store[key] = Aligner(a_path, b_path)
    return store[key]


def align_documents(docs: DataFrame, key: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """ALIGNED rows; ``row`` tells equal ids apart, codes are the different pairs linked."""

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, row = _aligner(a_path, b_path), TaskContext.get().partitionId() * TASK_ROWS
        for ids, bodies in (part for batch in batches for part in _portions(batch)):
            encoded = [aligner.encode(body) for body in bodies]
            cut = aligner.cut([e for e in encoded if e[0]]) if any(e[0] for e in encoded) else []
            table, keys, rows = aligner.learn(cut), iter(cut), []
            for name, (a, b) in zip(ids, encoded):
                shown, code, linked = aligner.links(next(keys) if a else [], table)
                digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
                rows.append((row, None if pd.isna(name) else int(name), len(a), len(b), shown.count("|"), int(linked.sum()), digest, code, linked))
                row += 1
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in ALIGNED.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("body")).mapInPandas(aligned, ALIGNED)


def _portions(batch: pd.DataFrame) -> Iterator[tuple[list, list]]:
    ids, bodies, size = [], [], 0
    for name, body in zip(batch["id"], batch["body"]):
        ids.append(name)
        bodies.append(body)
        size += len(body or "")
        if size >= PORTION:
            yield ids, bodies
            ids, bodies, size = [], [], 0
    if ids:
        yield ids, bodies


def pair_counts(aligned: DataFrame, b_tokens: int) -> DataFrame:
    """(code, documents, best): best if no other pair of the A id is in more documents."""
    counts = settle(aligned.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("documents")))
    of_a = F.expr(f"code div {b_tokens}")
    # One row per id of A at most.
    most = F.broadcast(counts.groupBy(of_a.alias("a")).agg(F.max("documents").alias("most")))
    return counts.join(most, of_a == F.col("a")).select("code", "documents", (F.col("documents") == F.col("most")).alias("best"))


def least_frequent(counts: DataFrame, frequent: int) -> int:
    """The smallest power of two that at most ``frequent`` pairs' counts reach."""
    power = F.length(F.bin("documents")) - 1
    sizes = {r["power"]: r["n"] for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, least = 0, max(sizes, default=0) + 1
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > frequent:
            break
        least = k
    return 0 if sizes and least == min(sizes) else 2**least


def with_counts(aligned: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """ALIGNED rows with n_best and count_sum instead of the pairs."""
    least = least_frequent(counts, frequent)
    known = counts.filter(F.col("documents") >= least).toPandas().sort_values("code")  # ``frequent`` rows at most
    code, documents, best = (known[c].to_numpy() for c in ("code", "documents", "best"))

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = np.array([len(c) for c in batch["codes"]], dtype=np.int64)
            codes, times = (np.concatenate([np.zeros(0, dtype=np.int64), *batch[c]]).astype(np.int64) for c in ("codes", "times"))
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(code, codes).clip(max=max(0, len(code) - 1))
            held = code[at] == codes if len(code) else np.zeros(len(codes), dtype=bool)
            sums, bests = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
            np.add.at(sums, row[held], times[held] * documents[at[held]])
            np.add.at(bests, row[held], times[held] * best[at[held]])
            ends = np.cumsum(np.bincount(row[~held], minlength=len(sizes)))[:-1]
            out = batch.drop(columns=["codes", "times"])
            yield out.assign(n_best=bests, count_sum=sums, codes=np.split(codes[~held], ends), times=np.split(times[~held], ends))

    kinds = ALIGNED.replace("codes", "n_best long, count_sum long, codes")
    rows = settle(aligned.mapInPandas(summed, kinds))
    if not least:
        return rows.drop("codes", "times")
    rare = rows.select("row", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("row", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    more = (
        rare.join(counts.filter(F.col("documents") < least), "code")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("documents")).alias("more"), F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"))
    )
    return (
        rows.join(more, "row", "left")
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        .drop("codes", "times", "more", "more_best")
    )


def alignments(
    docs: DataFrame, key: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None, frequent: int = FREQUENT
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    spark = docs.sparkSession
    a_path, b_path = a_path or tokenizer_path(BYTE_TOKENIZER), b_path or tokenizer_path(PIECE_TOKENIZER)
    folder = work_folder(spark, "alignment")
    try:
        align_documents(docs, key, text, a_path, b_path).write.parquet(folder)
        aligned = spark.read.parquet(folder)
        counts = settle(pair_counts(aligned, len(PieceTokens(b_path).spelt)))
        done = settle(with_counts(aligned, counts, frequent))
    finally:
        drop_folder(spark, folder)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
