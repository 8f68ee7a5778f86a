"""Token sequences of a fixed window, filled by minimum bin slack.

Every task takes its documents in blocks of about ``BLOCK_TOKENS`` tokens and packs each
block on its own, so nothing is shuffled, counted or planned in one place. In a block,
documents give full windows first. For each further window the longest remaining piece is
set, and a subset-sum over the remaining lengths (one bit per reachable sum) picks the
multiset that comes closest to the capacity; its counts are read back from the reachable
sums, and the same window repeats as long as every length lasts. Slack that is left is
filled by cutting the longest other piece. A block's last tokens go to sequences of powers
of two, which need no padding.

Defined cases: a null or empty text is its end id alone; very long texts are cut into
windows; texts of one length, repeated rows and null ids need nothing special; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.encoding import Encoder, tokenizer_path

WINDOW = 2_048
END_ID = 1
#: Tokens packed together: some two thousand windows, 16 MB of ids.
BLOCK_TOKENS = 4_000_000
#: Sequences a task may number.
TASK_SEQUENCES = 1 << 33
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long"
)


def closest_fill(capacity: int, counts: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is the largest up to capacity.

    ``lengths`` is sorted. Multiples are added in powers of two; the steps that reached new
    sums are kept and read backwards.
    """
    reach, full = 1, (1 << (capacity + 1)) - 1
    steps = []
    for k in range(bisect_right(lengths, capacity) - 1, -1, -1):
        length, left, times = lengths[k], min(counts[lengths[k]], capacity // lengths[k]), 1
        while left > 0:
            times = min(times, left)
            after = (reach | reach << (length * times)) & full
            if after != reach:
                steps.append((length, times, reach))
                reach = after
            left -= times
            times *= 2
        if reach >> capacity:
            break
    at = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + times
            at -= length * times
    return taken


def pack(sizes: list[int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (document, start, length, sequence, offset) and the tokens of each sequence."""
    pieces, filled = [], []
    stacks: dict[int, list[tuple[int, int]]] = {}
    for number, size in enumerate(sizes):
        whole = size - size % window
        for start in range(0, whole, window):
            pieces.append((number, start, window, len(filled), 0))
            filled.append(window)
        if size > whole:
            stacks.setdefault(size - whole, []).append((number, whole))
    counts = {length: len(stack) for length, stack in stacks.items()}
    lengths = sorted(counts)

    def take(length: int) -> tuple[int, int]:
        piece = stacks[length].pop()
        counts[length] -= 1
        if not counts[length]:
            del stacks[length], counts[length]
            lengths.remove(length)
        return piece

    def put(length: int, piece: tuple[int, int]) -> None:
        if length not in counts:
            stacks[length], counts[length] = [], 0
            insort(lengths, length)
        stacks[length].append(piece)
        counts[length] += 1

    while lengths:
        longest = lengths[-1]
        rest = window - longest
        counts[longest] -= 1
        chosen = closest_fill(rest, counts, lengths) if rest else {}
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        slack = window - sum(n * times for n, times in chosen.items())
        repeats = 1 if slack else min(counts[n] // times for n, times in chosen.items())
        for _ in range(repeats):
            laid = [(*take(n), n) for n, times in sorted(chosen.items(), reverse=True) for _ in range(times)]
            if slack and lengths:
                cut = lengths[-1]
                number, start = take(cut)
                laid.append((number, start, slack))
                put(cut - slack, (number, start + slack))
            _lay(laid, window, pieces, filled)
    return pieces, filled


def _lay(laid: list[tuple[int, int, int]], window: int, pieces: list, filled: list) -> None:
    """One full sequence, or, at a block's end, sequences of powers of two."""
    left = sum(length for _, _, length in laid)
    room, offset = (window if left == window else 0), 0
    for number, start, length in laid:
        while length:
            if not room:
                room = 1 << (left.bit_length() - 1)
            if not offset:
                filled.append(room)
            part = min(length, room - offset)
            pieces.append((number, start, part, len(filled) - 1, offset))
            start, length, left, offset = start + part, length - part, left - part, offset + part
            if offset == room:
                room = offset = 0


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = WINDOW, block: int = BLOCK_TOKENS
) -> DataFrame:
    """A row per piece; ids of a sequence are its pieces in order of offset."""
    path = path or tokenizer_path()
    end = END_ID.to_bytes(4, "little")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(path)
        number = TaskContext.get().partitionId() * TASK_SEQUENCES
        keys: list = []
        ids: list[bytes] = []
        tokens = 0

        def flush() -> pd.DataFrame:
            nonlocal keys, ids, tokens, number
            sizes = [len(i) // 4 for i in ids]
            pieces, filled = pack(sizes, window)
            rows = [
                (keys[d], start, length, zlib.crc32(ids[d][4 * start : 4 * (start + length)]), sizes[d], number + s, offset, filled[s])
                for d, start, length, s, offset in pieces
            ]
            number += len(filled)
            keys, ids, tokens = [], [], 0
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            return frame

        for batch in batches:
            for name, body in zip(batch["doc_id"], batch["body"]):
                keys.append(None if pd.isna(name) else int(name))
                ids.append(encode(body) + end)
                tokens += len(ids[-1]) // 4
                if tokens >= block:
                    yield flush()
        if ids:
            yield flush()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("body")).mapInPandas(packed, SCHEMA)
