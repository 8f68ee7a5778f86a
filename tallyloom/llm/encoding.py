"""Token ids of whole texts by a public tokenizer file, with the ids of words remembered.

The word tokenizer never joins characters across white space, so ids of a text are the ids
of its blank-separated chunks in order. A chunk's ids are kept as little-endian unsigned
32-bit numbers in one bytes value.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

from tallyloom.llm.common import worker_store

TOKENIZER = "word_bpe_49k.json"
#: Bytes of chunks and words that a worker remembers, and the longest that it does.
REMEMBERED, LONGEST = 48 << 20, 64
#: What an entry takes beside its letters and ids: the heads of two objects and a place in the table.
ENTRY = 130
#: Places of the table that tells chunks seen before, less one.
SEEN_MASK = (1 << 21) - 1
#: Characters that Python takes for blanks and the tokenizer does not.
ODD_BLANKS = re.compile("[\x1c-\x1f]")
#: Letters up to here are lowered one by one and need no normal form.
PLAIN_LETTERS = "ɐ"
ODD_LETTERS = re.compile(f"[{PLAIN_LETTERS}-\U0010ffff]")
#: A full stop or comma that belongs to the mark before it.
MARKS = re.compile(r"(?:[^\w\s]|_)[.,]")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(spare)) for b in range(256)}


class _Chunks(dict):
    """ids by chunk, within REMEMBERED bytes.

    A chunk is kept when it (or, rarely, another in its place of ``seen``) is asked for again, so
    that those seen once take no room; nothing longer than LONGEST is kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.seen = bytearray(SEEN_MASK + 1)
        self.bytes = 0

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, low: str) -> bytes:
        shown = low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode()))
        return _packed([t.id for t in self.tokenizer.model.tokenize(shown)])

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isalpha() and chunk.islower() and (chunk.isascii() or max(chunk) < PLAIN_LETTERS):
            ids = self.word(chunk)
        else:
            core = chunk.rstrip(".,;:!?")
            low = core.lower()
            if low != chunk and low.isalpha() and (low.isascii() or max(low) < PLAIN_LETTERS):
                tail = chunk[len(core) :]
                ids = self[low] + (self[tail] if tail else b"")
            else:
                ids = self.whole(chunk)
        place = hash(chunk) & SEEN_MASK
        if not self.seen[place]:
            self.seen[place] = 1
        elif len(chunk) <= LONGEST and self.bytes < REMEMBERED:
            self.bytes += ENTRY + len(chunk) + len(ids)
            self[chunk] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Encoder:
    """Callable from text to packed ids; what it learned stays with the worker."""

    def __init__(self, path: str):
        store = worker_store()
        if path not in store:
            store[path] = _Chunks(path)
        self.chunks = store[path]

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if ODD_BLANKS.search(text):
            return self.chunks.whole(text)
        if not ODD_LETTERS.search(text):
            # Between a letter or digit and a mark a chunk may be cut, and marks are few.
            low = text.lower()
            text = low if MARKS.search(low) else low.replace(".", " .").replace(",", " ,")
        return b"".join(map(self.chunks.__getitem__, text.split()))
