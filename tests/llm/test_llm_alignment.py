import hashlib
import json
import os
import random
import sys
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_tables import no_documents, odd_documents
from tallyloom.llm import alignment
from tallyloom.llm.encoding import tokenizer_path
from tallyloom.llm.queries import QUERIES

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [
    "<|endoftext|> and <s> </s> <unk> <0x41>", "a  b   c\n\n\td", " leading", "trailing ", "don't we'll it's 12345", "你好 世界 🎉 ünïcode é",
    "▁x y", "ﬁne ① ²", "x\x00y", "aaa" * 300 + " " * 900 + "b", "", None, " ", "\n", "Σίσυφος ñandú",
]


@pytest.fixture(scope="module")
def by_hand():
    """The contract, text by text, on the two libraries alone."""
    a_side = Tokenizer.from_file(A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in printable}
    letter |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    names = {i: t for t, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}

    def a_bytes(i):
        return bytes(letter[c] for c in names[i])

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return [], [], []
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        spelt = (" " + text).encode()
        if b"".join(map(a_bytes, a)) != spelt or b"".join(map(b_bytes, b)) != spelt:
            return [], [], []
        ends = []
        for ids, of in ((a, a_bytes), (b, b_bytes)):
            at, side = 0, []
            for i in ids:
                at += len(of(i))
                side.append(at)
            ends.append(side)
        common = sorted(set(ends[0]) & set(ends[1]))
        out = [([], []) for _ in common]
        for side in (0, 1):
            for i, e in zip((a, b)[side], ends[side]):
                out[bisect_left(common, e)][side].append(i)
        return a, b, out

    def rows(docs):
        done = [(k, *groups(t)) for k, t in docs]
        links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, _, _, g in done]
        counts = Counter(pair for held in links for pair in held)
        most = defaultdict(int)
        for (x, _), n in counts.items():
            most[x] = max(most[x], n)
        out = []
        for (k, a, b, g), held in zip(done, links):
            shown = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in g)
            best = sum(n for p, n in held.items() if counts[p] == most[p[0]])
            total = sum(n * counts[p] for p, n in held.items())
            digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
            out.append((k, len(a), len(b), len(g), sum(held.values()), best, total, digest))
        return sorted(out, key=repr)

    return rows


def listed(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_groups_of_many_tokens_are_counted(monkeypatch):
    aligner = alignment.Aligner(A, B)
    for text in ("plain words of a text, 12345 ünïcode 你好 🎉🎉", "ÀÈÌ ☃☃☃"):
        (keys,) = aligner.cut([aligner.encode(text)])
        shown, code, times = aligner.links(keys, aligner.learn([keys]))
        monkeypatch.setattr(alignment, "MANY_LINKS", 1)
        slow = alignment.Aligner(A, B)
        other = slow.links(keys, slow.learn([keys]))
        assert other[0] == shown and other[1].tolist() == code.tolist() and other[2].tolist() == times.tolist()
        monkeypatch.undo()


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 40, 0])
def test_against_brute_force(spark, folder, by_hand, frequent):
    rng = random.Random(4)
    signs = "abcdeé the ing.,'0 1\n ß🎉你\x85 "
    docs = list(enumerate(ODD)) + [(k, "".join(rng.choice(signs) for _ in range(rng.randint(0, 80)))) for k in range(100, 160)]
    docs += [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(25).collect()] + [(None, "the end"), (7, "the end"), (7, "the end")]
    out = alignment.alignments(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), frequent=frequent)
    assert listed(out) == by_hand(docs)


def test_windows_are_remembered_within_their_bytes(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 200_000)
    aligner = alignment.Aligner(A, B)
    texts = [f"word{k} and more of it {'x' * 300}{k}" for k in range(1500)] * 2
    for text in texts:
        (keys,) = aligner.cut([aligner.encode(text)])
        fresh = aligner.learn([keys])
        for key in keys:
            (groups, codes), slow = aligner.windows.get(key) or fresh[key], aligner.align(key)
            assert groups == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in slow)
            assert len(codes) == 8 * sum(len(a) * len(b) for a, b in slow)
    assert 300 < len(aligner.windows) and aligner.bytes < 202_000
    assert max(map(len, aligner.windows)) <= 2 * alignment.LONGEST


def test_a_portion_looks_a_window_up_once():
    """However often a window stands in a portion, the large table is asked once."""

    class Asked(dict):
        times = 0

        def get(self, key):
            self.times += 1
            return super().get(key)

        __getitem__ = None

        def __contains__(self, key):
            self.times += 1
            return super().__contains__(key)

    aligner = alignment.Aligner(A, B)
    cut = aligner.cut([aligner.encode("one two three two one " * 50 + f"last{k}") for k in range(6)])
    want = [aligner.links(keys, aligner.learn(cut)) for keys in cut]
    aligner.windows = Asked(aligner.windows)
    table = aligner.learn(cut)
    got = [aligner.links(keys, table) for keys in cut]
    assert [(s, c.tolist(), t.tolist()) for s, c, t in got] == [(s, c.tolist(), t.tolist()) for s, c, t in want]
    assert aligner.windows.times == len({key for keys in cut for key in keys}) < sum(map(len, cut)) // 5


def test_quick_encoder_equals_the_tokenizer(spark, folder):
    steady = Tokenizer.from_file(A)
    steady.encode_special_tokens = True
    tokens = alignment.ByteTokens(A)
    assert tokens.quick
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()]
    for text in [*ODD, *texts]:
        if text:
            assert tokens(" " + text) == steady.encode(" " + text, add_special_tokens=False).ids


def spaced_and_odd_texts():
    """Plainly spaced texts of words, pieces and signs in and out of the vocabulary, and texts of odd blanks."""
    rng = random.Random(12)
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    pieces = [model.id_to_piece(i).replace("▁", "") for i in range(259, model.get_piece_size())]
    signs = [chr(rng.choice([rng.randrange(33, 0x2500), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x1F300, 0x1FA00)])) for _ in range(400)]
    blanks = ["\n", "\n\n", "\n\n\n", " ", "  ", "\t", "\r", "\x1c", "\x85", "\u3000", "\xa0", "a", "ß", "'s", "1"]
    texts = [t for t in ODD if t] + ["<0x41>\n\n<s> it's", "\x1c a", "one\n" * 900, "a\n\nb c\n\n", "\n\na", "x \n y"]
    texts += [" ".join("".join(rng.choices(of, k=rng.randint(1, 5))) for _ in range(8)) for of in (pieces, signs, pieces + signs) for _ in range(150)]
    return texts + [t for t in ("".join(rng.choices(blanks, k=rng.randint(1, 7))) for _ in range(600)) if t]


def test_quick_pieces_are_those_of_the_model(spark, folder):
    """The encoder by rank is taken, and has the ids of the model itself."""
    tokens = alignment.PieceTokens(B)
    assert tokens.quick
    encode, whole = tokens.model.encode, []
    tokens.model = type("Model", (), {"encode": lambda _, text: whole.append(text) or encode(text)})()
    texts = [*spaced_and_odd_texts(), *(r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect() if r.text)]
    for text in texts:
        want = encode(text)
        spelt = b"".join(tokens.spelt[i] for i in want) == f" {text}".encode()
        assert tokens(text) == (want if spelt else []), text
    assert len(texts) - len(whole) > 450


def test_plain_cuts_are_those_that_look_ahead():
    tokens, plain = alignment.ByteTokens(A), 0
    for text in spaced_and_odd_texts():
        spaced = alignment.spacing(text)
        if not spaced[0]:
            assert tokens(" " + text, spaced) == tokens.quick.encode_ordinary(" " + text), text
            plain += spaced[1]
    assert plain > 450


def test_spacing():
    plain = ["a", "a b", "a\n\nb\nc d", "a\x85b"]
    other = ["", " ", " a", "a ", "a  b", "a\n\n\nb", "a\n b", "a\n\n", "\n\na", "\n\n", "a\n\n\n\nb"]
    assert all(alignment.spacing(t) == (False, True) for t in plain) and all(alignment.spacing(t) == (False, False) for t in other)
    assert alignment.spacing("x" * 401 + " y") == (True, True) and alignment.spacing("x" + " " * 403 + "y")[0]


def test_pieces_of_another_kind_of_model_are_left_to_it(tmp_path):
    """Changed rules of the model, or scores without an order, leave all texts to the model."""
    from sentencepiece import sentencepiece_model_pb2 as layout

    def kept(change):
        whole = layout.ModelProto.FromString(open(B, "rb").read())
        change(whole)
        path = tmp_path / "changed.model"
        path.write_bytes(whole.SerializeToString())
        tokens = alignment.PieceTokens(str(path))
        return tokens.quick is None and tokens("some plain text") == tokens.model.encode("some plain text")

    assert kept(lambda m: setattr(m.trainer_spec, "model_type", m.trainer_spec.UNIGRAM))
    assert kept(lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True))
    assert kept(lambda m: setattr(m.pieces[300], "type", layout.ModelProto.SentencePiece.USER_DEFINED))
    assert kept(lambda m: setattr(m.pieces[300], "score", m.pieces[301].score))


def test_a_group_of_many_tokens_is_not_listed_pair_by_pair():
    a_size, b_size = [3, 1], [2, 1]
    groups = alignment.align([0, 0, 1], [1, 1, 1, 0, 0], a_size, b_size)
    assert groups == [([0], [1, 1, 1]), ([0, 1], [0, 0])]


def test_odd_and_empty_tables(spark, by_hand):
    odd = odd_documents(spark)
    assert listed(alignment.alignments(odd)) == by_hand([(r.doc_id, r.text) for r in odd.collect()])
    assert alignment.alignments(no_documents(spark)).collect() == []


def test_query_has_a_row_per_document(spark, folder):
    rows = QUERIES["op12_alignment"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 < r.n_groups <= min(r.n_a, r.n_b) and r.n_best <= r.n_links <= r.count_sum for r in rows if r.n_a)
