import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from muster.llm.packing import SEGMENT, ChunkIds, _byte_letters, first_fit, pack_documents, parted, token_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Plain words, some twice. words", None, "", " \n\t ", "it's DON'T 1234 a.b@c.de!! ... 'tis don't",
    "Größe ÉTÉ é İstanbul ΣΣ naïve", "漢字 かな  x y\x1cz\x85w", "😀 x", "<|endoftext|> a<|startoftext|>b",
    "x" * 5000, "word%%% in,### the&&& 's", "long tail " * 900, "Plain words, some twice. words",
]


TOKENIZER = Tokenizer.from_file(PATH)


def whole(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i % 12, t, "x", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, length string, _group long").repartition(3)


def test_pieces_are_the_documents(docs):
    rows = token_pieces(docs, PATH, capacity=64, with_ids=True).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert 0 < r.length == len(r.ids) <= 64
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        found.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(TEXTS[:12]):
        parts, ids = found[i], whole(text)
        starts = sorted({p.start for p in parts})
        assert [x for s in starts for x in next(p.ids for p in parts if p.start == s)] == ids
        assert {p.doc_tokens for p in parts} == {len(ids)}
    assert len(found[0]) == 2  # a repeated row is a document of its own
    assert len({r.piece_no for r in rows}) == len(rows)


def test_sequences(docs):
    rows = pack_documents(docs, PATH, capacity=128, group_items=10).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(empty, PATH).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_is_first_fit_decreasing(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(1, 33, draw.integers(1, 200))
    bins, offsets = first_fit(lengths, 32)
    used = []
    for i in np.argsort(-lengths, kind="stable"):
        b = next((k for k, u in enumerate(used) if u + lengths[i] <= 32), len(used))
        if b == len(used):
            used.append(0)
        assert (bins[i], offsets[i]) == (b, used[b])
        used[b] += lengths[i]


def test_first_fit_of_nothing():
    assert [len(x) for x in first_fit(np.zeros(0, np.int64), 8)] == [0, 0]


def test_a_full_memo_keeps_what_is_met_again():
    """Frequent chunks are tokenized once, however many others fill the memo between; ids stay those of the tokenizer."""
    ids = ChunkIds(PATH, limit=20_000)
    asked = []
    model_ids = ids._model_ids
    ids._model_ids = lambda letters: (asked.append(letters), model_ids(letters))[1]
    letters = "abcdefghij"
    for i in range(400):
        text = f"Frequent {letters[i % 10]}{letters[i // 10 % 10]}{letters[i // 100]}zq, FREQUENT été! İx. ﬁn"
        assert ids.of(text) == np.array(whole(text)[:-1], "<u4").tobytes()
        assert len(ids) + len(ids.earlier) < 300
    assert asked.count("frequent") == 1 and len(asked) > 400


def _same(ids, text):
    assert ids.of(text) == np.array(whole(text)[:-1], "<u4").tobytes(), repr(text)


def test_words_are_tokenized_without_a_memo():
    """Any number of different words is held by no memo, and no word goes to the whole tokenizer."""
    ids = ChunkIds(PATH)
    draw = random.Random(7)
    for _ in range(200):
        _same(ids, " ".join("".join(draw.choices("aehilnorstué", k=draw.randint(1, 14))) for _ in range(50)) + ",*** it's 12.")
    assert len(ids) == 0 and "tokenizer" not in vars(ids)


def test_texts_are_parted_like_the_tokenizer_does():
    ids = ChunkIds(PATH)
    draw = random.Random(3)
    marks = ["'", "'s", "'T", "'re", "'VE", "d", "ll", "m", "Z", "\u00df", "\u00e9", "e\u0301", "\u03a3", "\u0130", "1", "\u00b2", "\u2167", "\u0663", " ", "\n",
             "\x1c", "\x85", "\xa0", "_", ".", ",***", "\u6f22", "\u2019", "\u3000", "\ufb01", "\U0001f600", "\u1c89", "the", "<|endoftext|>"]
    for _ in range(4000):
        _same(ids, "".join(draw.choices(marks, k=draw.randint(0, 12))))
    assert [parted(t) for t in ("e\u0301", "\U0001f600", "\ufb01", "\u1c89")] == [None] * 4
    assert parted("Don't a1")[:-1].split() == ["don", "'t", "a", "1"]


def test_long_texts_go_in_segments():
    ids = ChunkIds(PATH)
    for filler in ("x" * 17, "word", "\U0001f600 na\u00efve"):
        _same(ids, f"{filler}\n" * (3 * SEGMENT // len(filler)))
    _same(ids, "y" * (2 * SEGMENT) + " end")


def test_bytes_of_every_merge_come_about_by_it_alone():
    """So merging by bytes gives the ids of merging by pairs."""
    with open(PATH, encoding="utf-8") as file:
        model = json.load(file)["model"]
    byte = {c: b for b, c in _byte_letters().items()}

    def read(token):
        return bytes(byte[c] for c in token.removesuffix("</w>")) + b" " * token.endswith("</w>")

    ranks = {read(t): i for t, i in model["vocab"].items()}
    assert len(ranks) == len(model["vocab"])
    for number, (left, right) in enumerate(model["merges"], start=512):
        left, right = read(left), read(right)
        assert ranks[left + right] == number
        parts = [bytes([b]) for b in left + right]
        while True:
            rank, at = min((ranks.get(a + b, number), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= number:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        assert parts == [left, right]
