import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from muster.llm import alignment
from muster.llm.alignment import Aligner, align_documents

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, tid string, n int, pairs string, n_a string"


@pytest.fixture(scope="module")
def whole():
    """Tokens of whole texts, as ids and bytes."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, other = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    one.encode_special_tokens = True
    letters = alignment._byte_letters()

    def tokens(text):
        ids = one.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in ids]
        b = []
        for i in other.encode(text):
            p = other.id_to_piece(i)
            b.append((i, bytes([int(p[3:-1], 16)]) if other.is_byte(i) else p.replace("▁", " ").encode()))
        return a, b

    return tokens


def brute(rows, tokens):
    made, holders, best = [], Counter(), defaultdict(int)
    for _, text in rows:
        a, b = tokens(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            made.append(None)
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, start = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, s, f in own if start <= s and f <= e) for own in spans))
            start = e
        links = [(i, j) for i, s, e in spans[0] for j, p, q in spans[1] if s < q and p < e]
        made.append((len(a), len(b), len(ends), links, ";".join(groups)))
        holders.update(set(links))
    for (a, _), n in holders.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), m in zip(rows, made):
        if m is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            counts = [(holders[x], best[x[0]]) for x in m[3]]
            out.append((doc_id, *m[:3], len(m[3]), sum(n == top for n, top in counts), sum(n for n, _ in counts), hashlib.sha256(m[4].encode()).hexdigest()))
    return out


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a\nb \n c", "a  b", "tab\tand\x0b \x1c x", "<|endoftext|> <s></s><unk> <0x41>", "one▁two", "don't we've I'LL",
       "zażółć gęślą 你好 世界 ไทย", "🙂🙂 🙂", "\x00 nul", "é ́x", "x" * 300, "12 345678 9", "a" * 70 + " b", "ab　cd ef", "﻿bom x", "  a"]


def key(t):
    return (t[0] is not None, t)


@pytest.mark.parametrize("listed", [0, 40, 1 << 20])
def test_against_brute_force(spark, whole, listed):
    draw = random.Random(listed)
    words = ["the", "The", "tokenization", "naïve", "über", "42", "don't", ",", "a.b", "Zürich", "\n", "", "x" * 80, "mañana"]
    texts = ODD + [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(40)]
    rows = [(draw.randint(0, 30) if i % 5 else None, t) for i, t in enumerate(texts * 2 + texts[:30] + ["the same"] * 50)]
    docs = spark.createDataFrame([(i, t, "t", 1, "p", "q") for i, t in rows], SCHEMA).repartition(5)
    got = align_documents(docs, *PATHS, listed=listed)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda t: (t[0] is not None, t[0] or 0, t[1:])) == sorted(brute(rows, whole), key=lambda t: (t[0] is not None, t[0] or 0, t[1:]))


def test_texts_are_tokenized_as_the_libraries_do(whole):
    aligner, draw = Aligner(*PATHS), random.Random(1)
    alphabet = "aB'é ▁\n\t .0中 s<|>"
    texts = [t for t in ODD if t] + ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 30))) for _ in range(3000)]
    codes = [c for c in draw.sample(range(0x110000), 4000) if not 0xD800 <= c < 0xE000] + list(range(0x3100))
    texts += [f"a{chr(c)}b1{chr(c)}2 {chr(c)} .{chr(c)}!" for c in codes] + ["x" * 20000, " " * 20000 + "y", "lorem" * 5000]
    for text, found in zip(texts, aligner.many(texts)):
        a, b = whole(text)
        raw = (" " + text).encode()
        if b"".join(t for _, t in a) == raw and b"".join(t for _, t in b) == raw:
            sides = [[g.split("|")[k].split(",") for g in found[3].split(";")] for k in (0, 1)]
            assert [int(i) for g in sides[0] for i in g] == [i for i, _ in a]
            assert [int(i) for g in sides[1] for i in g] == [i for i, _ in b]
        else:
            assert found is None


def test_groups_come_along(spark):
    docs = spark.createDataFrame([(1, "naïve text"), (2, "naïve text"), (3, None)], "doc_id long, text string")
    rows = align_documents(docs, *PATHS, with_groups=True).collect()
    assert {hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "" for r in rows} == {r.groups_sha256 for r in rows}


def test_no_rows(spark):
    assert align_documents(spark.createDataFrame([], SCHEMA), *PATHS).collect() == []
