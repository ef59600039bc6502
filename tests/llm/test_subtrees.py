import hashlib
import random

import numpy as np
import pytest

from muster.llm import subtrees
from muster.llm.subtrees import WordHashes, anchors, least_below, merged, remove_passages

SCHEMA = "doc_id long, text string, tid string, least int, words string"


def brute(rows, length):
    least = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for k in range(len(words) - length + 1):
                window = tuple(words[k:k + length])
                least[window] = min(i, least.get(window, i))
    out = []
    for i, words in split:
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - length + 1 if i is not None else 0):
            if least[tuple(words[k:k + length])] < i:
                gone[k:k + length] = True
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda t: (t[0] is not None, t[0] or 0, t[1:]))


def texts(seed, count, length):
    draw = random.Random(seed)
    word = lambda: draw.choice(["a", "b", "Cc", "ü", "x" * 30])
    passages = [[f"p{k}"] + [word() for _ in range(length + draw.randint(-2, 2 * length))] for k in range(4)]
    out = []
    for _ in range(count):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += draw.choice(passages) if draw.random() < 0.5 else [str(draw.random()) for _ in range(draw.randint(0, 2 * length))]
            words += [word()] * draw.choice([0, 0, 1, 2 * length])
        out.append(draw.choice([" ", "\n", "\t \x0b"]).join(words))
    return out


@pytest.mark.parametrize("seed, length, run, hot, chunk", [(0, 6, 2, 10 ** 9, 1), (1, 6, 3, 0, 50), (2, 5, 2, 6, 40), (3, 50, 8, 3, 10 ** 6), (4, 50, 8, 2000, 150_000)])
def test_against_brute_force(spark, seed, length, run, hot, chunk):
    draw = random.Random(seed)
    own = texts(seed, 120, length) + [None, "", " ", "one"]
    own += own[:10] * 3
    rows = [(draw.randint(-20, 200) if draw.random() < 0.95 else None, t) for t in own]
    docs = spark.createDataFrame([(i, t, "t", 1, "w") for i, t in rows], SCHEMA).repartition(5)
    got = remove_passages(docs, length=length, run=run, hot=hot, chunk=chunk)
    want = brute(rows, length)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert ordered(got.collect()) == ordered(want) and 0 < sum(w[2] for w in want)


@pytest.mark.parametrize("seed", range(20))
def test_least_below(seed):
    draw = np.random.default_rng(seed)
    length, size = int(draw.integers(1, 40)), 400
    words = draw.integers(0, int(draw.integers(1, 4)), size).astype(np.uint64)
    starts = np.sort(draw.choice(size - length, 150))
    owner, group = draw.integers(-5, 5, 150), draw.integers(0, 3, 150)
    got = least_below(words, starts, group, owner, length, ahead=int(draw.integers(1, 20)))
    names = [(g, words[s:s + length].tobytes()) for g, s in zip(group.tolist(), starts.tolist())]
    assert got.tolist() == [min(o for n, o in zip(names, owner.tolist()) if n == own) for own in names]


def test_anchors_cover_every_window_once_and_are_those_of_equal_windows():
    own = [t.encode() for t in texts(7, 30, 10)]
    words, bounds = WordHashes().of(own)
    text, key, first, starts = anchors(words, bounds, 10, 3)
    seen, by_window = set(), {}
    for t, k, f, n in zip(text.tolist(), key.tolist(), first.tolist(), starts.tolist()):
        for s in range(f, f + n):
            seen.add((t, s))
            window = tuple(own[t].split()[s:s + 10])
            assert len(window) == 10 and by_window.setdefault(window, (k, s - f)) [0] == k
    assert len(seen) == starts.sum() == sum(max(0, len(t.split()) - 9) for t in own)


def test_memos_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(subtrees, "MEMO", 2)
    rows = list(enumerate(texts(9, 40, 6) * 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert ordered(remove_passages(docs, length=6, run=2, hot=5).collect()) == ordered(brute(rows, 6))


def test_merged():
    assert merged([(5, 8), (0, 2), (2, 3), (7, 9), (6, 7)]) == [(0, 3), (5, 9)]


def test_no_rows(spark):
    assert remove_passages(spark.createDataFrame([], SCHEMA)).collect() == []
