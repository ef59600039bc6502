import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from muster.llm import suffixes
from muster.llm.suffixes import common_prefixes, merge_spans, remove_repeats, repeated_starts, sort_windows


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    times = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    rows = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if times[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        rows.append((len(r), int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()), hashlib.sha256(kept).hexdigest()))
    return rows


@pytest.mark.parametrize("seed", range(40))
def test_two_stage_sorting(seed):
    draw = random.Random(seed)
    alphabet, length = draw.choice([b"a", b"ab", b"abc", b"\x00\xff"]), draw.choice([3, 5, 9])
    segments = [bytes(draw.choice(alphabet) for _ in range(draw.randint(length, 40))) for _ in range(draw.randint(1, 8))]
    segments += segments[:1] * draw.randint(0, 1)
    times = Counter(s[i:i + length] for s in segments for i in range(len(s) - length + 1))
    for s, flags in zip(segments, repeated_starts(segments, length)):
        assert flags.tolist() == [times[s[i:i + length]] > 1 for i in range(len(s) - length + 1)]
    text, ends = b"".join(segments), np.cumsum([len(s) for s in segments])
    starts = np.concatenate([np.arange(e - len(s), e - length + 1) for s, e in zip(segments, ends)])
    ordered = sort_windows(text, starts, length)
    windows = [text[i:i + length] for i in ordered]
    assert windows == sorted(windows) and sorted(ordered) == sorted(starts)
    common = common_prefixes(text, ordered, length)
    for i in range(1, len(windows)):
        same = next((k for k in range(length) if windows[i][k] != windows[i - 1][k]), length)
        assert common[i] == same


def test_merge_spans():
    assert merge_spans([(5, 9), (0, 3), (3, 4), (8, 10)]) == [(0, 4), (5, 10)]


@pytest.mark.parametrize("hot", [10_000, 0])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "FINE", 4)
    draw = random.Random(9)
    words = ["ab", "é", "xyz ", "q", "long-word ", "😀"]
    texts = ["".join(draw.choice(words) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    texts += [texts[3][5:60] + "Z" + texts[4][10:70], texts[5] + "tail", "a" * 90, "b" + "a" * 30, None, "", texts[7], texts[7], texts[8][:19]]
    texts += [texts[9][:40] + str(i) + texts[9][41:] for i in range(12)]
    rows = [(i % 50 if i != 2 else None, t, i, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tid long, key string").repartition(5)
    found = remove_repeats(frame, length=20, run=6, hot=hot, chunk=50)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect())
    want = sorted((r[0] if r[0] is not None else -1, *b) for r, b in zip(rows, brute(texts, 20)))
    assert got == want


def test_no_rows(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    short = spark.createDataFrame([(1, "short"), (2, "short")], "doc_id long, text string")
    assert [r.n_removed for r in remove_repeats(short).collect()] == [0, 0]


def test_planted_passages_of_over_50_words(spark):
    """Passages that repeat across documents go if they have 400 bytes, first occurrence included, and stay if they have 399."""
    draw = random.Random(12)
    word = lambda size: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size))
    long, short = " ".join([*(word(6) for _ in range(56)), word(8)]), " ".join([*(word(6) for _ in range(56)), word(7)])
    assert (len(long), len(short), len(long.split())) == (400, 399, 57)
    texts = [str(i) + " ".join(word(6) for _ in range(90)) + f"<{i}" + passage + f"{i}>" for i, passage in enumerate([long] * 3 + [short] * 3 + [""] * 3)]
    rows = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(rows, key=lambda r: r.doc_id)]
    assert got == brute(texts, 400)
    assert [g[1:3] for g in got] == [(400, 1)] * 3 + [(0, 0)] * 6
