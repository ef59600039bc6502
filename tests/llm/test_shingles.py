import random

import pytest

from muster.llm import shingles
from muster.llm.shingles import Common, bucket_counts, coarse, link_documents, most_overlap, needed, one_of_each, overlap

import numpy as np


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    """Row components by comparing all pairs, and the least id of each."""
    sets = [sets_of(t, size) for _, t in rows]
    part = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and part[i] != part[j]:
                    low = min(part[i], part[j])
                    part = [low if p in (part[i], part[j]) else p for p in part]
                    changed = True
    least = {}
    for p, (i, _) in zip(part, rows):
        least[p] = min([x for x in (least.get(p), i) if x is not None], default=None)
    return part, [(i, len(s), least[p] if s else i) for p, (i, _), s in zip(part, rows, sets)]


def documents(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghijklmnopqrstuvwxyz") + str(draw.randint(0, 9))
    passage = [word() for _ in range(12)]
    texts = []
    for _ in range(14):
        base = [word() for _ in range(draw.randint(1, 60))]
        texts.append(base + passage * draw.randint(0, 1))
        for _ in range(draw.randint(0, 6)):  # chains of small changes
            base = list(base)
            for _ in range(draw.randint(0, 2)):
                base[draw.randrange(len(base))] = word()
            texts.append(base + ([word()] if draw.random() < 0.3 else []))
    texts = [" ".join(t) for t in texts] + [None, "", "  \n", "Aa bb", "aA  BB", "aa", "é É", texts[0] and " ".join(texts[0])]
    return [(None if i in (3, 9) else i % (len(texts) - 2), t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,share,salts,group", [(1, 2000, 16, 64), (2, 4, 3, 2)])
def test_against_all_pairs(spark, monkeypatch, seed, share, salts, group):
    monkeypatch.setattr(shingles, "COMMON_LEAST", 2)
    rows = documents(seed)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, sid string, n int").repartition(4)
    found = link_documents(frame, size=3, percent=70, share=share, salts=salts, group=group).collect()
    part, want = brute(rows, 3, 70)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((key((r.doc_id, r.n_shingles, r.component_id)) for r in found)) == sorted(map(key, want))
    linked = {p for p, (_, t) in zip(part, rows) if sets_of(t, 3)}
    wordless = sum(1 for _, t in rows if not sets_of(t, 3))
    assert sum(r.kept for r in found) == len(linked) + wordless


def test_one_of_each(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "q r s t u"), (4, None), (4, None), (None, "a b c d e"), (None, "z")]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, digest int")
    kept = one_of_each(frame, size=2, percent=80)
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept.collect()) == [(0, "z"), (1, "a b c d e"), (3, "q r s t u"), (4, ""), (4, "")]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert link_documents(empty).collect() == [] and one_of_each(empty).collect() == []


def test_bounds():
    draw = np.random.default_rng(1)
    for _ in range(200):
        pool = draw.integers(0, 2 ** 63, 400).astype(np.uint64)
        one, other = (np.unique(draw.choice(pool, draw.integers(1, 390))) for _ in range(2))
        assert overlap(one, other) == len(np.intersect1d(one, other)) <= most_overlap(bucket_counts(one), bucket_counts(other))
        assert most_overlap(bucket_counts(one), bucket_counts(other)) <= most_overlap(coarse(bucket_counts(one)), coarse(bucket_counts(other)))
    for a in range(1, 40):
        for b in range(1, 40):
            least = needed(a, b, 85)
            assert 100 * least >= 85 * (a + b - least) and 100 * (least - 1) < 85 * (a + b - least + 1)


def test_common_tokens_come_last():
    common = Common(np.array([5, 9], np.uint64), np.array([70, 30]))
    tokens, often = common.prefix(np.array([1, 5, 8, 9], np.uint64), 3)
    assert tokens.tolist() == [1, 8, 9] and often.tolist() == [False, False, True]
