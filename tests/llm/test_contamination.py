import random
import re

import pytest

from muster.llm.contamination import mark_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, size):
    doc, hit, named = lowered(text), set(), set()
    for item_id, item in items:
        own = lowered(item)
        k = min(size, len(own))
        for i in range(len(own) - k + 1 if k else 0):
            for j in range(len(doc) - k + 1):
                if doc[j:j + k] == own[i:i + k]:
                    hit.update(range(j, j + k))
                    named |= {str(item_id)} if item_id is not None else set()
    return len(doc), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(doc)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_against_brute_force(spark, block_bytes):
    draw = random.Random(3)
    letters = ["a", "B", "c", "é", "7", "dd", "İ"]

    def passage(n):
        return "".join(draw.choice(letters) + draw.choice([" ", "-", "\n", "_ "]) for _ in range(n))

    items = [(i, passage(draw.randint(0, 9))) for i in range(30)] + [(90, None), (91, ""), (None, "7 dd c 7 dd"), (None, "é é"), (5, "a a a a a"), (5, "é-dd")]
    docs = [(i % 50, passage(draw.randint(0, 80)), i, "y") for i in range(60)]
    docs += [(102, "x x é é y", 0, "z"), (100, None, 0, "z"), (101, "", 0, "z"), (None, "a a a a a a a", 0, "z"), docs[0]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_hit long, items string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    marked = mark_contaminated(frame, benchmark, window=4, block_bytes=block_bytes, keep=True)
    assert marked.columns[:2] == ["doc_id", "text"]
    rows = marked.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == brute(r.text, items, 4), r
        assert r.n_items == len(r["items"]) and sum(s.end - s.start for s in r.spans) == r.n_hit


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = mark_contaminated(docs, none).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    assert mark_contaminated(docs.limit(0), none).collect() == []
