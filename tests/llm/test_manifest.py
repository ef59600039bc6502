import hashlib
import random
import zlib

import pytest

from muster.llm.manifest import manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree string, idx int, slot string, h string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    def form(name):
        value = row[name]
        if value is None:
            return "-"
        value = str(value)
        if lower and name == "text":
            value = "".join(c.lower() if "A" <= c <= "Z" else c for c in value)
        return f"{len(value.encode())}:{value}"

    return sha("".join(form(f) for f in FIELDS))


def climb(nodes, fanout):
    """All levels of a list of digests."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + fanout])) for i in range(0, len(last), fanout)])
    return levels


def way(levels, at, fanout):
    """Siblings left and right of a node on every level."""
    out = []
    for level in levels[:-1]:
        start = at - at % fanout
        run = level[start:start + fanout]
        out.append(("".join(run[:at - start]), "".join(run[at - start + 1:])))
        at //= fanout
    return out


def brute(rows, fanout):
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for own in trees.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    built = {name: climb([leaf(r) for r in trees[name]], fanout) for name in names}
    upper = climb([built[name][-1][0] for name in names], fanout) if names else []
    out = []
    for k, name in enumerate(names):
        for at, row in enumerate(trees[name]):
            path = way(built[name], at, fanout) + way(upper, k, fanout)
            folded = leaf(row, row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0)
            for left, right in path:
                folded = sha(left + folded + right)
            root = upper[-1][0]
            out.append((row["doc_id"], leaf(row), built[name][-1][0], root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return out


def check(spark, rows, fanout, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = [tuple(r) for r in manifest(docs, fanout=fanout).collect()]
    key = lambda t: (t[0] is not None, t[0] or 0, t[1:])
    assert sorted(got, key=key) == sorted(brute([dict(zip(SCHEMA.replace(",", "").split()[::2], r)) for r in rows], fanout), key=key)
    return got


def row(doc_id, lang="en", text="Some Text", source="web", n_chars=9):
    return (doc_id, source, lang, n_chars, text, "x", 7, "slot", "h")


@pytest.mark.parametrize("fanout, count", [(2, 11), (3, 28), (8, 150)])
def test_against_brute_force(spark, fanout, count):
    draw = random.Random(fanout)
    langs = ["en", "de", None, "", "fr", "zz"] + [f"l{i}" for i in range(fanout)]
    rows = [row(i, draw.choice(langs[:1] * 20 + langs), draw.choice(["Über ALL", "plain", None, "", "X" * 5000])) for i in draw.sample(range(-50, 10 ** 6), count)]
    got = check(spark, rows, fanout)
    assert {r[6] for r in got} == {True, False}


def test_nulls_ties_and_repeated_rows(spark):
    rows = [row(None), row(None, text="other"), row(3), row(3), row(3, text="b"), row(3, "en", None, None, None), row(5, None, None, None, None), row(9, None)] * 3
    got = check(spark, rows, 8)
    assert len(got) == len(rows)


def test_lone_rows(spark):
    check(spark, [row(1)], 8)
    check(spark, [row(1), row(2, "de")], 8)
    check(spark, [row(i) for i in range(9)], 8)  # a last run of one node is hashed alone
    assert check(spark, [], 8) == []
