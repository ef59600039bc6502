import random
import zlib

import numpy as np
import pytest

from muster.llm.language import BiGRU, WordLanguages, fit_language, predict_language, rows_of
from muster.llm.toxicity import WordMachine, WordValues, fit_toxicity, kernel, letters, parts, score_toxicity, triple_codes


def test_backpropagation_through_time():
    model = BiGRU(["a", "b", "c"], hidden=4)
    for n in BiGRU.NAMES:
        setattr(model, n, getattr(model, n).astype(np.float64))
    data, mask = rows_of([b"abc", b"x", "éa".encode()])
    target = np.array([0, 2, 1])
    _, grads = model.gradients(data, mask, target)
    draw = np.random.default_rng(0)
    for n in BiGRU.NAMES:
        values = getattr(model, n)
        for _ in range(6):
            at = tuple(draw.integers(0, s) for s in values.shape) if n != "embed" else (int(draw.integers(0, 2)), int(data[0, 1]), int(draw.integers(0, 12)))
            before = values[at]
            values[at] = before + 1e-5
            up = model.gradients(data, mask, target)[0]
            values[at] = before - 1e-5
            down = model.gradients(data, mask, target)[0]
            values[at] = before
            assert abs((up - down) / 2e-5 - grads[n][at]) < 1e-6


def test_words_are_labelled_alike_in_any_batch():
    model = BiGRU(["a", "b"], hidden=4)
    words = ["one", "x" * 100, "é1", "two", "1-2"]
    together, apart = WordLanguages(model), WordLanguages(model)
    means, totals = together.of([" ".join(words)])
    alone = [apart.of([w]) for w in words]
    assert totals[0] == sum(t[0] for _, t in alone) == 3 + 100 + 2 + 3
    assert np.allclose(means[0] * totals[0], sum(m[0] * t[0] for m, t in alone), atol=1e-4)


def corpus(seed=1):
    draw = random.Random(seed)
    syllables = {"xx": ["ka", "lo", "mi"], "yy": ["sch", "ein", "ung"]}
    rows = []
    for i in range(300):
        lang = "xx" if i % 2 else "yy"
        rows.append((i, " ".join("".join(draw.choice(syllables[lang]) for _ in range(3)) for _ in range(20)), lang, "s"))
    return rows


def test_language_of_held_out_texts(spark):
    extra = [(1000, None, "xx", "s"), (1001, "", "yy", "s"), (1002, "12 -- 3", "xx", "s"), (None, "kalomi kami", "xx", "s"), (1003, "kalomi", None, "s"), (3, "einungsch ein " * 5000, "yy", "s")]
    docs = spark.createDataFrame(corpus() + extra, "doc_id long, text string, lang string, score string")
    rows = predict_language(docs, fit_language(docs, steps=60)).collect()
    assert len(rows) == 306
    lang = {r[0]: r[2] for r in corpus()}
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 300 and r.doc_id != 3]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and abs(sum(r.probabilities.values()) - 1) < 1e-3 for r in held)
    assert {r.lang_pred for r in rows if r.doc_id in (1000, 1001, 1002)} == {"und"}
    assert [r.held_out for r in rows if r.doc_id is None] == [False]


def test_language_without_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fit_language(empty) is None and predict_language(empty, None).collect() == []


def test_kernel_is_that_of_weighted_triples():
    words = [letters(w) for w in ("idiot", "i.d-i*o.t", "idxiot", "tree", "a", "")]
    assert words[0] == words[1]
    table = np.zeros((64 ** 3, len(words)), np.float32)
    for chosen, codes, weights in triple_codes(words):
        for i, own in zip(chosen, codes):
            np.add.at(table[:, i], own, weights)
    gram = kernel(words, table)
    assert np.allclose(gram, gram.T, atol=1e-5) and np.linalg.eigvalsh(gram).min() > -1e-5
    assert gram[0, 2] > gram[0, 3] and gram[0, 2] > 0.2
    assert parts(b"x" * 60)[-1] and sum(map(len, parts(b"x" * 60))) >= 60


@pytest.fixture(scope="module")
def judged():
    draw = random.Random(3)
    insults = ["blorgak", "snarfit", "wexpod"]
    rows, labels = [], []
    for i in range(600):
        words = ["".join(draw.choice(["ta", "re", "mi", "so", "lun", "ed"]) for _ in range(draw.randint(1, 4))) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words.insert(draw.randrange(30), draw.choice(insults))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_texts(spark, judged):
    rows, labels = judged
    extra = [(2000, "ta re s n a r f i t mi"), (2001, "tare blor-gak!"), (2002, "mi wexxpod so"), (2003, None), (2004, ""), (None, "snarfit"), (2005, "lun " * 30000 + "wexpod")]
    docs = spark.createDataFrame([(*r, 1) for r in rows + extra], "doc_id long, text string, label int")
    marks = spark.createDataFrame([(*x, 0) for x in labels + [(None, 1), (2003, None)]], "doc_id long, toxic int, quality int")
    found = {r.doc_id: r for r in score_toxicity(docs, fit_toxicity(docs, marks)).collect()}
    held = [(found[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == y for r, y in held) >= 0.98 * len(held)
    assert all(found[i].predicted == 1 for i in (2000, 2001, 2005, None)) and found[2002].score > found[2004].score
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    assert found[2003].predicted == 0 and found[2004].predicted == 0


def test_toxicity_without_labels(spark, judged):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert fit_toxicity(docs, none) is None
    assert [tuple(r) for r in score_toxicity(docs, None).collect()] == [(1, False, 0.0, 0)]
    assert score_toxicity(docs.limit(0), None).collect() == []
    assert WordMachine.fit([[b"\x01\x02\x03"]], np.array([0])) is None


def test_values_do_not_depend_on_the_batch(judged):
    rows, labels = judged
    bags = [[p for w in t.split() for p in parts(letters(w))] for _, t in rows]
    machine = WordMachine.fit(bags, np.array([y for _, y in labels]))
    texts = [t for _, t in rows[:40]]
    together = WordValues(machine).of(texts)
    assert np.allclose(together, [WordValues(machine).of([t])[0] for t in texts], atol=1e-5)


def test_languages_without_spaces_are_learned(spark):
    """Runs longer than the network reads at once are cut, in learning as in prediction."""
    draw = random.Random(4)
    signs = [chr(c) for c in range(0x4E00, 0x4E60)]
    rows = [(i, "".join(draw.choice(signs) for _ in range(draw.randint(40, 90))), "zh") for i in range(60)]
    rows += [(i, " ".join(draw.choice(["the", "cat", "house", "of", "reads"]) for _ in range(30)), "en") for i in range(60, 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language(docs)
    assert model.labels == ["en", "zh"]
    assert {(r.doc_id < 60, r.lang_pred) for r in predict_language(docs, model).collect()} == {(True, "zh"), (False, "en")}
