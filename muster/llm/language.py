"""Language of texts by a bidirectional gated recurrent network over bytes.

The network reads the bytes of one word, a space at either end, in both directions and gives every byte a
distribution over languages.  State starts anew at each word, so equal words are labelled alike and a task
runs the network once per different word.  A document's probabilities are the mean over its letters' bytes.
Training is by backpropagation through time, in numpy, on a bounded sample of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import pieces

HIDDEN = 16
SAMPLE_DOCS = 400  # documents of each language, and
SAMPLE_WORDS = 150  # words of each of them, that training may see
STEPS, BATCH, RATE = 300, 512, 0.01
WIDTH = 32  # bytes read in one go; longer words are read in several
UNKNOWN = "und"
_MEMO = 200_000


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


class BiGRU:
    """Two GRUs over bytes and a softmax layer over both states of every position."""

    NAMES = ("embed", "recur", "bias", "out", "out_bias")

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        scale = 1.0 / np.sqrt(hidden)
        self.embed = draw.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32)
        self.recur = draw.uniform(-scale, scale, (2, hidden, 3 * hidden)).astype(np.float32)
        self.bias = np.zeros((2, 3 * hidden), np.float32)
        self.out = draw.uniform(-scale, scale, (2 * hidden, len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def _pass(self, data: np.ndarray, mask: np.ndarray, way: int, keep: bool):
        """States of every position; padding leaves the state as it is."""
        h3, h2 = 3 * self.hidden, 2 * self.hidden
        size, width = data.shape
        state = np.zeros((size, self.hidden), self.recur.dtype)
        states = np.zeros((width, size, self.hidden), self.recur.dtype)
        saved = []
        for t in range(width) if way == 0 else range(width - 1, -1, -1):
            inputs = self.embed[way, data[:, t]] + self.bias[way]
            product = state @ self.recur[way]
            gates = _sigmoid(inputs[:, :h2] + product[:, :h2])
            update, reset = gates[:, :self.hidden], gates[:, self.hidden:]
            new = np.tanh(inputs[:, h2:h3] + reset * product[:, h2:h3])
            following = update * state + (1 - update) * new
            on = mask[:, t, None]
            if keep:
                saved.append((t, state, update, reset, new, product[:, h2:h3]))
            state = np.where(on, following, state)
            states[t] = state
        return states, saved

    def probabilities(self, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Distribution over languages at every position of rows of bytes."""
        both = np.concatenate([self._pass(data, mask, w, False)[0] for w in (0, 1)], axis=2)
        scores = both @ self.out + self.out_bias
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        return (scores / scores.sum(axis=2, keepdims=True)).transpose(1, 0, 2)

    def gradients(self, data, mask, target):
        """Mean cross entropy over the unmasked positions, and its gradient for every parameter."""
        passes = [self._pass(data, mask, w, True) for w in (0, 1)]
        both = np.concatenate([p[0] for p in passes], axis=2)
        scores = both @ self.out + self.out_bias
        scores -= scores.max(axis=2, keepdims=True)
        probs = np.exp(scores)
        probs /= probs.sum(axis=2, keepdims=True)
        on = mask.T
        count = on.sum()
        rows = np.arange(data.shape[0])
        loss = -np.log(probs[:, rows, target] + 1e-12)[on].sum() / count
        probs[:, rows, target] -= 1
        probs *= on[:, :, None] / count
        grads = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        grads["out"] = np.einsum("tbh,tbl->hl", both, probs)
        grads["out_bias"] = probs.sum(axis=(0, 1))
        back = probs @ self.out.T
        for way in (0, 1):
            part = back[:, :, way * self.hidden:(way + 1) * self.hidden]
            carry = np.zeros((data.shape[0], self.hidden), self.recur.dtype)
            for t, state, update, reset, new, product in reversed(passes[way][1]):
                carry = carry + part[t]
                on_t = mask[:, t, None]
                d_next = np.where(on_t, carry, 0)
                d_new = d_next * (1 - update) * (1 - new * new)
                d_update = d_next * (state - new) * update * (1 - update)
                d_reset = d_new * product * reset * (1 - reset)
                d_inputs = np.concatenate([d_update, d_reset, d_new], axis=1)
                d_product = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                np.add.at(grads["embed"][way], data[:, t], d_inputs)
                grads["bias"][way] += d_inputs.sum(axis=0)
                grads["recur"][way] += state.T @ d_product
                carry = d_next * update + d_product @ self.recur[way].T + np.where(on_t, 0, carry)
        return loss, grads

    def fit(self, words: list[bytes], labels: np.ndarray, steps: int, batch: int, rate: float, seed: int = 11) -> BiGRU:
        """Adam on batches that draw every language equally often."""
        draw = np.random.default_rng(seed)
        data, mask = rows_of(words)
        of = [np.flatnonzero(labels == i) for i in range(len(self.labels))]
        first = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        second = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        for step in range(1, steps + 1):
            chosen = np.concatenate([draw.choice(x, max(1, batch // len(of))) for x in of])
            width = int(mask[chosen].sum(axis=1).max())
            _, grads = self.gradients(data[chosen, :width], mask[chosen, :width], labels[chosen])
            pace = rate * min(1.0, 2 * (1 - (step - 1) / steps))
            for n in self.NAMES:
                g = np.clip(grads[n], -1, 1)
                first[n] += 0.1 * (g - first[n])
                second[n] += 0.01 * (g * g - second[n])
                change = (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.99 ** step)) + 1e-8)
                setattr(self, n, (getattr(self, n) - pace * change).astype(np.float32))
        return self


def rows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most ``WIDTH`` bytes, with a space at either end, as padded rows and their mask."""
    width = max(map(len, words)) + 2
    joined = b"".join((b" " + w + b" ").ljust(width, b"\0") for w in words)
    lengths = np.array([len(w) + 2 for w in words])
    return np.frombuffer(joined, np.uint8).reshape(len(words), width), np.arange(width) < lengths[:, None]


def _letters(word: str) -> np.ndarray | None:
    """Which bytes of a word belong to letters; None if all do."""
    if word.isalpha():
        return None
    return np.concatenate([np.full(len(c.encode("utf-8", "replace")), c.isalpha()) for c in word])


class WordLanguages(dict):
    """Row numbers of words; rows hold the summed distributions of a word's letter bytes and their number."""

    def __init__(self, model: BiGRU):
        self.model, self.waiting = model, []
        self.sums = np.zeros((0, len(model.labels)), np.float32)
        self.counts = np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.waiting.append(word)
        return row

    def settle(self) -> None:
        """Run the network over the words met since."""
        words, self.waiting = self.waiting, []
        sums, counts = np.zeros((len(words), len(self.model.labels)), np.float32), np.zeros(len(words), np.int64)
        parts, owners, flags = [], [], []
        for i, word in enumerate(words):
            raw, letter = word.encode("utf-8", "replace"), _letters(word)
            counts[i] = len(raw) if letter is None else letter.sum()
            if counts[i]:
                for at in range(0, len(raw), WIDTH):
                    parts.append(raw[at:at + WIDTH])
                    owners.append(i)
                    flags.append(None if letter is None else letter[at:at + WIDTH])
        order = sorted(range(len(parts)), key=lambda k: len(parts[k]))
        for at in range(0, len(order), 4096):
            chosen = order[at:at + 4096]
            data, mask = rows_of([parts[k] for k in chosen])
            probs = self.model.probabilities(data, mask)
            weigh = mask.copy()
            weigh[:, 0] = False
            weigh[np.arange(len(chosen)), mask.sum(axis=1) - 1] = False
            for r, k in enumerate(chosen):
                if flags[k] is not None:
                    weigh[r, 1:1 + len(flags[k])] = flags[k]
            np.add.at(sums, np.array([owners[k] for k in chosen]), np.einsum("btl,bt->bl", probs, weigh.astype(np.float32)))
        self.sums, self.counts = np.concatenate([self.sums, sums]), np.concatenate([self.counts, counts])

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean distribution and number of letter bytes of every text."""
        if len(self) >= _MEMO:
            self.clear()
            self.sums, self.counts = self.sums[:0], self.counts[:0]
        rows = [[self[w] for w in (t or "").lower().split()] for t in texts]
        if self.waiting:
            self.settle()
        means, totals = np.zeros((len(texts), self.sums.shape[1])), np.zeros(len(texts), np.int64)
        for i, own in enumerate(rows):
            if own:
                totals[i] = self.counts[own].sum()
                means[i] = self.sums[own].sum(axis=0, dtype=np.float64) / max(1, totals[i])
        return means, totals


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; no id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


def hash_limit(share: float) -> int:
    """The 64-bit hash that about this share of all hashes do not pass."""
    return min(2 ** 63 - 1, int(share * 2 ** 64) - 2 ** 63)


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, steps: int = STEPS) -> BiGRU | None:
    """Train on at most ``sample_docs`` documents of every language and ``sample_words`` words of each.

    Documents with crc32(id) mod 5 = 0, without id, text or language are not learned from; the sample is the
    documents with the least hash, the words of a document likewise.  None if there are none.
    """
    usable = F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
    rows = docs.filter(usable & ~held_out(id_col, 5, 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("_h"))
    limits = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    limits = {r["lang"]: r["n"] for r in limits.toLocalIterator()}
    if not limits:
        return None
    # The hash is uniform, so this share of its range holds about twice the sample; the rest is sorted off.
    chosen = F.lit(False)
    for lang, n in limits.items():
        limit = min(1.0, (2 * sample_docs + 20) / n)
        chosen = chosen | ((F.col("lang") == lang) & (F.col("_h") <= hash_limit(limit)))
    # Longer runs, as of languages written without spaces, are learned in parts.
    w = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"\S{{1,{WIDTH}}}"), F.lit(0)))
    picked = F.transform(F.slice(F.array_sort(F.transform(w, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("w")))), 1, sample_words), lambda s: s["w"])
    found = rows.filter(chosen).select("lang", "_h", picked.alias("words")).toPandas()
    found = found.sort_values(["lang", "_h"]).groupby("lang").head(sample_docs)
    labels = sorted(limits)
    words, targets = [], []
    for lang, own in zip(found["lang"], found["words"]):
        kept = [x[at:at + WIDTH] for x in (v.encode("utf-8", "replace") for v in own) for at in range(0, len(x), WIDTH)]
        words += kept
        targets += [labels.index(lang)] * len(kept)
    labels = [x for i, x in enumerate(labels) if i in set(targets)]
    if not labels:
        return None
    numbers = {old: new for new, old in enumerate(sorted(set(targets)))}
    return BiGRU(labels).fit(words, np.array([numbers[t] for t in targets]), steps, BATCH, RATE)


def predict_language(docs: DataFrame, model: BiGRU | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, and ``probabilities`` by language.

    ``und`` with score 0 if a text is null, empty or has no letter, or if there is no model.  Whole texts are
    read; rows are judged one by one, so copies and repeated ids are alike; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col, 5, 0).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordLanguages(shared.value) if shared.value is not None else None
        for batch in pieces(batches, "text"):
            texts = batch.column("text").to_pylist()
            names, scores, spread = [UNKNOWN] * len(texts), np.zeros(len(texts)), [{} for _ in texts]
            if memo is not None:
                means, totals = memo.of(texts)
                for i in np.flatnonzero(totals).tolist():
                    best = int(means[i].argmax())
                    names[i], scores[i] = memo.model.labels[best], min(1.0, float(means[i, best]))
                    spread[i] = dict(zip(memo.model.labels, means[i].tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names), pa.array(scores),
                 pa.array([list(s.items()) for s in spread], pa.map_(pa.string(), pa.float64()))],
                ["doc_id", "held_out", "lang_pred", "score", "probabilities"])

    return rows.mapInArrow(label, f"doc_id {kind}, held_out boolean, lang_pred string, score double, probabilities map<string,double>")
