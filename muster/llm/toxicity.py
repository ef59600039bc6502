"""Toxicity of texts by a support vector machine over gapped letter subsequences.

Two words are alike by the letter triples they share in order, gaps allowed: every occurrence of a triple
counts ``DECAY`` to the power of the letters it spans, up to ``SPAN``.  The machine works in the Nyström space
of landmark words.  Its decision is linear in a word's triples, so after training one table of triple weights
scores any word.  Labels are on whole texts; which words of a toxic text carry the label is found in turns
with the machine (multiple instances): words with letter runs that chance does not explain stand for it, as
long as the machine agrees.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import pieces
from muster.llm.language import hash_limit, held_out

DECAY, SPAN = 0.6, 6
LANDMARKS = 160
SAMPLE = {1: 1200, 0: 2400}  # labelled texts that training may see
SAMPLE_WORDS = 300  # different words of each of them, by least hash
ROUNDS, PENALTY = 3, 1e-3
PURE = 0.8  # least share of toxic texts among those with a letter run that marks a word
BEARERS = 6  # words of a toxic text that may stand for its label
KNOWN, HARD = 30_000, 3_000  # words of clean texts that training may see
THRESHOLD = 0.3
WIDTH = 24  # letters of a word read at once; longer words are read in overlapping parts
_CODES, _START, _END = 64, 62, 63
_MEMO = 50_000
_WORDS_AT_ONCE, _ROWS_AT_ONCE = 1024, 2048
_FACTORS = np.random.default_rng(1).integers(1, 2 ** 31, 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def letters(word: str) -> bytes:
    """A word's letters as codes below 62; digits, signs and case are left out."""
    word = word.lower()
    if not word.isalpha():
        word = "".join(c for c in word if c.isalpha())
    if word.isascii():
        return bytes(b & 31 for b in word.encode())
    return bytes(ord(c) & 31 if c < "\x80" else 27 + ord(c) % 35 for c in word)


def parts(codes: bytes) -> list[bytes]:
    if len(codes) <= WIDTH:
        return [codes] if codes else []
    return [codes[i:i + WIDTH] for i in range(0, len(codes) - WIDTH // 2, WIDTH // 2)]


def _triples(length: int):
    """Places and weights of the triples of a word with this many codes, the weights of unit length together."""
    places = [(i, j, k) for i in range(length) for k in range(i + 2, min(length, i + SPAN)) for j in range(i + 1, k)]
    if not places:
        return None
    i, j, k = np.array(places).T
    weights = DECAY ** (k - i + 1.0)
    return i, j, k, (weights / np.sqrt((weights ** 2).sum())).astype(np.float32)


def triple_codes(words: list[bytes]):
    """Batches of words of one length: their places in ``words``, triple codes and weights."""
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, own in by_length.items():
        found = _triples(length + 2)
        if found is None:
            continue
        i, j, k, weights = found
        for at in range(0, len(own), _WORDS_AT_ONCE):
            chosen = own[at:at + _WORDS_AT_ONCE]
            raw = b"".join(bytes([_START]) + words[x] + bytes([_END]) for x in chosen)
            codes = np.frombuffer(raw, np.uint8).reshape(len(chosen), length + 2).astype(np.int32)
            yield np.array(chosen), (codes[:, i] * _CODES + codes[:, j]) * _CODES + codes[:, k], weights


def _dense(words: list[bytes], index: np.ndarray, width: int) -> np.ndarray:
    """Weights of the triples of words as rows; ``index`` has the column of each triple code."""
    out = np.zeros((len(words), width), np.float32)
    for chosen, codes, weights in triple_codes(words):
        np.add.at(out, (chosen[:, None], index[codes]), weights[None, :])
    return out


def kernel(words: list[bytes], table: np.ndarray, index: np.ndarray | None = None) -> np.ndarray:
    """Sum of the rows of ``table`` over the weighted triples of every word; rows are by code or by ``index``."""
    out = np.zeros((len(words), *table.shape[1:]), np.float32)
    for chosen, codes, weights in triple_codes(words):
        step = max(1, 2_000_000 // max(1, codes.shape[1] * int(np.prod(table.shape[1:]))))
        for at in range(0, len(chosen), step):
            own = codes[at:at + step]
            out[chosen[at:at + step]] = np.einsum("nt...,t->n...", table[own if index is None else index[own]], weights)
    return out


def _train(rows: list[np.ndarray], sign: np.ndarray, weight: np.ndarray, turns: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps on the points within the margin.

    The points are the rows of several arrays one after the other; a bias is added, and few are widened at a time.
    """
    width = rows[0].shape[1] + 1
    solution = np.zeros(width)
    for _ in range(turns):
        system, right, start = PENALTY * np.eye(width), np.zeros(width), 0
        for own in rows:
            for at in range(0, len(own), _ROWS_AT_ONCE):
                x = np.ones((len(own[at:at + _ROWS_AT_ONCE]), width))
                x[:, :-1] = own[at:at + _ROWS_AT_ONCE]
                y, w = sign[start:start + len(x)], weight[start:start + len(x)]
                inside = y * (x @ solution) < 1
                x, y, w = x[inside], y[inside], w[inside]
                system += x.T @ (x * w[:, None])
                right += x.T @ (w * y)
                start += len(inside)
        following = np.linalg.solve(system, right)
        if np.allclose(following, solution, atol=1e-6):
            break
        solution = following
    return solution


def run_codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of four to eight codes of words, their ends included: the place of the word, and the run as a number."""
    owners, codes = [], []
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, own in by_length.items():
        raw = b"".join(bytes([_START]) + words[i] + bytes([_END]) for i in own)
        rows = np.frombuffer(raw, np.uint8).reshape(len(own), length + 2).astype(np.int64)
        for n in range(4, min(8, length + 2) + 1):
            for at in range(length + 3 - n):
                code = np.full(len(own), n, np.int64)
                for k in range(n):
                    code = (code << 6) | rows[:, at + k]
                owners.append(np.array(own))
                codes.append(code)
    return (np.concatenate(owners), np.concatenate(codes)) if owners else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def without_copies(bags: list[list[bytes]], labels: np.ndarray) -> tuple[list[list[bytes]], np.ndarray]:
    """One bag of those of a label that agree with it in half of eight least word hashes."""
    kept, met = [], {}
    for i, bag in enumerate(bags):
        hashes = np.array([zlib.crc32(w) for w in set(bag)], np.uint64)
        if len(hashes):
            least = ((hashes[:, None] * _FACTORS) & np.uint64(0xFFFFFFFF)).min(axis=0).tolist()
            keys = [(int(labels[i]), k, v) for k, v in enumerate(least)]
            votes = Counter(met[k] for k in keys if k in met)
            if votes and max(votes.values()) >= 4:
                continue
            for k in keys:
                met.setdefault(k, i)
        kept.append(i)
    return [bags[i] for i in kept], labels[kept]


class WordMachine:
    """Weights of letter triples, a bias, and the curve from a text's worst word to its score."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self.slope, self.middle, self.floor = 4.0, 0.5, 0.0

    @classmethod
    def fit(cls, bags: list[list[bytes]], labels: np.ndarray, landmarks: int = LANDMARKS, rounds: int = ROUNDS,
            seed: int = 5) -> WordMachine | None:
        """Train on bags of words labelled 0 or 1; None without words of both labels.

        The curve is fitted to what machines trained on one half of the bags say about the other half.
        """
        bags, labels = without_copies(bags, labels)
        made = cls._machine(bags, labels, landmarks, rounds, seed)
        if made is None:
            return None
        half = np.arange(len(bags)) % 2 == 0
        worst, known = np.zeros(len(bags)), np.zeros(len(bags), bool)
        for part in (half, ~half):
            other = cls._machine([b for b, on in zip(bags, part) if on], labels[part], landmarks, rounds, seed)
            if other is not None:
                worst[~part] = other.worst([b for b, on in zip(bags, ~part) if on])
                known |= ~part
        made._calibrate(worst[known], labels[known])
        return made

    @classmethod
    def _machine(cls, bags, labels, landmarks, rounds, seed) -> WordMachine | None:
        draw = np.random.default_rng(seed)
        seen: tuple[dict, dict] = ({}, {})
        for bag, label in zip(bags, labels):
            into = seen[int(label)]
            for w in set(bag):
                into[w] = into.get(w, 0) + 1
        clean, toxic = seen
        suspects = sorted(w for w in toxic if w not in clean)
        if not suspects or not clean:
            return None
        # A word may stand for the label if one of its letter runs is much likelier in toxic texts, so much that
        # chance would show it for less than one run of all (likelihood ratio of two binomial shares).
        n_toxic, n_clean = int((labels == 1).sum()), int((labels == 0).sum())
        place = {w: i for i, w in enumerate(suspects)}
        owner, code = run_codes(suspects)
        known_runs, of_run = np.unique(code, return_inverse=True)
        in_toxic, in_clean = np.zeros(len(known_runs)), np.zeros(len(known_runs))
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(len(suspects) + 1))
        by_word = [of_run[order[ends[i]:ends[i + 1]]] for i in range(len(suspects))]
        for bag, label in zip(bags, labels):
            own = [by_word[place[w]] for w in set(bag) if w in place] if label else []
            if own:
                in_toxic[np.unique(np.concatenate(own))] += 1
        clean_words = list(clean)
        times_clean = np.array([clean[w] for w in clean_words], float)
        for at in range(0, len(clean_words), 20_000):
            owner, code = run_codes(clean_words[at:at + 20_000])
            where = np.minimum(np.searchsorted(known_runs, code), len(known_runs) - 1)
            same = known_runs[where] == code
            np.add.at(in_clean, where[same], times_clean[at + owner[same]])
        base = n_toxic / (n_toxic + n_clean)
        share = in_toxic / np.maximum(1, in_toxic + in_clean)
        ratio = in_toxic * np.log(np.maximum(share, 1e-9) / base) + in_clean * np.log(np.maximum(1 - share, 1e-9) / (1 - base))
        evidence = np.where((share > base) & (share >= PURE), ratio, 0.0)
        first = np.array([evidence[own].max() if len(own) else 0.0 for own in by_word])
        least = min(np.log(len(known_runs) + 1), first.max())
        times: Counter = Counter()
        for bag, label in zip(bags, labels):
            if label:
                own = sorted({place[w] for w in bag if w in place}, key=lambda i: (-first[i], i))
                times.update(i for i in own[:BEARERS] if first[i] >= least)
        bearers = np.array(sorted(times, key=lambda i: (-times[i], -first[i], i)))
        weights = np.array([times[i] for i in bearers], float)
        known = sorted(clean)
        mixed = [known[i] for i in draw.permutation(len(known))]
        known, rest = mixed[:KNOWN], mixed[KNOWN:]
        marks = [suspects[i] for i in bearers[:landmarks // 2]]
        marks += [known[i] for i in draw.permutation(len(known))[:landmarks - len(marks)]]
        present = np.unique(np.concatenate([np.zeros(1, np.int32), *(np.unique(c) for _, c, _ in triple_codes(marks))]))
        index = np.zeros(_CODES ** 3, np.int32)
        index[present] = np.arange(1, len(present) + 1)
        dense = _dense(marks, index, len(present) + 1)
        gram = dense.astype(np.float64) @ dense.T.astype(np.float64)
        values, vectors = np.linalg.eigh(gram)
        solid = values > 1e-6 * values.max()
        whiten = vectors[:, solid] / np.sqrt(values[solid])
        table = np.ascontiguousarray(dense.T @ whiten.astype(np.float32))

        clean_rows, bearer_rows = [kernel(known, table, index)], kernel([suspects[i] for i in bearers], table, index)
        chosen = np.ones(len(bearers), bool)
        for _ in range(rounds):
            n_known = sum(map(len, clean_rows))
            sign = np.concatenate([np.ones(chosen.sum()), -np.ones(n_known)])
            weight = np.concatenate([0.5 * weights[chosen] / weights[chosen].sum(), np.full(n_known, 0.5 / n_known)])
            solution = _train([bearer_rows[chosen], *clean_rows], sign, weight)
            still = bearer_rows @ solution[:-1] + solution[-1] > 0
            # Words of clean texts that come nearest to a toxic one join the training.
            whole = cls((table @ solution[:-1].astype(np.float32))[index], float(solution[-1]))
            value = whole.words(rest)
            near = [rest[i] for i in np.argsort(-value)[:HARD] if value[i] > -0.5]
            if near:
                taken = set(near)
                rest = [w for w in rest if w not in taken]
                clean_rows.append(kernel(near, table, index))
            if still.any():
                chosen = still
        return cls((table @ solution[:-1].astype(np.float32))[index], float(solution[-1]))

    def worst(self, bags: list[list[bytes]]) -> np.ndarray:
        """Decision value of the worst word of every bag."""
        every = sorted({w for bag in bags for w in bag})
        value = dict(zip(every, self.words(every).tolist()))
        return np.array([max((value[w] for w in bag), default=-9.0) for bag in bags])

    def words(self, codes: list[bytes]) -> np.ndarray:
        """Decision value of every word; no letters give the lowest."""
        cut = [parts(c) for c in codes]
        values = kernel([p for own in cut for p in own], self.table) + self.bias
        ends = np.cumsum([len(own) for own in cut])
        return np.array([values[e - len(own):e].max() if own else -9.0 for own, e in zip(cut, ends)], np.float32)

    def _calibrate(self, worst: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve through the decision values of texts (Platt), the likeliest of a grid.

        Its floor is the share of toxic labels among texts whose words do not show it, so that these do not
        flatten the curve.
        """
        toxic, clean = worst[labels == 1], worst[labels == 0]
        if not len(toxic) or not len(clean):
            return
        best = np.inf
        for middle in np.linspace(-1.5, 2.0, 71):
            for slope in (1.0, 2.0, 3.0, 5.0, 8.0, 12.0):
                up, down = (1 / (1 + np.exp(-np.clip(slope * (x - middle), -30, 30))) for x in (toxic, clean))
                for floor in (0.001, 0.02, 0.05, 0.1, 0.15):
                    loss = -np.log(floor + (1 - floor) * up).sum() - np.log1p(1e-9 - floor - (1 - floor) * down).sum()
                    if loss < best:
                        best, self.slope, self.middle, self.floor = loss, slope, float(middle), floor

    def score(self, worst: np.ndarray) -> np.ndarray:
        return self.floor + (1 - self.floor) / (1 + np.exp(-np.clip(self.slope * (worst - self.middle), -30, 30)))


class WordValues(dict):
    """Row numbers of chunks of text, with the decision value of each; new ones are valued in one go."""

    def __init__(self, machine: WordMachine):
        self.machine, self.waiting = machine, []
        self.values, self.single = np.zeros(0, np.float32), np.zeros(0, bool)

    def __missing__(self, chunk: str) -> int:
        self[chunk] = row = len(self)
        self.waiting.append(letters(chunk))
        return row

    def of(self, texts: list[str | None]) -> np.ndarray:
        """Decision value of the worst word of every text."""
        if len(self) >= _MEMO:
            self.clear()
            self.values, self.single = self.values[:0], self.single[:0]
        rows = [np.array([self[w] for w in (t or "").split()], np.int64) for t in texts]
        codes, self.waiting = self.waiting, []
        self.values = np.concatenate([self.values, self.machine.words(codes)])
        self.single = np.concatenate([self.single, np.array([len(c) == 1 for c in codes], bool)])
        worst = np.array([self.values[r].max() if len(r) else -9.0 for r in rows], np.float64)
        for i, spelled in enumerate(self._spelled(r, t) for r, t in zip(rows, texts)):
            if spelled:
                worst[i] = max(worst[i], self.machine.words(spelled).max())
        return worst

    def _spelled(self, rows: np.ndarray, text: str | None) -> list[bytes]:
        """Words spelled letter by letter with white space between."""
        single = self.single[rows]
        if single.sum() < 3:
            return []
        edges = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
        runs = [(s, e) for s, e in zip(edges[::2], edges[1::2]) if e - s >= 3]
        chunks = (text or "").split() if runs else []
        return [b"".join(letters(c) for c in chunks[s:e]) for s, e in runs]


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 sample: dict[int, int] | None = None, sample_words: int = SAMPLE_WORDS) -> WordMachine | None:
    """Train on at most ``sample[label]`` texts of each label and ``sample_words`` words of each text.

    Texts whose crc32(id) mod 4 is 2, without label or id, are never learned from; the sample is the ids
    with the least hash.  None if either label is missing.
    """
    sample = sample or SAMPLE
    marked = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col, 4, 2))
    marked = marked.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"), F.xxhash64(id_col).alias("_h"))
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    chosen = F.lit(False)
    for label, n in counts.items():
        share = min(1.0, (1.1 * sample[label] + 50) / n)
        chosen = chosen | ((F.col("label") == label) & (F.col("_h") <= hash_limit(share)))
    marked = marked.filter(chosen)  # a bounded number of ids, whatever the table's size
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    words = F.transform(F.array_distinct(F.split("text", r"\s+")), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("w")))
    words = F.transform(F.slice(F.array_sort(words), 1, sample_words), lambda s: s["w"])
    found = texts.join(F.broadcast(marked), "doc_id").select("label", "_h", words.alias("words")).toArrow()
    found = found.sort_by([("label", "ascending"), ("_h", "ascending")])
    bags, known, one = [], [], {}  # a word of many texts is held once
    for batch in found.to_batches(max_chunksize=64):
        for label, own in zip(batch.column("label").to_pylist(), batch.column("words")):
            if known.count(label) < sample[label]:
                known.append(label)
                bags.append([one.setdefault(p, p) for w in own.as_py() for p in parts(letters(w))])
    del found, one
    return WordMachine.fit(bags, np.array(known, np.int64))


def score_toxicity(docs: DataFrame, machine: WordMachine | None, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD, keep: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; with ``keep`` the columns of ``docs`` and ``score``.

    The score of a text is the machine's curve at its worst word, whole texts and words spelled letter by
    letter included.  Null, empty and letterless texts get the lowest score, and all texts do without a
    machine.  Rows are judged one by one, so copies and repeated ids are alike.
    """
    base = docs if keep else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    text = text_col if keep else "text"
    base = base.drop("score") if keep else base
    schema = base.schema
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        memo = WordValues(own) if own is not None else None
        for batch in pieces(batches, text):
            texts = batch.column(text).to_pylist()
            scores = own.score(memo.of(texts)) if own is not None else np.zeros(len(texts))
            columns = batch.columns if keep else [batch.column("doc_id")]
            names = batch.schema.names if keep else ["doc_id"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*names, "score"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if keep or f.name == "doc_id"]
    scored = base.mapInArrow(judge, ", ".join([*kinds, "score double"]))
    if keep:
        return scored
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
