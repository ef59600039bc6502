"""Secrets in texts: fixed patterns, and formats inferred from labelled credentials.

Credentials that the fixed patterns label are read as strings of character classes, apart from a literal prefix that
several of a kind share.  Their prefix tree becomes a probabilistic automaton by state merging: two states merge if,
by Hoeffding's bound, they end and continue alike, and so do all states below them.  Every token of a text is scored
by its likelihood under each format's automaton, against those inferred in the same way from words and from other
tokens with digits.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.batches import Bounded, pieces

KINDS = ["assign", "access", "hex"]
FOUND = "format"
# Fixed patterns and least lengths of the three kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
CANDIDATE = re.compile(r"[A-Za-z0-9+/_](?:[A-Za-z0-9+/_=.~-]{6,}[A-Za-z0-9+/_=])")
LEAST_LENGTH = 8
WORDS, NUMBERS = "words", "numbers"  # other tokens without and with digits
SAMPLE = 800  # credentials of each kind, words and other tokens with digits that inference may see
CONFIDENCE = 0.05
SHARE_PREFIX = 5  # credentials that make a prefix a format of its own
LEAST_SHARE = 0.5  # of the shortest labelled credential of a format, which a token must have at least
_SMOOTH = 0.02
_PREFIX = re.compile(r"(?:[A-Za-z]{2,10}[_-]){1,3}(?=.)")
_LETTERS = str.maketrans({**dict.fromkeys("0123456789", "d"), **dict.fromkeys("abcdef", "h"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"),
                          **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "u")})


def symbols(token: str) -> str:
    """Character classes: digit, lower-case letter within and beyond hexadecimal, capital, or the sign itself.

    A token without lower-case letters counts as if its letters were such: formats are read in either case.
    """
    return (token.lower() if token.upper() == token else token).translate(_LETTERS)


def is_word(token: str) -> bool:
    return token.isalpha() and (token.islower() or token.isupper() or token.istitle())


class Automaton:
    """A probabilistic automaton: per state the strings that pass and end there, and counted moves by symbol."""

    def __init__(self, words: list[str]):
        self.passed, self.ended, self.moves = [0], [0], [{}]
        for word in words:
            state = 0
            for s in word:
                self.passed[state] += 1
                state = self._step(state, s)
            self.passed[state] += 1
            self.ended[state] += 1
        self.root = 0

    def _step(self, state: int, symbol: str) -> int:
        if symbol not in self.moves[state]:
            self.moves[state][symbol] = [len(self.passed), 0]
            self.passed.append(0)
            self.ended.append(0)
            self.moves.append({})
        self.moves[state][symbol][1] += 1
        return self.moves[state][symbol][0]

    def _differ(self, a: int, n: int, b: int, m: int, bound: float) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, one: int, other: int, bound: float) -> bool:
        waiting = [(one, other)]
        while waiting:
            p, q = waiting.pop()
            n, m = self.passed[p], self.passed[q]
            if self._differ(self.ended[p], n, self.ended[q], m, bound):
                return False
            for s in self.moves[p].keys() | self.moves[q].keys():
                to_p, to_q = self.moves[p].get(s), self.moves[q].get(s)
                if self._differ(to_p[1] if to_p else 0, n, to_q[1] if to_q else 0, m, bound):
                    return False
                if to_p and to_q:
                    waiting.append((to_p[0], to_q[0]))
        return True

    def _fold(self, into: int, state: int) -> None:
        """Add a tree's counts to the states that its strings now lead to."""
        waiting = [(into, state)]
        while waiting:
            p, q = waiting.pop()
            self.passed[p] += self.passed[q]
            self.ended[p] += self.ended[q]
            for s, (to, n) in self.moves[q].items():
                if s in self.moves[p]:
                    self.moves[p][s][1] += n
                    waiting.append((self.moves[p][s][0], to))
                else:
                    self.moves[p][s] = [to, n]

    def merge(self, confidence: float = CONFIDENCE) -> Automaton:
        """Merge compatible states: kept ones and those one move away, in the order they are reached."""
        bound = math.sqrt(0.5 * math.log(2 / confidence))
        kept = [self.root]
        while True:
            ahead = [(p, s, self.moves[p][s][0]) for p in kept for s in sorted(self.moves[p])]
            fresh = [(p, s, q) for p, s, q in ahead if q not in set(kept)]
            if not fresh:
                return self
            parent, symbol, state = max(fresh, key=lambda x: self.passed[x[2]])
            for p in kept:
                if self._compatible(p, state, bound):
                    self.moves[parent][symbol][0] = p
                    self._fold(p, state)
                    break
            else:
                kept.append(state)

    def score(self, word: str) -> float:
        """Log likelihood of a symbol string's moves and end; what was never seen has a small share."""
        total, state = 0.0, self.root
        for s in word:
            to = self.moves[state].get(s) if state is not None else None
            if to is None:
                total, state = total + math.log(_SMOOTH / 10), None
            else:
                total += math.log((to[1] + _SMOOTH) / (self.passed[state] + 1))
                state = to[0]
        total += math.log((self.ended[state] + _SMOOTH) / (self.passed[state] + 1)) if state is not None else math.log(_SMOOTH / 10)
        return total


class Format:
    """What credentials of a kind look like: literal prefix, automaton of the rest, least length and likelihood."""

    def __init__(self, kind: str, prefix: str, tokens: list[str]):
        self.kind, self.prefix = kind, prefix
        self.least_length = max(LEAST_LENGTH, int(LEAST_SHARE * min(len(t) for t in tokens)))
        words = [symbols(t[len(prefix):]) for t in tokens]
        # From ten on, every fifth credential is held back to find the likelihood that credentials have; the twentieth part may be less likely.
        held = words[::5] if len(words) >= 10 else words
        self.automaton = Automaton([w for i, w in enumerate(words) if i % 5] if len(words) >= 10 else words).merge()
        likely = sorted(self.automaton.score(w) / (len(w) + 1) for w in held)
        self.least = likely[len(likely) // 20] - (0 if len(words) >= 10 else 0.1)

    def score(self, token: str) -> float | None:
        """Log likelihood of a token; None if it is none of this format."""
        if len(token) < self.least_length or not token.startswith(self.prefix):
            return None
        word = symbols(token[len(self.prefix):])
        own = self.automaton.score(word)
        return own if own >= self.least * (len(word) + 1) else None


class Formats:
    """The formats of each kind of credentials, and automata of ordinary tokens to hold against them.

    Credentials that are plain words teach no format.  Any number of credentials makes one, be it a single one.
    """

    def __init__(self, known: dict[str, list[str]], ordinary: dict[str, list[str]]):
        self.ordinary = [Automaton([symbols(t) for t in tokens]).merge() for _, tokens in sorted(ordinary.items()) if tokens]
        self.formats: list[Format] = []
        for kind, tokens in sorted(known.items()):
            groups: dict[str, list[str]] = {}
            for t in tokens:
                if not is_word(t) and len(t) >= LEAST_LENGTH:
                    found = _PREFIX.match(t)
                    groups.setdefault(found[0] if found else "", []).append(t)
            rest = groups.pop("", [])
            for prefix, own in sorted(groups.items()):
                if len(own) >= SHARE_PREFIX:
                    self.formats.append(Format(kind, prefix, own))
                else:
                    rest += own
            if rest:
                shared = os.path.commonprefix(rest)[:4] if len(rest) >= SHARE_PREFIX else ""
                self.formats.append(Format(kind, shared if len(shared) == 4 else "", rest))
        self.memo = Bounded()

    def judge(self, token: str) -> tuple[str, float] | None:
        """The likeliest kind of a token and by how much its log likelihood beats ordinary tokens; None if it is ordinary."""
        if is_word(token) or not self.formats:
            return None
        if token not in self.memo:
            self.memo.make_room()
            scores = [(own, f.kind) for f in self.formats if (own := f.score(token)) is not None]
            verdict = None
            if scores:
                word = symbols(token)
                best, kind = max(scores)
                plain = max((a.score(word) for a in self.ordinary), default=-math.inf)
                if best > plain:
                    verdict = (kind, best - plain if self.ordinary else best)
            self.memo.keep(token, verdict)
        return self.memo[token]


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, credential`` of the fixed patterns, by start and kind."""
    spans = []
    lower = text.lower()
    if any(k in lower for k in ("passw", "secret", "token", "api")):
        # The pattern takes the longest run, so one that is too short uses up its text all the same.
        spans += [(*m.span(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(*m.span(), "access", m[0]) for m in ACCESS.finditer(text)]
    spans += [(*m.span(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, base: list[tuple]) -> Iterator[tuple[int, int, str]]:
    """Tokens of eight characters or more, plain words aside, that no base span touches."""
    at = 0
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][1] <= m.start():
            at += 1
        if not is_word(m[0]) and not any(s < m.end() and m.start() < e for s, e, *_ in base[at:at + 4]):
            yield (*m.span(), m[0])


def fit_formats(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Formats:
    """Infer the formats from the credentials that the fixed patterns label.

    At most ``sample`` different ones of each kind, as many words and as many other tokens with digits are learned
    from, those with the least hash.
    """
    texts = docs.select(F.col(text_col).alias("text")).filter("text IS NOT NULL")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each kind a task passes on no more than the sample, the tokens of least hash.
        least: dict[str, dict[str, int]] = {}
        for batch in pieces(batches, "text"):
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                found = {(kind, token) for *_, kind, token in base}
                found |= {(NUMBERS, t) for _, _, t in candidates(text, base) if any("0" <= c <= "9" for c in t)}
                found |= {(WORDS, w) for w in CANDIDATE.findall(text) if w.isalpha()}
                for kind, token in found:
                    own = least.setdefault(kind, {})
                    if token not in own:
                        own[token] = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=7).digest(), "big")
                        if len(own) > 4 * sample:
                            least[kind] = dict(sorted(own.items(), key=lambda x: x[1])[:sample])
        rows = [(k, t, h) for k, own in least.items() for t, h in sorted(own.items(), key=lambda x: x[1])[:sample]]
        yield pa.RecordBatch.from_pylist([{"kind": k, "token": t, "h": h} for k, t, h in rows],
                                         pa.schema([("kind", pa.string()), ("token", pa.string()), ("h", pa.int64())]))

    rows = texts.mapInArrow(gather, "kind string, token string, h long").withColumn("part", F.spark_partition_id() % 199).distinct()
    # The least of each share of the tasks first, so that no task reads what all others pass on.
    for place in (["kind", "part"], ["kind"]):
        rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(*place).orderBy("h", "token"))).filter(F.col("n") <= sample)
        rows = rows.select("kind", "token", "h").distinct() if "part" in place else rows
    known: dict[str, list[str]] = {}
    for r in rows.orderBy("kind", "h", "token").collect():
        known.setdefault(r["kind"], []).append(r["token"])
    return Formats({k: v for k, v in known.items() if k in KINDS}, {k: v for k, v in known.items() if k not in KINDS})


def find_secrets(docs: DataFrame, formats: Formats | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, found``.

    ``base_sha256`` is of the fixed patterns' spans alone; ``spans`` has these and those of kind ``format``,
    by start and then kind; ``found`` lists all as structs with the secret and its log likelihood as a credential
    over that as an ordinary token, null where a base credential looks ordinary.
    Offsets count code points, ends are exclusive.  A null text is empty; rows are judged one by one.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind_of_id = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret", pa.string()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        order = [*KINDS, FOUND]
        for batch in pieces(batches, "text"):
            counts, digests, joined, found = [[], [], []], [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                every = [(s, e, k, text[s:e], (own and own.judge(c) or (k, None))[1]) for s, e, k, c in base]
                for s, e, token in candidates(text, base) if own is not None else ():
                    verdict = own.judge(token)
                    if verdict is not None:
                        every.append((s, e, FOUND, token, verdict[1]))
                every.sort(key=lambda x: (x[0], order.index(x[2])))
                for column, kind in zip(counts, KINDS):
                    column.append(sum(1 for x in base if x[2] == kind))
                digests.append(hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k, _ in base).encode()).hexdigest())
                joined.append(",".join(f"{k}:{s}:{e}" for s, e, k, *_ in every))
                found.append([{"kind": k, "start": s, "end": e, "secret": t, "score": v} for s, e, k, t, v in every])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
                 pa.array(joined, pa.string()), pa.array(found, pa.list_(struct))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])

    return rows.mapInArrow(scan, f"doc_id {kind_of_id}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
                                 "found array<struct<kind:string,start:int,end:int,secret:string,score:double>>")
