"""Passages of words that an earlier document holds too, by suffix trees over groups of suffixes with a common prefix.

Only suffixes that may repeat are compared.  Every window of ``length`` words has an anchor, the run of ``RUN`` words
with the least hash in it, which equal windows share; the suffixes that start at one anchor's windows go to one group, and an
anchor met in one text only rules out all of its windows.  The prefix that a group has in common is variable: a run met
at more than ``HOT`` places is lengthened to all the ``length`` words of each window, so that groups fit in memory whatever their number of
copies.  Each task grows the trees of its groups from the root, reading as many words ahead as the suffixes of a node agree on;
the nodes ``length`` words deep are repeated passages, and the least document below such a node keeps its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import pieces, utf8
from muster.session import materialize

LENGTH = 50
RUN = 8
HOT = 2000  # places of a run from which its windows are grouped by all of their words
CHUNK = 150_000  # windows whose trees are grown together, unless one run has more
AHEAD = 16  # words that are compared at once where a node's suffixes may agree
MEMO = 50_000  # texts or passages that a task remembers at a time

_DRAW = np.random.default_rng(11)
_BYTES = _DRAW.integers(0, 2 ** 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _DRAW.integers(0, 2 ** 63, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_DRAW.integers(0, 2 ** 63)) * 2 + 1
_PARTS = np.zeros(256, bool)
_PARTS[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of the words of several texts at a time; tables of powers grow with the texts."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words, and where each text's begin, with the end of the last."""
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if len(raw) > len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(raw)), _powers(pow(_BASE, -1, 2 ** 64), 2 * len(raw))
        edges = np.flatnonzero(np.diff(_PARTS[raw], prepend=True))
        starts, ends = edges[::2], edges[1::2]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * self.up[:len(raw)], out=total[1:])
        hashes = _mixed((total[ends] - total[starts]) * self.down[starts])
        return hashes, np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))


def anchors(words: np.ndarray, bounds: np.ndarray, length: int, run: int) -> tuple[np.ndarray, ...]:
    """``text, key, first, starts``: the hash of every anchor, the first and the number of the windows that have it."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    count = len(words) - length + 1
    if count <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    hashes = np.zeros(len(words) - run + 1, np.uint64)
    for k in range(run):
        hashes = _mixed(hashes + words[k:k + len(hashes)] * _FACTORS[k])
    # The least hash, and of equal ones the first place, over a sliding stretch by doubling.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width, reach = length - run + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.flatnonzero(owner[:count] == owner[length - 1:])
    if not len(inside):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    place, text = place[inside], owner[inside]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    starts = np.diff(np.append(new, len(inside)))
    return text[new], hashes[place[new]].view(np.int64), inside[new] - bounds[text[new]], starts


def least_below(words: np.ndarray, starts: np.ndarray, group: np.ndarray, owner: np.ndarray, length: int, ahead: int = AHEAD) -> np.ndarray:
    """For each suffix, the least owner below its node at a depth of ``length`` words; its own where no other is there.

    ``group`` parts the suffixes into trees.  A node of one owner is not grown further, as nothing in it repeats.
    """
    least = owner.copy()
    _, ids = np.unique(words, return_inverse=True)
    bits = max(1, int(ids.max(initial=0)).bit_length())
    waiting = {0: [(np.arange(len(starts)), group)]}
    while waiting:
        depth = min(waiting)
        parts = waiting.pop(depth)
        shift, node = 0, []
        for _, n in parts:
            node.append(n + shift)
            shift += int(n.max(initial=0)) + 1
        here, node = np.concatenate([p[0] for p in parts]), np.concatenate(node)
        _, node = np.unique(node, return_inverse=True)
        if depth < length:
            # Children are told apart by as many words as fit a number beside the node's.
            width = max(1, min(length - depth, (62 - int(len(here)).bit_length()) // bits))
            code = node.astype(np.int64)
            for k in range(width):
                code = (code << bits) | ids[starts[here] + depth + k]
            _, node = np.unique(code, return_inverse=True)
            depth += width
        low, high = np.full(len(here), np.iinfo(np.int64).max), np.full(len(here), np.iinfo(np.int64).min)
        np.minimum.at(low, node, owner[here])
        np.maximum.at(high, node, owner[here])
        alive = low[node] < high[node]
        here, node = here[alive], node[alive]
        if not len(here):
            continue
        if depth == length:
            least[here] = low[node]
            continue
        # Where all suffixes of a node agree on the words ahead, the way to the next node is one edge.
        step = min(ahead, length - depth)
        first = np.zeros(int(node.max()) + 1, np.int64)
        first[node] = here
        span = np.arange(depth, depth + step)
        same = (ids[starts[here][:, None] + span] == ids[starts[first[node]][:, None] + span]).all(axis=1)
        apart = np.zeros(len(first), bool)
        apart[node[~same]] = True
        for chosen, to in ((apart[node], depth), (~apart[node], depth + step)):
            if chosen.any():
                waiting.setdefault(to, []).append((here[chosen], node[chosen]))
        if depth + step == length and length in waiting:
            for part, n in waiting.pop(length):
                least[part] = low[n]
    return least


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def _joined(words: list[bytes]) -> tuple[bytes, str]:
    """Name of a sequence of words, and the digest of the words joined by spaces."""
    sha = hashlib.sha256(b" ".join(words))
    return sha.digest()[:16], sha.hexdigest()


class _Once:
    """Which names a task meets for the first time, as far as it remembers."""

    def __init__(self):
        self.met: set[bytes] = set()

    def __call__(self, name: bytes) -> bool:
        if name in self.met:
            return False
        if len(self.met) >= MEMO:
            self.met.clear()
        self.met.add(name)
        return True


def passages(docs: DataFrame, texts: DataFrame, length: int = LENGTH, run: int = RUN, hot: int = HOT, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Texts that may repeat a passage, ``tid, text``, and spans of words that an earlier document has, ``tid, start, end``.

    ``docs`` has a column ``text``; ``texts`` names each different sequence of words, ``tid, least``, with the least
    document that has it.
    """

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, once = WordHashes(), _Once()
        for batch in pieces(batches, "text"):
            ids, own = [], []
            for text in utf8(batch, "text"):
                words = text.split()
                if len(words) >= length and once(tid := _joined(words)[0]):
                    ids.append(tid)
                    own.append(text)
            if own:
                text, key, first, starts = anchors(*hasher.of(own), length, run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.binary()).take(pa.array(text)), pa.array(np.array([int.from_bytes(i[:8], "little", signed=True) for i in ids])[text]),
                     pa.array(key), pa.array(first.astype(np.int32)), pa.array(starts.astype(np.int32))], ["tid", "number", "key", "first", "starts"])

    found = materialize(docs.select("text").mapInArrow(anchor, "tid binary, number long, key long, first int, starts int"), "anchors")
    keys = found.groupBy("key").agg(F.min("number").alias("x"), F.max("number").alias("y"), F.count(F.lit(1)).alias("n"))
    keys = materialize(keys.filter("x <> y").select("key", (F.col("n") > hot).alias("hot")), "keys")
    spot = F.struct("key", "hot", "first", "starts")
    places = found.join(keys, "key").groupBy("tid").agg(F.collect_set(spot).alias("places"))
    places = materialize(materialize(places, "places").join(texts, "tid"), "named")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = _Once()
        for batch in pieces(batches, "text"):
            ids, rows = [], []
            for i, text in enumerate(utf8(batch, "text")):
                words = text.split()
                if len(words) >= length and fresh(tid := _joined(words)[0]):
                    ids.append(tid)
                    rows.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column("text").take(pa.array(rows, pa.int64()))], ["tid", "text"])

    candidates = materialize(docs.select("text").mapInArrow(once, "tid binary, text string").join(places, "tid"), "candidates")
    names = ["tid", "least", "first", "end", "key", "words"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of each run's windows, as hashes; where a task knows an earlier document that has the same, the span alone."""
        hasher, earlier = WordHashes(), {}
        for batch in pieces(batches, "text", 1 << 19):
            words, bounds = hasher.of(utf8(batch, "text"))
            out = {n: [] for n in names}
            for tid, least, own, at in zip(*(batch.column(n).to_pylist() for n in ("tid", "least", "places")), bounds.tolist()):
                for p in own:
                    if p["hot"]:
                        continue
                    first, end = p["first"], p["first"] + p["starts"] - 1 + length
                    content = words[at + first:at + end].tobytes()
                    name = hashlib.blake2b(content, digest_size=16).digest()
                    known = earlier.get(name)
                    if known is None or known > least:
                        if len(earlier) >= MEMO:
                            earlier.clear()
                        earlier[name] = least
                    repeats = known is not None and known < least
                    for n, v in zip(names, (tid, least, first, end, p["key"] if not repeats else least, None if repeats else content)):
                        out[n].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["tid"], pa.binary()), pa.array(out["least"], pa.int64()), *[pa.array(out[n], pa.int32()) for n in ("first", "end")],
                 pa.array(out["key"], pa.int64()), pa.array(out["words"], pa.binary())], names)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans of the windows that an earlier document has, from the trees of whole groups."""
        waiting, size, last = [], 0, None

        def settle():
            lengths = np.array([len(w[4]) // 8 for w in waiting])
            counts, begins = lengths - length + 1, np.cumsum(lengths) - lengths
            text = np.frombuffer(b"".join(w[4] for w in waiting), np.uint64)
            segment = np.repeat(np.arange(len(waiting)), counts)
            within = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
            _, group = np.unique(np.array([w[0] for w in waiting]), return_inverse=True)
            owner = np.array([w[2] for w in waiting], np.int64)[segment]
            hit = least_below(text, begins[segment] + within, group[segment], owner, length) < owner
            joined = hit[1:] & hit[:-1] & (segment[1:] == segment[:-1])
            opens = np.flatnonzero(hit & ~np.concatenate([[False], joined]))
            closes = np.flatnonzero(hit & ~np.concatenate([joined, [False]]))
            first = np.array([w[3] for w in waiting])
            return pa.RecordBatch.from_arrays(
                [pa.array([waiting[s][1] for s in segment[opens].tolist()], pa.binary()), pa.array((first[segment[opens]] + within[opens]).astype(np.int32)),
                 pa.array((first[segment[closes]] + within[closes] + length).astype(np.int32))], ["tid", "start", "end"])

        for batch in batches:
            known = batch.filter(pc.is_null(batch.column("words")))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays([known.column(n) for n in ("tid", "first", "end")], ["tid", "start", "end"])
            batch = batch.filter(pc.is_valid(batch.column("words")))
            for row in zip(*(batch.column(n).to_pylist() for n in ("key", "tid", "least", "first", "words"))):
                if size >= chunk and row[0] != last:
                    yield settle()
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[4]) // 8 - length + 1
                last = row[0]
        if waiting:
            yield settle()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests of all words of each window of the hot runs; where a task knows an earlier document that has all of them, the span alone."""
        hasher, earlier = WordHashes(), {}
        for batch in pieces(batches, "text", 1 << 19):
            words, bounds = hasher.of(utf8(batch, "text"))
            raw, prefix, tids, leasts, starts, ends = words.tobytes(), [], [], [], [], []
            rows = list(zip(*(batch.column(n).to_pylist() for n in ("tid", "least", "places")), bounds.tolist()))
            for tid, least, own, at in sorted(rows, key=lambda r: r[1]):
                for p in own:
                    if not p["hot"]:
                        continue
                    first, end = p["first"], p["first"] + p["starts"] - 1 + length
                    name = hashlib.blake2b(raw[8 * (at + first):8 * (at + end)], digest_size=16).digest()
                    known = earlier.get(name)
                    if known is None or known > least:
                        if len(earlier) >= MEMO:
                            earlier.clear()
                        earlier[name] = least
                    if known is not None and known < least:
                        prefix.append(None)
                        starts.append(first)
                        ends.append(end)
                    else:
                        prefix += [hashlib.blake2b(raw[8 * (at + s):8 * (at + s + length)], digest_size=16).digest() for s in range(first, end - length + 1)]
                        starts += range(first, end - length + 1)
                        ends += range(first + length, end + 1)
                    tids += [tid] * (len(prefix) - len(tids))
                    leasts += [least] * (len(prefix) - len(leasts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix, pa.binary()), pa.array(tids, pa.binary()), pa.array(leasts, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                ["prefix", "tid", "least", "start", "end"])

    segments = candidates.mapInArrow(cut, "tid binary, least long, first int, end int, key long, words binary")
    spans = materialize(segments.repartition("key").sortWithinPartitions("key").mapInArrow(grow, "tid binary, start int, end int"), "spans")
    # A group that has all words of its windows in common is a node already.
    windows = materialize(candidates.mapInArrow(whole, "prefix binary, tid binary, least long, start int, end int"), "windows")
    known = windows.filter("prefix IS NULL").select("tid", "start", "end")
    windows = windows.filter("prefix IS NOT NULL")
    nodes = windows.groupBy("prefix").agg(F.min("least").alias("m"), F.max("least").alias("x")).filter("m < x").select("prefix", "m")
    nodes = materialize(nodes, "nodes")
    hits = materialize(windows.join(nodes, "prefix").filter("m < least").select("tid", "start", "end"), "hits")
    return candidates.select("tid", "text"), spans.unionByName(known).unionByName(hits)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, without passages that start in an earlier document too.

    Words are parted by ASCII white space.  A word goes if ``length`` consecutive words of its document cover it that also
    start, word by word, in a document of a smaller id.  Ids are integers; rows of one id leave each other's words alone,
    and a row without id neither loses words nor makes others lose any.  Null texts have no words; no
    rows, no rows; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = [t.split() for t in utf8(batch, "text")]
            names = [_joined(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), pa.array([n[0] for n in names], pa.binary()), pa.array([n[1] for n in names], pa.string())],
                ["doc_id", "n_words", "tid", "kept_sha256"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            removed, digests = [], []
            for text, own in zip(utf8(batch, "text"), batch.column("spans").to_pylist()):
                words, rest, at, gone = text.split(), [], 0, 0
                for s, e in merged([(s["start"], s["end"]) for s in own]):
                    rest += words[at:s]
                    at, gone = e, gone + e - s
                removed.append(gone)
                digests.append(_joined(rest + words[at:])[1])
            yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], ["tid", "lost", "rest"])

    every = materialize(rows.mapInArrow(name, f"doc_id {kind}, n_words long, tid binary, kept_sha256 string"), "texts")
    held = every.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= length)).withColumn("doc", F.col("doc_id").cast("long"))
    held = materialize(held.groupBy("tid").agg(F.min("doc").alias("least"), F.max("doc").alias("last")), "held")
    candidates, spans = passages(rows.filter("doc_id IS NOT NULL"), held.select("tid", "least"), length, **options)
    listed = spans.groupBy("tid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    results = candidates.join(listed, "tid").mapInArrow(keep, "tid binary, lost long, rest string")
    results = materialize(results.groupBy("tid").agg(F.max("lost").alias("lost"), F.max("rest").alias("rest")), "results")
    copies = held.filter("least < last").select("tid", "least")
    changed = materialize(results.join(copies, "tid", "full"), "changed")
    joined = every.join(changed, "tid", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    lone = F.col("doc_id").isNull()
    return joined.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(lone, 0).otherwise(F.coalesce("lost", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, hashlib.sha256(b"").hexdigest()).when(lone, F.col("kept_sha256")).otherwise(F.coalesce("rest", "kept_sha256")).alias("kept_sha256"))
