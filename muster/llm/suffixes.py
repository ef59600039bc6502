"""Byte strings that occur more than once in a table of texts, by suffix sorting in two stages.

Only places that may repeat are sorted.  Every window of ``length`` bytes has an anchor, the place of the least
hash among the runs of ``RUN`` bytes in it; equal windows have equal anchors, so windows are dealt by the hash of
their anchor, and an anchor hash met at one place only rules out all of its windows.  Each task sorts the suffixes
at its windows' starts, as far as ``length`` bytes: those smaller than their successor, and the last of each run of
starts, are sorted directly; the rest is induced by scanning the buckets of first bytes in order.  Windows
next to each other in that order with a common prefix of ``length`` bytes repeat.
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

LENGTH = 400
RUN = 64
HOT = 4000  # places of one anchor hash from which its windows are dealt more finely
FINE = 16  # starts of a window in such a part
CHUNK = 200_000  # starts that are sorted together, unless one anchor hash has more

_DRAW = np.random.default_rng(20)
_BYTES = _DRAW.integers(0, 2 ** 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2 ** 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Anchors:
    """Anchors of the windows of texts; tables of powers grow with the longest text met."""

    def __init__(self, length: int, run: int):
        self.length, self.run, self.up, self.down = length, run, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash and place of every anchor, and the first and number of the window starts that have it."""
        size = len(text)
        if size > len(self.up):
            self.up, self.down = _powers(_FACTOR, 2 * size), _powers(_INVERSE, 2 * size)
        raw = np.frombuffer(text, np.uint8)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTES[raw] * self.up[:size], out=total[1:])
        hashes = (total[self.run:] - total[:-self.run]) * self.down[:size - self.run + 1]
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
        # The least hash, and of equal ones the first place, over a sliding stretch by doubling.
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        width, reach = self.length - self.run + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        count = np.diff(np.append(first, len(place)))
        return hashes[place[first]].view(np.int64), place[first], first, count


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each byte is smaller than its successor; equal bytes are as what follows them."""
    step = np.sign(text[1:].astype(np.int16) - text[:-1])
    places = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(places[::-1])[::-1]
    decided = np.append(step, np.int16(-1))[following]
    return np.append(decided > 0, False)


def sort_windows(text: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """The starts in the order of the first ``length`` bytes of their suffixes, by two-stage sorting.

    ``starts`` rise, and each has ``length`` bytes after it.  A start is sorted directly if its suffix is smaller
    than its successor, or if its successor is no start; all others begin with a byte not less than the next, so
    the order of their successors, scanned bucket by bucket, is theirs.
    """
    raw = np.frombuffer(text, np.uint8)
    is_start = np.zeros(len(raw) + 1, bool)
    is_start[starts] = True
    smaller = _smaller(raw)
    direct = starts[smaller[starts] | ~is_start[starts + 1]]
    induced = np.zeros(len(raw) + 1, bool)
    induced[starts] = True
    induced[direct] = False
    ordered = np.array(sorted(direct.tolist(), key=lambda s: text[s:s + length]), np.int64)
    by_byte = np.split(ordered, np.searchsorted(raw[ordered], np.arange(1, 256)))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for byte in range(256):
        # Induced starts whose next byte is smaller, in the order of their successors.
        bucket, latest = [], np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        own = by_byte[byte]
        if not len(latest) and not len(own):
            continue
        # A direct start without successor may lie anywhere among the induced ones of its byte; those of
        # which the successor is smaller are merged in by comparison, the others come last.
        low = ~smaller[own]
        lone, own = own[low], own[~low]
        while len(latest):
            bucket.append(latest)
            before = latest - 1
            latest = before[(latest > 0) & induced[before] & (raw[before] == byte)]
        if len(lone):
            # Induced starts of a lone one follow from it within the bucket; the few are sorted with it.
            chain, grown = [lone], lone
            while len(grown):
                before = grown - 1
                grown = before[(grown > 0) & induced[before] & (raw[before] == byte)]
                chain.append(grown)
            few = sorted(np.concatenate(chain).tolist(), key=lambda s: text[s:s + length])
            many = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
            bucket = [_merge(text, many, np.array(few, np.int64), length)]
        done = np.concatenate([*bucket, own]) if bucket else own
        out.append(done)
        before = done - 1
        before = before[(done > 0) & induced[before]]
        before = before[raw[before] > byte]
        keys = raw[before]
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        for part in np.split(before[order], cuts):
            if len(part):
                waiting[raw[part[0]]].append(part)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _merge(text: bytes, one: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
    """Two sorted arrays of starts as one, by binary search of the second's in the first."""
    places = []
    for s in other.tolist():
        key, low, high = text[s:s + length], 0, len(one)
        while low < high:
            middle = (low + high) // 2
            at = int(one[middle])
            if text[at:at + length] < key:
                low = middle + 1
            else:
                high = middle
        places.append(low)
    return np.insert(one, places, other)


def common_prefixes(text: bytes, ordered: np.ndarray, length: int) -> np.ndarray:
    """Bytes that each start's suffix has in common with the one before it in order, ``length`` at most."""
    raw = np.frombuffer(text, np.uint8)
    common = np.zeros(len(ordered), np.int32)
    alive = np.arange(1, len(ordered))
    for at in range(0, length, 8):
        if not len(alive):
            break
        width = min(8, length - at)
        span = np.arange(at, at + width)
        same = raw[ordered[alive][:, None] + span] == raw[ordered[alive - 1][:, None] + span]
        whole = same.all(axis=1)
        common[alive] += np.where(whole, width, same.argmin(axis=1)).astype(np.int32)
        alive = alive[whole]
    return common


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """Of each segment, which of its window starts have a window that another start has as well."""
    numbers: dict[bytes, int] = {}
    times: list[int] = []
    for s in segments:
        number = numbers.setdefault(s, len(numbers))
        if number == len(times):
            times.append(0)
        times[number] += 1
    different = list(numbers)
    ends = np.cumsum([len(s) for s in different])
    starts = np.concatenate([np.arange(e - len(s), e - length + 1) for s, e in zip(different, ends)])
    text = b"".join(different)
    ordered = sort_windows(text, starts, length)
    whole = common_prefixes(text, ordered, length) >= length
    again = np.zeros(len(text), bool)
    again[ordered[whole]] = True
    again[ordered[:-1][whole[1:]]] = True
    flags = [again[e - len(s):e - length + 1] | (n > 1) for s, e, n in zip(different, ends, times)]
    return [flags[numbers[s]] for s in segments]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return [(s, e) for s, e in merged]


def _text_key(text: bytes) -> int:
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "big", signed=True)


def repeated_spans(texts: DataFrame, length: int = LENGTH, run: int = RUN, hot: int = HOT, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Texts that may repeat something, and the spans of windows that do.

    ``texts`` has a column ``text``.  The first table has ``tid, text``, the second ``tid, start, end`` in bytes.
    ``tid`` is from a cryptographic hash of the text, so copies count once here.
    """

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, met = Anchors(length, run), set()
        for batch in pieces(batches, "text"):
            parts, ids = [], []
            for text in utf8(batch, "text"):
                if len(text) >= length and (tid := _text_key(text)) not in met:
                    met.add(tid)
                    parts.append(finder.of(text))
                    ids.append(tid)
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                owner = np.repeat(np.array(ids, np.int64), [len(p[0]) for p in parts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), pa.array(owner), *[pa.array(c.astype(np.int32)) for c in columns[1:]]],
                    ["key", "tid", "place", "first", "starts"])

    anchors = materialize(texts.mapInArrow(anchor, "key long, tid long, place int, first int, starts int"), "anchors")
    spot = F.struct("tid", "place")
    keys = anchors.groupBy("key").agg(F.min(spot).alias("a"), F.max(spot).alias("b"), F.count(F.lit(1)).alias("n"))
    keys = materialize(keys.filter("a <> b").select("key", (F.col("n") > hot).alias("hot")), "keys")
    entry = F.struct("key", "hot", "place", "first", "starts")
    places = materialize(anchors.join(keys, "key").groupBy("tid").agg(F.collect_set(entry).alias("places")), "places")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in pieces(batches, "text"):
            rows, ids = [], []
            for i, text in enumerate(utf8(batch, "text")):
                if len(text) >= length and (tid := _text_key(text)) not in met:
                    met.add(tid)
                    rows.append(i)
                    ids.append(tid)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), batch.column("text").take(pa.array(rows, pa.int64()))], ["tid", "text"])

    found = texts.mapInArrow(once, "tid long, text string").join(places, "tid")
    found = materialize(found, "found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of each anchor's windows; those of hot ones in parts, dealt by the bytes all their windows share.

        A task sends the same bytes twice at most, which is enough to tell that they repeat; where it meets them
        again, all of their windows do, and only the place goes on.
        """
        times: dict[tuple[int, bytes], int] = {}
        for batch in pieces(batches, "text", 1 << 20):
            out = {"key": [], "tid": [], "first": [], "end": [], "bytes": []}
            for tid, text, own in zip(batch.column("tid").to_pylist(), utf8(batch, "text"), batch.column("places").to_pylist()):
                for p in own:
                    first, last = p["first"], p["first"] + p["starts"]
                    cuts = [(p["key"], first, last)]
                    if p["hot"]:
                        # Cut by distance to the anchor, so that equal windows are cut alike.
                        edges = sorted({first, last, *(x for x in range(p["place"] + 1, first, -FINE) if x < last)})
                        cuts = []
                        for s, e in zip(edges, edges[1:]):
                            top = p["place"] - (p["place"] - e + 1) // FINE * FINE
                            core = text[top:top - FINE + 1 + length]
                            digest = hashlib.blake2b(core, digest_size=8, key=p["key"].to_bytes(8, "big", signed=True)).digest()
                            cuts.append((int.from_bytes(digest, "big", signed=True) ^ (p["place"] - top), s, e))
                    for key, s, e in cuts:
                        content = text[s:e - 1 + length]
                        seen = (key, hashlib.blake2b(content, digest_size=16).digest())
                        times[seen] = times.get(seen, 0) + 1
                        sent = times[seen] <= 2
                        out["key"].append(key if sent else tid)
                        out["tid"].append(tid)
                        out["first"].append(s)
                        out["end"].append(e - 1 + length)
                        out["bytes"].append(content if sent else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["key"], pa.int64()), pa.array(out["tid"], pa.int64()), pa.array(out["first"], pa.int32()), pa.array(out["end"], pa.int32()), pa.array(out["bytes"], pa.binary())],
                ["key", "tid", "first", "end", "bytes"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of whole anchor hashes, each sorted on its own."""
        waiting, size, last = [], 0, None

        def settle():
            flags = repeated_starts([w[3] for w in waiting], length)
            ids, start, end = [], [], []
            for (_, tid, first, _), own in zip(waiting, flags):
                if own.any():
                    s, e = _runs(own)
                    ids += [tid] * len(s)
                    start += (s + first).tolist()
                    end += (e + (first - 1 + length)).tolist()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["tid", "start", "end"])

        for batch in batches:
            known = batch.filter(pc.is_null(batch.column("bytes")))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays([known.column(n) for n in ("tid", "first", "end")], ["tid", "start", "end"])
            batch = batch.filter(pc.is_valid(batch.column("bytes")))
            for row in zip(*(batch.column(n).to_pylist() for n in ("key", "tid", "first", "bytes"))):
                if size >= chunk and row[0] != last:
                    yield settle()
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[3]) - length + 1
                last = row[0]
        if waiting:
            yield settle()

    segments = found.select("tid", "text", "places").mapInArrow(cut, "key long, tid long, first int, end int, bytes binary")
    spans = segments.repartition("key").sortWithinPartitions("key").mapInArrow(sort, "tid long, start int, end int")
    return found.select("tid", "text"), materialize(spans, "spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, without bytes that repeat elsewhere.

    A byte goes if a string of ``length`` bytes covers it that starts at another place too, in the same or any
    other row.  Rows are texts of their own, so a copy of a long enough text is removed whole, and so is what it is a
    copy of.  Null texts are empty; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found, spans = repeated_spans(rows.select("text"), length, **options)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            digests, removed, counts = [], [], []
            for text, own in zip(utf8(batch, "text"), batch.column("spans").to_pylist()):
                merged = merge_spans([(s["start"], s["end"]) for s in own])
                rest, at = hashlib.sha256(), 0
                for s, e in merged:
                    rest.update(text[at:s])
                    at = e
                rest.update(text[at:])
                digests.append(rest.hexdigest())
                removed.append(sum(e - s for s, e in merged))
                counts.append(len(merged))
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
                ["tid", "n_removed", "n_spans", "kept_sha256"])

    listed = spans.groupBy("tid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    results = found.join(listed, "tid").mapInArrow(keep, "tid long, n_removed long, n_spans long, kept_sha256 string")
    results = materialize(results.dropDuplicates(["tid"]), "results")
    sha = F.sha2(F.col("text").cast("binary"), 256)
    every = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), sha.alias("_sha"))
    every = every.withColumn("tid", F.conv(F.left("_sha", F.lit(16)), 16, -10).cast("long"))
    every = materialize(every, "texts")
    copies = materialize(every.filter(F.col("n_bytes") >= length).groupBy("tid").count().filter("count > 1").select("tid", F.lit(True).alias("copy")), "copies")
    changed = materialize(results.join(copies, "tid", "full").select("tid", "n_removed", "n_spans", "kept_sha256", "copy"), "changed")
    joined = every.join(changed, "tid", "left")
    copy = F.coalesce(F.col("copy"), F.lit(False))
    return joined.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"),
    )
