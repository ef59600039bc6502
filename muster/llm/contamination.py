"""Benchmark passages in documents, found by a prefix-filtered join of word windows.

A window is a run of consecutive item words.  A document contains a window only if it contains every word
of it, so one necessary word is enough to meet it: the window's rarest in the corpus, its prefix under the
order by rarity.  Where a document has that word, the word's place in the window fixes where the window must
start, the window must lie within the document, and its words are then compared one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import pieces, utf8

WINDOW = 13
BLOCK_BYTES = 32 << 20
# Bytes that are no part of a word become spaces; A-Z has been lowered before.
_SPACES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Runs of digits, a-z and bytes beyond ASCII, with A-Z lowered."""
    return text.lower().translate(_SPACES).split()


class WindowIndex:
    """The windows of some items, by their rarest word."""

    def __init__(self, items: list[tuple], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.starts: dict[tuple, list] = {}
        for item_id, text in items:
            found = words((text or "").encode())
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found)
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                self.starts.setdefault(ids[i:i + size], []).append(item_id)

    def order(self, counts: dict[int, int]) -> WindowIndex:
        """Index every window by the word that is rarest by ``counts``; ties go to the lesser number."""
        self.by_word: dict[int, list] = {}
        for ids in self.starts:
            at = min(range(len(ids)), key=lambda k: (counts.get(ids[k], 0), ids[k], k))
            self.by_word.setdefault(ids[at], []).append((at, ids))
        self.is_prefix = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        self.is_prefix[list(self.by_word)] = True
        return self

    def encode(self, found: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in found], dtype=np.int32)

    def hits(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set]:
        """Merged ranges of words inside windows, and the items that have these windows."""
        ranges, items = [], set()
        places = np.flatnonzero(self.is_prefix[ids])
        if len(places):
            tokens = ids.tolist()
            for place in places.tolist():
                for at, window in self.by_word[tokens[place]]:
                    start = place - at
                    if start >= 0 and start + len(window) <= len(tokens):
                        if tuple(tokens[start:start + len(window)]) == window:
                            ranges.append((start, start + len(window)))
                            items.update(self.starts[window])
        return _merge(ranges), items - {None}


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """The items in blocks whose texts have at most ``limit`` bytes, one block at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append(tuple(row))
        size += len((row[1] or "").encode())
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def word_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> dict[int, int]:
    """Occurrences of each vocabulary word in all documents; one row per word and task reaches the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, total = shared.value.get, np.zeros(len(shared.value) + 1, np.int64)
        for batch in pieces(batches, "text"):
            for text, times in Counter(utf8(batch, "text")).items():
                ids = np.array([get(w, 0) for w in words(text)], dtype=np.int64)
                total += times * np.bincount(ids, minlength=len(total))
        seen = np.flatnonzero(total)
        seen = seen[seen > 0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["word", "n"])

    counted = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {row["word"]: row["n"] for row in counted.toLocalIterator()}


def mark_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, share: int = 20, keep: bool = False,
) -> DataFrame:
    """Words of every document that lie in a window of an item.

    One row per document row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, the hit ranges
    of words as ``spans`` and the ``items``; with ``keep`` the columns of ``docs`` come first (but for those
    of these names).  A document is contaminated if it has hit words and they are at least one in ``share``.
    An item of fewer words than the ``window`` is one window, one without words none.  Null texts have no
    words; repeated rows are judged alike, and items that share an id count once.  The windows of an item without id hit
    words as any others do, but it is not among the ``items``.

    Items are broadcast in blocks of at most ``block_bytes`` of text; documents pass through one step
    per block, without a shuffle.
    """
    named = {"_text": F.coalesce(F.col(text_col), F.lit("")), "_spans": F.lit(None).cast("array<struct<start:int,end:int>>"),
             "_items": F.lit(None).cast("array<string>"), "_n": F.lit(0).cast("long")}
    table = docs.select(*(docs.columns if keep else [F.col(id_col).alias("doc_id")]), *[c.alias(n) for n, c in named.items()])
    kinds = table.schema
    context = docs.sparkSession.sparkContext
    chosen = items.select(F.col(item_col).cast("string"), F.col(item_text))

    def step(shared):
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            for batch in pieces(batches, "_text"):
                spans, named_items, counts = [], [], []
                before = zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist())
                known: dict[bytes, tuple] = {}
                for text, (old, old_items) in zip(utf8(batch, "_text"), before):
                    if text not in known:
                        found = words(text)
                        known[text] = (len(found), *index.hits(index.encode(found)))
                    n, ranges, hit = known[text]
                    ranges = _merge([(s["start"], s["end"]) for s in old or []] + ranges)
                    spans.append([{"start": s, "end": e} for s, e in ranges])
                    named_items.append(sorted(hit.union(old_items or []), key=lambda x: x.encode()))
                    counts.append(n)
                new = {"_spans": pa.array(spans, pa.list_(span)), "_items": pa.array(named_items, pa.list_(pa.string())),
                       "_n": pa.array(counts, pa.int64())}
                columns = [new.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return match

    met = False
    for block in _blocks(chosen, block_bytes):
        met = True
        index = WindowIndex(block, window)
        index.order(word_counts(table.select(F.col("_text").alias("text")), index.vocabulary) if index.vocabulary else {})
        table = table.mapInArrow(step(context.broadcast(index)), kinds)
    if not met:  # no items: only the words are counted
        table = table.mapInArrow(step(context.broadcast(WindowIndex([], window).order({}))), kinds)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    results = {
        "n_words": F.col("_n"), "n_hit": hit, "n_items": F.size("_items").cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", "_items"), 256),
        "contaminated": (hit > 0) & (share * hit >= F.col("_n")),
        "spans": F.col("_spans"), "items": F.col("_items"),
    }
    kept = [c for c in (docs.columns if keep else ["doc_id"]) if c not in results]
    return table.select(*kept, *[c.alias(n) for n, c in results.items()])


