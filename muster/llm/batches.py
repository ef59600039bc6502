"""Arrow batches of texts in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20


def pieces(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches whose texts have at most ``limit`` bytes.

    A single longer text makes a batch of its own; no text is cut.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


class Bounded(dict):
    """What a task remembers of texts; ``make_room`` forgets all of it once keys and values hold ``limit`` bytes."""

    def __init__(self, limit: int = 16 << 20):
        super().__init__()
        self.limit, self.held = limit, 0

    def keep(self, key, value) -> None:
        self[key] = value
        self.held += 240 + len(key) + (len(value) if isinstance(value, (bytes, str)) else 0)

    def make_room(self) -> bool:
        """Whether everything was forgotten."""
        if self.held < self.limit:
            return False
        self.clear()
        self.held = 0
        return True


class Met(set):
    """Keys a task has met; it forgets them once there are ``limit``, so a key may seem new again."""

    def __init__(self, limit: int = 50_000):
        super().__init__()
        self.limit = limit

    def new(self, key) -> bool:
        if key in self:
            return False
        if len(self) >= self.limit:
            self.clear()
        self.add(key)
        return True


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as bytes; null is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def flat(lists: list[np.ndarray], kind) -> pa.ListArray:
    """A list column from one array per row."""
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.concatenate(lists) if lists else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark) -> None:
    """Have Spark send texts to Python in batches of few bytes, as ten thousand long ones would fill a task's memory."""
    if int(spark.conf.get(_BATCH_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
