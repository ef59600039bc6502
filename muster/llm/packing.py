"""Packing of tokenized documents into training sequences.

Documents are cut into pieces of at most one sequence.  The pieces are dealt into random groups of bounded
size, and each group is packed on its own by first-fit decreasing: pieces in order of falling length go to
the first bin with room, which a tournament tree of the bins' free capacities finds in logarithmic time.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import Bounded, pieces
from muster.session import materialize

CAPACITY = 2048
END_ID = 1
GROUP_ITEMS = 8192
_ENDINGS = ".,!?;:%$#&*|"


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(plain))
    return table


_SUFFIX = "</w>"


@lru_cache(1)
def _encoder(path: str) -> tuple[Callable[[str], list[int]], tuple[str, ...]]:
    """A function from words, each with a space behind it for the mark of a word's end, to ids; and the special tokens.

    A merge is known here by the bytes it makes.  That gives the ids of the vocabulary's own merges, as these are
    numbered in order and the bytes of each come about by it alone (a test goes through all of them).
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte = {c: b for b, c in _byte_letters().items()}
    ranks = {bytes(byte[c] for c in t.removesuffix(_SUFFIX)) + b" " * t.endswith(_SUFFIX): i for t, i in content["model"]["vocab"].items()}
    encoding = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary, tuple(t["content"] for t in content["added_tokens"])


_SPACE, _LETTER, _OTHER, _DIGIT, _FAR = range(5)
# By the product of the kinds of two neighbours: whether a word ends between them.  Each digit is a word.
_ENDS = np.array([p in (_LETTER * _OTHER, _LETTER * _DIGIT, _OTHER * _DIGIT, _DIGIT * _DIGIT) for p in range(10)])
_CONTRACTION = re.compile("'(?:[stmd]|re|ve|ll)")


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Kind of each character of the basic plane; surrogates, private use, compatibility forms and unassigned are far."""
    by_category = {"L": _LETTER, "N": _DIGIT, "Cn": _FAR}
    categories = [unicodedata.category(chr(c)) for c in range(1 << 16)]
    kinds = np.array([by_category.get(c, by_category.get(c[0], _OTHER)) for c in categories], np.uint8)
    kinds[[c for c in range(1 << 16) if chr(c).isspace() and not 0x1C <= c <= 0x1F]] = _SPACE
    kinds[0xD800:0xFF00] = _FAR
    return kinds


def parted(text: str) -> str | None:
    """The words of a text as the vocabulary parts them, in lower case, a space or more behind each.

    Nothing if the text is not in composed form or has characters that are left to the whole tokenizer.
    """
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            return None
        text = text.replace("\u03a3", "\u03c3")  # letters are lowered one by one, so it has no final form
    text = text.lower()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(codes) == 0:
        return ""
    if not text.isascii() and codes.max() >= 1 << 16:
        return None
    kinds = _kinds()[codes]
    if kinds.max() == _FAR:
        return None
    ends = _ENDS[kinds[1:] * kinds[:-1]]
    for m in _CONTRACTION.finditer(text):
        start, end = m.span()
        if start == 0 or kinds[start - 1] != _OTHER:
            ends[start] = False
            ends[end - 1:end] = True
    at = np.arange(len(codes))
    at[1:] += np.cumsum(ends)
    out = np.full(at[-1] + 2, ord(" "), "<u4")
    out[at] = np.where(kinds == _SPACE, np.uint32(ord(" ")), codes)
    return out.tobytes().decode("utf-32-le")


MEMO_BYTES = 16 << 20  # of chunks, in each of two generations
SEGMENT = 1 << 16
_CUT = re.compile("[ \n\t]")


class ChunkIds(Bounded):
    """Packed little-endian ids of texts, and of chunks without white space, tokenized when first met.

    White space always parts words in this vocabulary, so the ids of a text are those of its chunks in order.
    Texts go in segments of whole chunks to the encoder of words.  A segment that cannot be parted into words here
    has its chunks looked up: those of letters with a plain ending go to the model at once, all others through the
    whole tokenizer.  A full memo becomes the earlier one, from which chunks that are met again come back.
    """

    def __init__(self, path: str, limit: int = MEMO_BYTES):
        super().__init__(limit)
        self.path = path
        self.letters = _byte_letters()
        self.earlier: dict[str, bytes] = {}
        self.encode, self.special = _encoder(path)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def model(self):
        return self.tokenizer.model

    def make_room(self) -> bool:
        if self.held < self.limit:
            return False
        self.earlier = dict(self)
        return super().make_room()

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _model_ids(self, letters: str) -> bytes:
        return self._pack([t.id for t in self.model.tokenize(letters)])

    def _lower(self, word: str) -> str:
        """A word of letters as the model takes it; nothing if its form needs the whole tokenizer."""
        if word.isascii():
            return word.lower()
        lower = "".join([c.lower() for c in word])
        return lower if lower.isalpha() and unicodedata.is_normalized("NFC", word) else ""

    def _ids(self, chunk: str) -> bytes:
        word = chunk.rstrip(_ENDINGS)
        lower = self._lower(word) if word.isalpha() else ""
        if not lower:
            return self._pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        if len(word) < len(chunk):
            return self[word] + self[chunk[len(word):]]
        if not lower.isascii():
            return self._model_ids("".join([self.letters[b] for b in lower.encode()]))
        return self._model_ids(lower) if lower == word else self[lower]

    def __missing__(self, chunk: str) -> bytes:
        ids = self.earlier.get(chunk)
        if ids is None:
            ids = self._ids(chunk)
        self.keep(chunk, ids)
        return ids

    def _looked_up(self, text: str) -> bytes:
        self.make_room()
        return b"".join([self[c] for c in text.replace("\n", " ").replace("\t", " ").split(" ") if c])

    def _segment(self, text: str) -> bytes:
        words = None if any(t in text for t in self.special) else parted(text)
        return self._looked_up(text) if words is None else array("I", self.encode(words)).tobytes()

    def of(self, text: str) -> bytes:
        if len(text) <= SEGMENT:
            return self._segment(text)
        found, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + SEGMENT)
            stop = cut.end() if cut else len(text)
            found.append(self._segment(text[start:stop]))
            start = stop
        return b"".join(found)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, its end id included.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``, ``piece_no`` (a number of its own)
    and, if asked for, the ``ids``.  Null and empty texts are the end id alone; rows are documents of their
    own even if their ids or texts repeat, and other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, piece_no long"
    schema += ", ids array<int>" if with_ids else ""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk_ids = ChunkIds(tokenizer_path)
        number = TaskContext.get().partitionId() << 40
        size = 4 * capacity
        for batch in pieces(batches, "text"):
            of, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                packed = chunk_ids.of(text or "") + end
                for at in range(0, len(packed), size):
                    part = packed[at:at + size]
                    of.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(packed) // 4)
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            columns = [batch.column("doc_id").take(pa.array(of, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            columns.append(pa.array(range(number, number + len(of)), pa.int64()))
            number += len(of)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece_no"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(cut, schema)


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item by first-fit decreasing; equal lengths keep their order.

    Leaf ``i`` of the tournament tree holds the free capacity of bin ``i``, each inner node the greatest of
    its leaves, so the first bin with room is found on one way down.
    """
    count = len(lengths)
    width = 1 << max(0, (count - 1).bit_length())
    free = [capacity] * (2 * width)
    bins, offsets = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        node = 1
        while node < width:
            node *= 2
            if free[node] < need:
                node += 1
        bins[item], offsets[item] = node - width, capacity - free[node]
        free[node] -= need
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
    return bins, offsets


def pack(table: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Sequence and offset of every row of ``table`` (``length`` from 1 to ``capacity``, ``piece_no``).

    Rows are dealt by a hash of ``piece_no`` into groups of about ``group_items`` and each group is packed in a
    task of its own; ``sequence_id`` is the group times 2^32 plus the bin.  No rows give no rows.
    """
    groups = max(1, -(-table.count() // group_items))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields if f.name != "piece_no")
    dealt = table.withColumn("_group", F.pmod(F.xxhash64("piece_no"), F.lit(groups)))

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by("piece_no")
        bins, offsets = first_fit(group.column("length").to_numpy(), capacity)
        bins += group.column("_group")[0].as_py() << 32
        group = group.drop_columns(["_group", "piece_no"])
        return group.append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("_group").applyInArrow(fill, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   group_items: int = GROUP_ITEMS, **options) -> DataFrame:
    """``token_pieces`` of the documents, written once, with the place ``pack`` gives them."""
    cut = materialize(token_pieces(docs, tokenizer_path, capacity=capacity, **options), "pieces")
    return pack(cut, capacity, group_items)
