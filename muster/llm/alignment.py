"""Alignment of two tokenizers over a table of documents, each distinct text once.

Texts are shuffled whole, so that copies meet and count as one with a multiplicity.  Every distinct text is
tokenized both ways and cut where tokens of both end; tokens of either side whose bytes overlap are linked.  How
many documents hold a pair of ids linked is the sum of the multiplicities of the texts that do, and what texts owe to
these counts goes back to every document by the digest of its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import flat, pieces
from muster.session import materialize

LISTED = 1 << 20  # pairs of ids whose counts all tasks hold, 17 bytes each; the counts of all others are joined
PARTIAL = 1 << 21  # pairs that a task counts before it passes them on

_SPACE = "▁"

# Fixed value: how byte-level vocabularies of this family part a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Ids and bytes of a byte-level vocabulary whose ids are in the order of its merges; special tokens' strings are plain text."""

    def __init__(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"] for t in content["added_tokens"] if t["special"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in special}
        self.bytes = [b""] * (1 + max(ranks.values()))
        for t, i in ranks.items():
            self.bytes[i] = t
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceTokens:
    """Ids and bytes of a vocabulary of pieces with byte fallback, which puts a space before every text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        pieces_of = self.processor.id_to_piece(list(range(self.processor.vocab_size())))
        self.bytes = [
            bytes([int(p[3:-1], 16)]) if self.processor.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces_of)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


def _names(count: int, ends: str) -> np.ndarray:
    """Every id as text, with each of the two characters that may follow it."""
    return np.array([[f"{i}{e}" for i in range(count)] for e in ends], dtype=object)


class Aligner:
    """Alignments of texts, of whole arrays of tokens at a time."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = ByteTokens(path_a), PieceTokens(path_b)
        self.sizes = [np.array([len(t) for t in x.bytes]) for x in self.sides]
        self.names = [_names(len(x.bytes), e) for x, e in zip(self.sides, (",|", ",;"))]

    def many(self, texts: list[str | None]) -> list[tuple | None]:
        """``n_a, n_b, n_groups, groups, links`` of every text, links as ``a << 32 | b``; None if it has no tokens."""
        rows = [i for i, t in enumerate(texts) if t]
        raw = [(" " + texts[i]).encode() for i in rows]
        ids = [x.encode([texts[i] for i in rows]) for x in self.sides]
        spelled = [[b"".join(map(x.bytes.__getitem__, own)) == r for own, r in zip(each, raw)] for x, each in zip(self.sides, ids)]
        whole = [k for k, (a, b) in enumerate(zip(*spelled)) if a and b]
        out: list[tuple | None] = [None] * len(texts)
        if not whole:
            return out
        counts = [[len(each[k]) for k in whole] for each in ids]
        ids = [np.array([i for k in whole for i in each[k]], np.int64) for each in ids]
        ends = [np.cumsum(size[own]) for size, own in zip(self.sizes, ids)]
        # Both sides spell the same bytes, so ends are places in the texts put together.
        parts = np.union1d(*ends)
        at = [np.searchsorted(e, parts) for e in ends]
        links = ids[0][at[0]] << 32 | ids[1][at[1]]
        common = parts[(ends[0][at[0]] == parts) & (ends[1][at[1]] == parts)]
        group = [np.searchsorted(common, e) for e in ends]
        words = [name[np.append(g[1:] != g[:-1], True).astype(int), own] for name, g, own in zip(self.names, group, ids)]
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        words = np.concatenate(words)[order].tolist()
        last = np.cumsum([len(raw[k]) for k in whole])
        cuts = [np.append(0, np.searchsorted(x, last) + 1).tolist() for x in (common, parts)]
        first = 0
        for n, k in enumerate(whole):
            n_a, n_b = counts[0][n], counts[1][n]
            text = "".join(words[first:first + n_a + n_b])[:-1]
            first += n_a + n_b
            out[rows[k]] = (n_a, n_b, cuts[0][n + 1] - cuts[0][n], text, links[cuts[1][n]:cuts[1][n + 1]])
        return out


def _text_id(text: Column) -> Column:
    return F.unhex(F.left(F.sha2(text, 256), F.lit(32)))


def align_texts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """One row per distinct text that has tokens: ``tid, n, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``.

    ``tid`` is a digest of the text, ``n`` the number of rows that have it; ``pairs`` are its different linked
    pairs of ids as ``a << 32 | b`` and ``times`` how often it holds each.  ``groups`` comes along if asked for.
    """
    texts = docs.select(F.col(text_col).alias("text")).filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    texts = texts.select(_text_id(F.col("text")).alias("tid"), "n", "text")
    schema = "tid binary, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    schema += ", groups string" if with_groups else ""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in pieces(batches, "text", 1 << 19):
            rows, counts, digests, pairs, times, groups = [], [], [], [], [], []
            for i, found in enumerate(aligner.many(batch.column("text").to_pylist())):
                if found is None:
                    continue
                rows.append(i)
                counts.append((*found[:3], len(found[4])))
                digests.append(hashlib.sha256(found[3].encode()).hexdigest())
                own, n = np.unique(found[4], return_counts=True)
                pairs.append(own)
                times.append(n.astype(np.int32))
                if with_groups:
                    groups.append(found[3])
            at = pa.array(rows, pa.int64())
            columns = [batch.column("tid").take(at), batch.column("n").take(at)]
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            columns += [pa.array(digests, pa.string()), flat(pairs, pa.int64()), flat(times, pa.int32())]
            columns += [pa.array(groups, pa.string())] if with_groups else []
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return texts.mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best`` of every linked pair: the documents that hold it, and whether no other of its ``a`` id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, weights, size = [], [], 0

        def settle():
            pairs, where = np.unique(np.concatenate(waiting), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, where, np.concatenate(weights))
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], ["pair", "n"])

        for batch in batches:
            pairs = batch.column("pairs")
            waiting.append(pairs.flatten().to_numpy())
            weights.append(np.repeat(batch.column("n").to_numpy(), np.diff(pairs.offsets.to_numpy())))
            size += len(waiting[-1])
            if size >= PARTIAL:
                yield settle()
                waiting, weights, size = [], [], 0
        if size:
            yield settle()

    counts = aligned.select("n", "pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts.withColumn("a", F.shiftright("pair", 32)), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return materialize(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def _measured(aligned: DataFrame, counts: DataFrame, listed: int) -> DataFrame:
    """``tid, n_best, count_sum`` of the texts: the counts of common pairs are at hand, those of all others are joined."""
    spark = aligned.sparkSession
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("k")).count().collect()  # a row per power of two
    least, rest = 64, sum(r["count"] for r in sizes)
    room = listed
    for r in sorted(sizes, key=lambda r: -r["k"]):
        if r["count"] > room:
            break
        least, room, rest = r["k"], room - r["count"], rest - r["count"]
    common = counts.filter(F.log2("n") >= least).toArrow()
    order = np.argsort(common.column("pair").to_numpy())
    table = spark.sparkContext.broadcast([common.column(c).to_numpy()[order] for c in ("pair", "n", "best")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = table.value
        for batch in batches:
            lists = batch.column("pairs")
            own, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
            here = known[at] == own if len(known) else np.zeros(len(own), bool)
            value = np.where(here, n[at] * times, 0) if len(known) else np.zeros(len(own), np.int64)
            top = np.where(here & best[at], times, 0) if len(known) else np.zeros(len(own), np.int64)
            edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[edges]) for x in (top, value)]
            missing = np.diff(np.concatenate([[0], np.cumsum(~here)])[edges])
            offsets = pa.array(np.concatenate([[0], np.cumsum(missing)]).astype(np.int32))
            others = [pa.ListArray.from_arrays(offsets, pa.array(x[~here])) for x in (own, times)]
            yield pa.RecordBatch.from_arrays([batch.column("tid"), *[pa.array(s.astype(np.int64)) for s in sums], *others], ["tid", "n_best", "count_sum", "pairs", "times"])

    schema = "tid binary, n_best long, count_sum long, pairs array<long>, times array<long>"
    measures = materialize(aligned.select("tid", "pairs", "times").mapInArrow(measure, schema), "measures")
    if not rest:
        return measures.select("tid", "n_best", "count_sum")
    each = measures.select("tid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("tid", "x.pairs", "x.times")
    each = each.join(counts.withColumnRenamed("pair", "pairs"), "pairs").select(
        "tid", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("n") * F.col("times")).alias("count_sum"))
    both = measures.select("tid", "n_best", "count_sum").unionByName(each)
    return materialize(both.groupBy("tid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "sums")


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    with_groups: bool = False, listed: int = LISTED) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A space and the text is tokenized by the byte-level tokenizer ``path_a``, the text by the pieces of ``path_b``.  Texts that are null or
    empty, or that either side's tokens don't spell byte by byte, have no tokens: zeros and an empty digest.  ``n_best`` counts the
    links whose pair is held by no fewer documents than any other pair of its ``a`` id, ties included; ``count_sum`` adds up
    the documents that hold each link's pair.  Rows are documents of their own even if ids and texts repeat; no
    rows, no rows; other columns are not looked at.
    """
    aligned = materialize(align_texts(docs, path_a, path_b, text_col, with_groups), "aligned")
    sums = _measured(aligned, pair_counts(aligned), listed)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    extra = ["groups_sha256"] + (["groups"] if with_groups else [])
    found = materialize(aligned.select("tid", *names[:4], *extra).join(sums, "tid"), "found")
    rows = docs.select(F.col(id_col).alias("doc_id"), _text_id(F.col(text_col)).alias("tid"))
    return rows.join(found, "tid", "left").select(
        "doc_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in names], *[F.coalesce(n, F.lit("")).alias(n) for n in extra])
