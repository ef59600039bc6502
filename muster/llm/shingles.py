"""Join of documents by the Jaccard similarity of their word shingles, with a token-group matrix.

Equal sets count once.  Sets that share a token of their prefixes, the rarest tokens of which linked sets must share
one, are first compared with one pivot per token, which ties copies together in linear time.  Sets tied so
form groups of bounded size.  Of each group the matrix keeps the union of its members' tokens, as counts by token
bucket; two groups of different components that share a prefix token are opened only if the overlap that their
unions allow is enough for any two members, and then their members' sets are compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.batches import Met, flat, pieces, utf8
from muster.operators.components import linked_components
from muster.session import materialize

WORDS = 4
PERCENT = 85
COMMON_SHARE = 10_000  # a token is common from this part of all documents on, so there are few different ones
COMMON_LEAST = 16
SEEN_SLOTS = 1 << 25
COUNTERS = 1 << 20  # tokens that a task counts at a time
GROUP = 64
SALTS = 16
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(31).integers(0, 2 ** 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 16


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes, of whole arrays of bytes at a time."""

    def __init__(self, size: int):
        self.size, self.up, self.down = size, np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.factors = [_mixed(np.array([f], np.uint64) + np.uint64(i))[0] | np.uint64(1) for i, f in enumerate(_MIX * (size // 4 + 1))][:size]

    def _shingles(self, hashes: np.ndarray, size: int) -> np.ndarray:
        count = len(hashes) - size + 1
        total = np.full(max(0, count), size, np.uint64)
        for k in range(size):
            total += hashes[k:k + len(total)] * self.factors[k]
            total = _mixed(total)
        return total

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
        if len(raw) > len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(raw)), _powers(pow(_BASE, -1, 2 ** 64), 2 * len(raw))
        edges = np.flatnonzero(np.diff(_SPACE[raw], prepend=True))
        starts, ends = edges[::2], edges[1::2]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * self.up[:len(raw)], out=total[1:])
        hashes = _mixed((total[ends] - total[starts]) * self.down[starts])
        shingles = self._shingles(hashes, self.size)
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts])).tolist()
        out = []
        for low, high in zip(bounds, bounds[1:]):
            if high - low >= self.size:
                out.append(np.unique(shingles[low:high - self.size + 1]))
            else:  # fewer words than a shingle has are one shingle
                out.append(self._shingles(hashes[low:high], high - low) if high > low else shingles[:0])
        return out

    def many(self, texts: list[bytes]) -> list[np.ndarray]:
        out, waiting, size = [], [], 0
        for text in texts:
            waiting.append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                out += self._chunk(waiting)
                waiting, size = [], 0
        return out + (self._chunk(waiting) if waiting else [])


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(one, other, percent: int):
    """Least overlap of sets of these sizes that link."""
    return -(-percent * (one + other) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


class Common:
    """Tokens of many documents, in order of how many; all other tokens are rarer and ordered by hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.lexsort((tokens, counts))
        self.rank = np.empty(len(tokens), np.int64)
        self.rank[order] = np.arange(len(tokens))
        by_token = np.argsort(tokens)
        self.tokens, self.rank = tokens[by_token], self.rank[by_token]

    def prefix(self, tokens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``size`` tokens in order of rarity, and which of them are common."""
        if not len(self.tokens):
            return tokens[:size], np.zeros(size, bool)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        common = self.tokens[at] == tokens
        rare = tokens[~common]
        if len(rare) >= size:
            return rare[:size], np.zeros(size, bool)
        rest = tokens[common][np.argsort(self.rank[at[common]], kind="stable")][:size - len(rare)]
        return np.concatenate([rare, rest]), np.arange(size) >= len(rare)


def bucket_counts(tokens: np.ndarray) -> bytes:
    """How many tokens fall into each of a number of buckets that follows the set's size."""
    buckets = 1 << max(6, int(len(tokens) // 4).bit_length())
    counts = np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def coarse(counts: bytes) -> bytes:
    """The counts of 64 buckets, which the finer ones fall into; a full counter stays full."""
    fine = np.frombuffer(counts, np.uint8).reshape(-1, 64)
    return np.where((fine == 255).any(axis=0), 255, np.minimum(fine.sum(axis=0, dtype=np.int64), 255)).astype(np.uint8).tobytes()


def most_overlap(one: bytes, other: bytes) -> int:
    """No two sets with these bucket counts share more tokens; a full counter bounds nothing."""
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (one, other))
    a, b = (np.where(x == 255, 1 << 40, x) for x in (a, b))
    if len(a) > len(b):
        a, b = b, a
    b = b.reshape(-1, len(a)).sum(axis=0)
    return int(np.minimum(a, b).sum())


def overlap(one: np.ndarray, other: np.ndarray) -> int:
    return len(one) + len(other) - len(np.union1d(one, other))


def _common_tokens(rows: DataFrame, size: int, share: int) -> Common:
    """Tokens in at least one of ``share`` documents, as tasks count them; their number is bounded by ``share`` times
    the mean number of tokens of a document.  A task passes on those it met three times or more, so counts may
    fall short, which bears on the order of tokens alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A table of small counters tells which tokens have been met before; only these are kept and counted.
        # Of more tokens than it has counters for, all lose what the least of them have, as in a summary of frequent items.
        shingler, docs, met, again, waiting = Shingler(size), 0, np.zeros(SEEN_SLOTS, bool), [], 0
        known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def summed():
            tokens, times = np.unique(np.concatenate(again), return_counts=True) if again else (known, counts)
            if again and len(known):
                tokens, at = np.unique(np.concatenate([tokens, known]), return_inverse=True)
                times = np.bincount(at, np.concatenate([times, counts])).astype(np.int64)
            if len(tokens) > COUNTERS:
                times = times - np.partition(times, len(times) - COUNTERS - 1)[len(times) - COUNTERS - 1]
                tokens, times = tokens[times > 0], times[times > 0]
            return tokens, times

        for batch in pieces(batches, "text"):
            for tokens in shingler.many(utf8(batch, "text")):
                docs += 1
                slots = (tokens >> np.uint64(20)) & np.uint64(SEEN_SLOTS - 1)
                again.append(tokens[met[slots]])
                waiting += len(again[-1])
                met[slots] = True
            if waiting >= COUNTERS:
                known, counts = summed()
                again, waiting = [], 0
        known, counts = summed()
        often = counts + 1 >= 3
        known, counts = known[often], counts[often] + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(known.view(np.int64), 0)), pa.array(np.append(counts, docs)), pa.array(np.arange(len(known) + 1) == len(known))],
            ["token", "n", "whole"])

    # Fewer, larger tasks see more of a token's documents.
    texts = rows.select("text")
    tasks = texts._jdf.queryExecution().toRdd().getNumPartitions()
    texts = texts.coalesce(max(1, tasks // 8, min(tasks, rows.sparkSession.sparkContext.defaultParallelism)))
    found = texts.mapInArrow(count, "token long, n long, whole boolean").groupBy("token", "whole").agg(F.sum("n").alias("n"))
    found = materialize(found, "tokens")
    docs = found.filter("whole").agg(F.sum("n")).first()[0] or 0
    common = found.filter(~F.col("whole") & (F.col("n") >= max(COMMON_LEAST, docs // share))).select("token", "n").toPandas()
    return Common(common["token"].to_numpy(np.int64).view(np.uint64), common["n"].to_numpy(np.int64))


def link_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT,
    share: int = COMMON_SHARE, group: int = GROUP, salts: int = SALTS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; ``kept`` is true for one row of each component.

    Two texts link if their shingle sets' intersection is at least ``percent`` hundredths of their union.  Words
    are parted by ASCII white space, A-Z lowered; a text of fewer words than ``size`` is one shingle; null and empty
    texts have none and link with nothing.  ``component_id`` is the least id connected by links.  Rows without id
    take part and have the id of their component, null if none has one; repeated ids are rows of their own.
    The row kept is that of the least id; one that links with nothing is kept.  ``digest`` tells rows' texts apart.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    context = docs.sparkSession.sparkContext
    common = context.broadcast(_common_tokens(rows, size, share))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, met, number = Shingler(size), Met(), TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "text"):
            sids, sizes, tokens, salted, buckets = [], [], [], [], []
            for own in shingler.many(utf8(batch, "text")):
                sid = set_id(own) if len(own) else None
                sids.append(sid)
                sizes.append(len(own))
                if sid is None or not met.new(sid):  # a task sends the prefix of equal sets once
                    tokens.append(np.zeros(0, np.int64))
                    salted.append(np.zeros(0, bool))
                    buckets.append(None)
                else:
                    first, often = common.value.prefix(own, prefix_size(len(own), percent))
                    tokens.append(first.view(np.int64))
                    salted.append(often)
                    buckets.append(bucket_counts(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sids, pa.int64()), pa.array(sizes, pa.int32()), flat(tokens, pa.int64()), flat(salted, pa.bool_()),
                 pa.array(range(number, number + batch.num_rows), pa.int64()), batch.column("digest"), pa.array(buckets, pa.binary())],
                ["doc_id", "sid", "n", "tokens", "common", "row", "digest", "buckets"])
            number += batch.num_rows

    signed = rows.withColumn("digest", F.xxhash64("text")).mapInArrow(
        sign, f"doc_id {kind}, sid long, n int, tokens array<long>, common array<boolean>, row long, digest long, buckets binary")
    signed = materialize(signed, "signed")

    # -- sets that share a prefix token --------------------------------------------------------
    entries = signed.filter("size(tokens) > 0").select("sid", "n", F.posexplode(F.arrays_zip("tokens", "common")).alias("pos", "t"))
    entries = entries.select(
        F.col("t.tokens").alias("token"), "sid", "n", "pos",
        F.when(F.col("t.common"), F.pmod("sid", F.lit(salts))).otherwise(0).cast("int").alias("salt"), F.col("t.common").alias("common"))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries of tokens that several sets have, each with the pivot it is to be compared with.

        Entries come by token and size; the first is the pivot of those it may link with by size.
        """
        names = ["token", "salt", "sid", "n", "pos", "common"]
        kept = ["token", "sid", "n", "pos", "pivot"]
        last, previous, pivot, pivot_n, before = None, None, 0, 0, None
        rest = None
        for batch in chain(batches, [None]):
            if batch is not None:
                batch = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
                # The last row waits, as what follows it is not known yet.
                batch, rest = batch.slice(0, batch.num_rows - 1), batch.slice(batch.num_rows - 1)
            elif rest is None:
                return
            else:
                batch = rest
            token, salt = (batch.column(n).to_numpy() for n in ("token", "salt"))
            same = np.zeros(len(token) + 1, bool)
            same[1:-1] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
            if len(token):
                same[0] = before == (token[0], salt[0])
                after = (rest.column("token")[0].as_py(), rest.column("salt")[0].as_py()) if rest is not batch else None
                same[-1] = after == (token[-1], salt[-1])
                before = (token[-1], salt[-1])
            # A token of one set alone ties nothing, unless its other salts may have more.
            several = same[:-1] | same[1:] | batch.column("common").to_numpy(zero_copy_only=False)
            out = {n: [] for n in kept}
            for row in zip(*(c.to_pylist() for c in batch.filter(pa.array(several)).select(names).columns)):
                key, sid, n, pos = row[:2], *row[2:5]
                if key == last and sid == previous:
                    continue  # the same set from another task
                if key != last or 100 * pivot_n < percent * n:
                    last, pivot, pivot_n = key, sid, n
                previous = sid
                for name, v in zip(kept, (key[0], sid, n, pos, pivot if pivot != sid else None)):
                    out[name].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["token"], pa.int64()), pa.array(out["sid"], pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["pos"], pa.int32()), pa.array(out["pivot"], pa.int64())], kept)

    met = entries.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "sid")
    met = materialize(met.mapInArrow(shared, "token long, sid long, n int, pos int, pivot long"), "met")
    # The pivots of a token's salts, and of its sizes, are compared with the least of them.
    pivots = met.filter("pivot IS NULL").select("token", "sid", "n")
    least = pivots.groupBy("token").agg(F.min(F.struct("n", "sid")).alias("m"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    across = pivots.join(least.select("token", "m"), "token").filter(f"sid <> m.sid AND 100 * m.n >= {percent} * n").select("sid", F.col("m.sid").alias("pivot"))
    pairs = met.filter("pivot IS NOT NULL").select("sid", "pivot").unionByName(across).distinct()
    pairs = materialize(pairs.select(F.col("sid").alias("a"), F.col("pivot").alias("b")), "pairs")

    # -- the sets themselves, of those only that may link --------------------------------------
    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A text once per task, however often it is copied."""
        seen = Met()
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            places = [i for i, digest in enumerate(digests) if seen.new(digest)]
            yield batch.take(pa.array(places, pa.int64()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, last = Shingler(size), None
        for batch in pieces(batches, "text"):
            sids = batch.column("sid").to_pylist()
            fresh = [i for i, sid in enumerate(sids) if sid != (sids[i - 1] if i else last)]
            last = sids[-1] if sids else last
            own = shingler.many(utf8(batch.take(pa.array(fresh, pa.int64())), "text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([sids[i] for i in fresh], pa.int64()), pa.array([len(t) for t in own], pa.int32()), pa.array([t.tobytes() for t in own], pa.binary())],
                ["sid", "n", "tokens"])

    def sets_of(wanted: DataFrame) -> DataFrame:
        """``sid, n, tokens`` of the wanted ``sid``, from one text that has each."""
        texts = signed.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.min("digest").alias("digest"))
        texts = materialize(texts, "digests")
        found = rows.select(F.xxhash64("text").alias("digest"), "text").mapInArrow(once, "digest long, text string").join(texts, "digest")
        return materialize(found.select("sid", "text").mapInArrow(read, "sid long, n int, tokens binary"), "sets")

    sketches = materialize(signed.filter("buckets IS NOT NULL").select(F.col("sid").alias("g"), "n", "buckets").dropDuplicates(["g"]), "sketches")

    def may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose bucket counts allow the overlap that the least of their sizes need."""
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("n_a", "n_b", "buckets_a", "buckets_b"))
            kept = [most_overlap(x, y) >= needed(p, q, percent) for p, q, x, y in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(kept, pa.bool_()))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first link between the members of either side, if there is one."""
        for batch in batches:
            links = []
            for ids_a, sets_a, ids_b, sets_b in zip(*(batch.column(n).to_pylist() for n in ("sids_a", "tokens_a", "sids_b", "tokens_b"))):
                link = None
                others = [(i, np.frombuffer(t, np.uint64)) for i, t in zip(ids_b, sets_b)]
                for i, t in zip(ids_a, sets_a):
                    own = np.frombuffer(t, np.uint64)
                    for j, other in others:
                        small, large = sorted((len(own), len(other)))
                        if 100 * small >= percent * large and overlap(own, other) >= needed(small, large, percent):
                            link = (i, j)
                            break
                    if link:
                        break
                links.append(link)
            found = [x for x in links if x]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["src", "dst"])

    side = lambda df, s: df.select(*[F.col(c).alias(f"{c}_{s}" if c != "g" else s) for c in df.columns])

    def bounded(candidates: DataFrame, matrix: DataFrame) -> DataFrame:
        """The candidate pairs that the matrix does not rule out."""
        both = candidates.join(side(matrix, "a"), "a").join(side(matrix, "b"), "b")
        return materialize(both.mapInArrow(may_link, "a long, b long"), "bounded")

    def links_of(candidates: DataFrame, members: DataFrame) -> DataFrame:
        """A link between the groups of each pair that have one."""
        both = candidates.join(side(members, "a"), "a").join(side(members, "b"), "b")
        return materialize(both.mapInArrow(opened, "src long, dst long"), "links")

    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("g")).distinct()
    pairs = bounded(pairs, sketches)
    sets = sets_of(ends(pairs).withColumnRenamed("g", "sid"))
    alone = sets.select(F.col("sid").alias("g"), F.array("sid").alias("sids"), F.array("tokens").alias("tokens"))
    links = links_of(pairs, alone)
    tied = materialize(linked_components(links), "tied")

    # -- groups of tied sets, and pairs of groups that share a prefix token --------------------
    parts = tied.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).cast("int").alias("parts"))
    homes = tied.join(parts, "component").select(
        F.col("node").alias("sid"), "component", F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("g"))
    homes = materialize(homes, "homes")
    placed = met.select("token", "sid", "n", "pos").join(homes, "sid", "left").select(
        "token", "n", "pos", F.coalesce("component", "sid").alias("component"), F.coalesce("g", "sid").alias("g"))
    grouped = placed.groupBy("token", "component", "g").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("pos"))
    several = grouped.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("token")
    grouped = grouped.join(several, "token")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bucket counts of the union of each group's tokens."""
        for batch in batches:
            unions = [np.unique(np.concatenate([np.frombuffer(t, np.uint64) for t in own])) for own in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("n"), pa.array([bucket_counts(u) for u in unions], pa.binary())], ["g", "n", "buckets"])

    # The matrix: unions of the groups of several sets, and what is known of the sets alone.
    members = sets.join(homes, "sid").groupBy("g").agg(
        F.collect_list("sid").alias("sids"), F.collect_list("tokens").alias("tokens"), F.min("n").alias("n"))
    members = materialize(members, "members")
    unions = members.select("g", "n", "tokens").mapInArrow(unite, "g long, n int, buckets binary")
    single = sketches.join(homes.select(F.col("sid").alias("g")), "g", "left_anti")
    matrix = unions.unionByName(single).join(grouped.select("g").distinct(), "g", "left_semi")
    matrix = materialize(matrix, "matrix")

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("g"), batch.column("n"), pa.array([coarse(b) for b in batch.column("buckets").to_pylist()], pa.binary())], ["g", "least", "buckets"])

    # The entries of a token carry the outlines of their rows of the matrix; what passes is held against the rows themselves.
    grouped = grouped.join(matrix.mapInArrow(outline, "g long, least int, buckets binary"), "g")

    def across_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a token's groups of different components that sizes, positions and the matrix allow."""
        seen = Met()
        last, run = None, []
        for batch in batches:
            out = []
            names = ("token", "component", "g", "low", "high", "pos", "least", "buckets")
            for token, component, g, low, high, pos, least, buckets in zip(*(batch.column(n).to_pylist() for n in names)):
                if token != last:
                    last, run = token, []
                # Entries come by greatest size, so what is too small for this one is so for all that follow.
                run = [r for r in run if 100 * r[2] >= percent * low] if len(run) > 64 else run
                for other, h, top, bottom, at, smallest, others in run:
                    if other != component and 100 * top >= percent * low and 100 * high >= percent * bottom:
                        rest = 1 + min(high - pos, top - at) - 1
                        if rest >= needed(low, bottom, percent):
                            # What the matrix rules out, it does at any token: by the least sizes in either group.
                            if seen.new((g, h) if g < h else (h, g)) and most_overlap(buckets, others) >= needed(least, smallest, percent):
                                out.append((g, h) if g < h else (h, g))
                run.append((component, g, high, low, pos, least, buckets))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], ["a", "b"])

    cross = grouped.repartition("token").sortWithinPartitions("token", "low", "g").mapInArrow(across_groups, "a long, b long").distinct()
    cross = bounded(materialize(cross, "cross"), matrix)
    wanted = ends(cross).join(members.select("g"), "g", "left_anti")
    known = sets.join(homes.select("sid"), "sid", "left_anti").select(F.col("sid").alias("g"), F.array("sid").alias("sids"), F.array("tokens").alias("tokens"))
    missing = materialize(wanted.join(known.select("g"), "g", "left_anti").withColumnRenamed("g", "sid"), "missing")
    opened_sets = members.select("g", "sids", "tokens").unionByName(known)
    if not missing.isEmpty():
        opened_sets = opened_sets.unionByName(sets_of(missing).select(F.col("sid").alias("g"), F.array("sid").alias("sids"), F.array("tokens").alias("tokens")))
    more = links_of(cross, opened_sets)

    every = links.unionByName(more)
    components = materialize(linked_components(every), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))
    sids = signed.filter("sid IS NOT NULL").groupBy("sid").agg(first.alias("least"))
    sids = materialize(sids.join(components, sids["sid"] == components["node"], "left").select("sid", "least", F.coalesce("component", "sid").alias("component")), "sids")
    named = sids.groupBy("component").agg(F.min("least").alias("first"))
    named = materialize(sids.join(named, "component").select("sid", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row")), "named")
    return signed.select("doc_id", "n", "sid", "row", "digest").join(named, "sid", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("first_row"), F.lit(True)).alias("kept"), "digest")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``link_documents`` keeps, with all their columns.

    Rows without words are alike to nothing and stay.  Rows are told by id and text; of rows equal in both, one stays
    unless they have no words.
    """
    kept = link_documents(docs, id_col, text_col, **options).groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or("kept").alias("_kept"), F.max("n_shingles").alias("_size"))
    kept = kept.filter("_kept").select(F.col("doc_id").alias("id"), "digest", ((F.col("_rows") > 1) & (F.col("_size") > 0)).alias("several"))
    kept = materialize(kept, "kept")
    # Columns of documents are carried under names that clash with none of these.
    rows = docs.select(*[F.col(c).alias(f"_{c}") for c in docs.columns]).withColumn("digest0", F.xxhash64(f"_{text_col}"))
    joined = rows.join(kept, F.col(f"_{id_col}").eqNullSafe(F.col("id")) & (F.col("digest0") == F.col("digest")))
    named = [F.col(f"_{c}").alias(c) for c in docs.columns]
    single = joined.filter("NOT several").select(*named)
    several = joined.filter("several").dropDuplicates(["id", "digest"]).select(*named)
    return single.unionByName(several)
