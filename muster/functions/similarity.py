"""Jaro-Winkler similarity of whole batches of pairs, and the pairs of many names that reach a threshold."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Executors get the code inside the UDF, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX_WEIGHT = 0.1
PREFIX_LIMIT = 4
BOOST_FROM = 0.7
_CELLS = 1 << 21


def _points(texts, width):
    """Texts as a matrix of code points, padded with zeros."""
    return np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width)


def _matches(a, b, len_a, len_b):
    """Which characters of ``a`` and ``b`` pair up, taking the earliest free partner in reach."""
    size, width = b.shape
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0).astype(np.int32)[:, None]
    column = np.arange(width, dtype=np.int32)[None, :]
    free = column < len_b[:, None]
    rows = np.arange(size)
    used_a = np.zeros(a.shape, dtype=bool)
    widest = int(reach.max())
    for i in range(int(len_a.max())):
        low, high = max(0, i - widest), min(width, i + widest + 1)
        able = b[:, low:high] == a[:, i : i + 1]
        able &= free[:, low:high]
        able &= np.abs(column[:, low:high] - i) <= reach
        first = able.argmax(axis=1)
        found = able[rows, first] & (i < len_a)
        free[rows[found], first[found] + low] = False
        used_a[:, i] = found
    return used_a, (column < len_b[:, None]) & ~free


def _similarity(a, b, len_a, len_b):
    if max(a.max(), b.max()) < 256:
        a, b = a.astype(np.uint8), b.astype(np.uint8)
    used_a, used_b = _matches(a, b, len_a, len_b)
    matched = used_a.sum(axis=1)
    # Both sides list the matched characters row by row, equally many in each.
    out_of_place = a[used_a] != b[used_b]
    owner = np.repeat(np.arange(len(matched)), matched)
    swaps = np.bincount(owner[out_of_place], minlength=len(matched)) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matched / len_a + matched / len_b + (matched - swaps) / matched) / 3.0
    jaro = np.where(matched == 0, 0.0, jaro)
    head = min(PREFIX_LIMIT, a.shape[1])
    inside = np.arange(head)[None, :] < np.minimum(len_a, len_b)[:, None]
    prefix = np.cumprod((a[:, :head] == b[:, :head]) & inside, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_FROM, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def jaro_winkler_batch(left, right) -> np.ndarray:
    """Similarities of two equally long lists of texts; NaN where either is missing."""
    result = np.full(len(left), np.nan)
    both = [i for i in range(len(left)) if left[i] is not None and right[i] is not None]
    len_a = np.array([len(left[i]) for i in both], dtype=np.int64)
    len_b = np.array([len(right[i]) for i in both], dtype=np.int64)
    longest = np.maximum(len_a, len_b)
    order = np.argsort(longest, kind="stable")
    start = 0
    while start < len(order):
        # Pairs of like length share a matrix, of bounded size even for very long texts.
        stop = start + max(1, int(_CELLS // max(1, longest[order[start]])))
        stop = min(stop, len(order))
        while stop - start > 1 and (stop - start) * int(longest[order[stop - 1]]) > _CELLS:
            stop = start + (stop - start + 1) // 2
        part = order[start:stop]
        width = max(1, int(longest[part].max()))
        rows = [both[k] for k in part]
        a, b = _points([left[i] for i in rows], width), _points([right[i] for i in rows], width)
        result[rows] = _similarity(a, b, len_a[part], len_b[part])
        start = stop
    return result


# Columns of the matrix of numbered characters; the elements of names with more share columns.
_MOST_COLUMNS = 2048
# Names of one side whose products are taken at a time.
_SIDE = 512
_SLACK = 1e-6


def numbered_counts(texts) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the texts, and which numbered characters (the first e, the second e, ...) each has.

    The product of two rows is no less than the number of characters that the two texts can match.
    """
    columns: dict[tuple[str, int], int] = {}
    rows, cells = [], []
    for i, text in enumerate(texts):
        times: dict[str, int] = {}
        for c in text:
            times[c] = k = times.get(c, 0) + 1
            cells.append(columns.setdefault((c, k), len(columns)) % _MOST_COLUMNS)
        rows.append(len(text))
    lengths = np.array(rows, dtype=np.int64)
    counts = np.zeros((len(texts), max(1, min(len(columns), _MOST_COLUMNS))), dtype=np.float32)
    np.add.at(counts, (np.repeat(np.arange(len(texts)), lengths), np.array(cells, dtype=np.int64)), 1)
    return lengths, counts


def similar_pairs(texts, few, side, short: float, long: float, admitted=None):
    """``i, j, sim`` of the pairs of texts that reach their threshold, from blocked products of character counts.

    ``few`` tells the texts that need ``short`` among themselves; all others need ``long``.  Texts of one ``side`` only
    are paired with each other; of two sides, each of the one with each of the other.  No pair is lost: two
    texts match on no more characters than both have, which bounds their similarity from above given their lengths and
    common prefix.  Only pairs within that bound, and ``admitted`` where given, have it computed.
    """
    few, side = np.asarray(few, dtype=bool), np.asarray(side)
    lengths, counts = numbered_counts(texts)
    heads = _points([t[:PREFIX_LIMIT] for t in texts], PREFIX_LIMIT)
    one, other = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    within = side.min() == side.max()
    found_i, found_j, found_sim = [], [], []
    for start in range(0, len(one), _SIDE):
        rows = one[start : start + _SIDE]
        columns = other[start:] if within else other
        for at in range(0, len(columns), _SIDE):
            cols = columns[at : at + _SIDE]
            shared = counts[rows] @ counts[cols].T
            len_a, len_b = lengths[rows][:, None], lengths[cols][None, :]
            shared = np.minimum(shared, np.minimum(len_a, len_b))
            same = np.ones(shared.shape, dtype=bool)
            prefix = np.zeros(shared.shape, dtype=np.float32)
            for k in range(PREFIX_LIMIT):
                head = heads[rows, k]
                same &= (head[:, None] == heads[cols, k][None, :]) & (head != 0)[:, None]
                prefix += same
            least = np.where(few[rows][:, None] & few[cols][None, :], short, long)
            lift = PREFIX_WEIGHT * prefix
            best = (shared / len_a + shared / len_b + 1.0) / 3.0
            able = best >= (least - lift) / (1.0 - lift) - _SLACK
            if within:
                able &= rows[:, None] < cols[None, :]
            r, c = np.nonzero(able)
            i, j = rows[r], cols[c]
            if admitted is not None and len(i):
                chosen = admitted(i, j)
                i, j, r, c = i[chosen], j[chosen], r[chosen], c[chosen]
            if len(i):
                sim = jaro_winkler_batch([texts[x] for x in i.tolist()], [texts[x] for x in j.tolist()])
                reached = sim >= least[r, c]
                found_i.append(i[reached])
                found_j.append(j[reached])
                found_sim.append(sim[reached])
    if not found_i:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0)
    return np.concatenate(found_i), np.concatenate(found_j), np.concatenate(found_sim)


def forest(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the links ``i, j`` to keep so that they connect the same things without a circle."""
    least: dict[int, int] = {}

    def root(x: int) -> int:
        while least.setdefault(x, x) != x:
            least[x] = x = least[least[x]]
        return x

    kept = np.zeros(len(i), dtype=bool)
    for n, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = root(a), root(b)
        if a != b:
            least[max(a, b)] = min(a, b)
            kept[n] = True
    return kept


def _jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    a = [None if pd.isna(x) else x for x in left]
    b = [None if pd.isna(x) else x for x in right]
    return pd.Series(jaro_winkler_batch(a, b))


_udf = F.pandas_udf(_jaro_winkler, DoubleType())


def jaro_winkler(left: Column, right: Column) -> Column:
    return F.nanvl(_udf(left, right), F.lit(None).cast("double"))


def register(spark: SparkSession, name: str = "jaro_winkler") -> None:
    """Make the similarity callable from SQL."""
    spark.udf.register(name, _udf)
