"""Periodic runs of words: common extensions from a difference cover, asked along harmonic grids.

A run of period q and length at least ``exponent`` * q has (exponent - 1) * q places i where word i equals word i + q, so one of
them lies on the grid 0, g, 2g, ... with g = (exponent - 1) * q. Over all periods these grids have n * ln(n) / 3 places or
so. Where the two words of a place agree, the run is the place extended as far as possible to both sides, that is by
the longest common extension (LCE) of i and i + q forwards, and of the same places backwards.

LCEs come from a difference cover D of the numbers modulo ``MODULUS``: any two places reach places of the sample D within
the same few steps. Only sampled suffixes are sorted: first by their next ``MODULUS`` words, then, as names of such windows
strung together by residue, by doubling. An LCE compares words up to the nearest synchronised samples, whose own LCE is
the least of the neighbouring common prefixes between their ranks: one look into a sparse table. Backward extensions
come from the same structure over the reversed words.

All texts of a block are laid end to end with a separator of its own after each, so that extensions stop there. Memory is
a few arrays of a block's words; grids are walked in batches of periods.

Defined cases: a null, empty or wordless text has no words and no runs; words are bytes between ASCII white space, so any
bytes will do; ties between runs go to the smaller start, then period; repeated rows are judged alike; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shared import tidy, unused
from skyledger.llm.texts import Words, blocks

#: Pairs of places asked at once.
BATCH = 1 << 18


def difference_cover(v: int) -> tuple[np.ndarray, np.ndarray]:
    """Residues such that every difference modulo ``v`` occurs between two of them, and the step table.

    ``steps[a, d]``: the least k with (a + k) and (a + d + k) modulo v both in the cover. The cover is built greedily: a
    residue that adds the most new differences is taken until all occur.
    """
    cover, have = [0], {0}
    while len(have) < v:
        new = {c: {x for d in cover for x in ((c - d) % v, (d - c) % v)} - have for c in range(v) if c not in cover}
        best = max(new, key=lambda c: (len(new[c]), -c))
        cover.append(best)
        have |= new[best]
    inside = np.zeros(v, bool)
    inside[cover] = True
    places = np.arange(v)
    ok = inside[(places[:, None, None] + places) % v] & inside[(places[:, None, None] + places[:, None] + places) % v]
    return np.sort(cover), ok.argmax(axis=2)


MODULUS = 31
COVER = difference_cover(MODULUS)


class Extensions:
    """Longest common extensions of places of an integer array. Its last element must differ from all others."""

    def __init__(self, codes: np.ndarray, cover: tuple[np.ndarray, np.ndarray] = COVER):
        self.codes, self.n = codes, len(codes)
        residues, self.steps = cover
        self.v = len(self.steps)
        # Sampled places, residue after residue; behind the array's end nothing is sampled.
        sample = np.concatenate([np.arange(d, self.n, self.v) for d in residues])
        group = sample % self.v
        # Windows of the next words as big-endian bytes, which sort as the words do; zeros, which no word has, follow the end.
        padded = np.concatenate([codes.astype(np.uint32) + np.uint32(1), np.zeros(self.v, np.uint32)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.v)[sample].astype(">u4")
        # Ranks of the strung windows by doubling. A residue's last window holds the array's end and so is like no other.
        m, ranks = len(sample), [_dense(windows.view(f"S{4 * self.v}").ravel())]
        while ranks[-1].max() < m - 1:
            step, follow = 1 << (len(ranks) - 1), np.zeros(m, np.int64)
            same = group[: m - step] == group[step:]
            follow[: m - step][same] = ranks[-1][step:][same] + 1
            ranks.append(_dense(ranks[-1] * (m + 1) + follow))
        order = np.empty(m, np.int64)
        order[ranks[-1]] = np.arange(m)
        self.rank = np.full(self.n, -1, np.int64)
        self.rank[sample] = ranks[-1]
        self.table = _sparse(self._prefixes(ranks, sample, order[:-1], order[1:]))

    def _prefixes(self, ranks: list[np.ndarray], sample: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of sampled suffixes: whole windows from the ranks of each doubling, then word by word."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(ranks) - 2, -1, -1):
            same = ranks[k][a + out] == ranks[k][b + out]
            out[same] += 1 << k
        x, y = sample[a + out], sample[b + out]
        return out * self.v + self._compared(x, y, np.full(len(a), self.v))

    def _compared(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words agree from the places on, compared one by one up to ``most``."""
        out = np.zeros(len(x), np.int64)
        on, step = np.flatnonzero(most > 0), 0
        while len(on):
            i, j = x[on] + step, y[on] + step
            inside = np.maximum(i, j) < self.n
            on, i, j = on[inside], i[inside], j[inside]
            on = on[self.codes[i] == self.codes[j]]
            out[on] += 1
            step += 1
            on = on[most[on] > step]
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and ``j`` (another place) on agree."""
        k = self.steps[i % self.v, (j - i) % self.v]
        out = self._compared(i, j, k)
        reached = np.flatnonzero((out == k) & (np.maximum(i, j) + k < self.n))
        a, b = self.rank[i[reached] + k[reached]], self.rank[j[reached] + k[reached]]
        out[reached] += _least(self.table, np.minimum(a, b), np.maximum(a, b))
        return out


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _sparse(x: np.ndarray) -> list[np.ndarray]:
    out = [x]
    while len(out[-1]) > (k := 1 << (len(out) - 1)):
        out.append(np.minimum(out[-1][:-k], out[-1][k:]))
    return out


def _least(table: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value at places a <= place < b, for a < b."""
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    out = np.empty(len(a), np.int64)
    for k in np.unique(level):
        on = level == k
        out[on] = np.minimum(table[k][a[on]], table[k][b[on] - (1 << k)])
    return out


def grids(sizes: np.ndarray, exponent: int, batch: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all grid places of texts with so many words, a batch at a time."""
    texts = np.flatnonzero(sizes >= exponent)
    most = sizes[texts] // exponent
    text = np.repeat(texts, most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (exponent - 1) * period
    counts = (sizes[text] - period - 1) // step + 1
    ends = np.cumsum(counts)
    at = 0
    while at < len(text):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + batch, "right")))
        n = counts[at:stop]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(text[at:stop], n), nth * np.repeat(step[at:stop], n), np.repeat(period[at:stop], n)
        at = stop


def found(codes: np.ndarray, sizes: np.ndarray, exponent: int = 4, least: int = 6, batch: int = BATCH) -> np.ndarray:
    """Runs of texts laid end to end, as rows (text, start, length, period) by text, start and period.

    ``codes``: the words of all texts as numbers from 0, ``sizes``: how many each text has.
    """
    first = np.cumsum(sizes) - sizes + np.arange(len(sizes)) + 1
    laid = np.empty(len(codes) + len(sizes) + 1, np.int64)
    words = np.ones(len(laid), bool)
    words[0] = False
    words[first + sizes] = False
    laid[words] = codes
    laid[~words] = int(codes.max(initial=-1)) + 1 + np.arange(len(sizes) + 1)
    ahead = back = None
    rows = [np.empty((0, 4), np.int64)]
    for text, place, period in grids(sizes, exponent, batch):
        i = first[text] + place
        j = i + period
        on = laid[i] == laid[j]
        if not on.any():
            continue
        if ahead is None:
            ahead, back = Extensions(laid), Extensions(laid[::-1].copy())
        text, period, i, j = text[on], period[on], i[on], j[on]
        start = i - back.lce(len(laid) - j, len(laid) - i)
        length = j + ahead.lce(i, j) - start
        on = length >= np.maximum(least, exponent * period)
        rows.append(_first_periods(np.column_stack([text, start - first[text], length, period])[on]))
    out = _first_periods(np.concatenate(rows))
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _first_periods(rows: np.ndarray) -> np.ndarray:
    """Of rows with equal text, start and length the one with the smallest period, which divides the others."""
    rows = rows[np.lexsort(rows.T[[3, 2, 1, 0]])]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[new]


def numbered(words: Words) -> np.ndarray:
    """Equal numbers for equal words, told apart by two independent hashes."""
    one, two = words.hashes(0), words.hashes(1)
    _, at, codes = np.unique(one, return_index=True, return_inverse=True)
    if not np.array_equal(two, two[at][codes]):
        codes = np.unique(np.rec.fromarrays([one, two]), return_inverse=True)[1]
    return codes.astype(np.int64)


def periodic_runs(docs: DataFrame, *, text: str = "text", out: str = "periodic", exponent: int = 4, least: int = 6) -> DataFrame:
    """``docs`` with a struct (n_words, runs, collapsed).

    ``runs``: array of (start, length, period) by start and period, of all maximal stretches with smallest period
    ``period`` and at least max(``least``, ``exponent`` * period) words. ``collapsed``: the words, joined by a space, without
    those that some run has after its first period; binary, as a text need not be UTF-8.
    """

    @tidy
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = []
            for part in blocks(pa.RecordBatch.from_arrays([column], ["body"]), "body"):
                words = Words(part.column("body"))
                sizes = words.counts.astype(np.int64)
                runs = found(numbered(words), sizes, exponent, least)
                edge = np.zeros(len(words) + 1, np.int64)
                begin = words.first[runs[:, 0]] + runs[:, 1]
                np.add.at(edge, begin + runs[:, 3], 1)
                np.add.at(edge, begin + runs[:, 2], -1)
                parts.append(_returned(words, sizes, runs, np.cumsum(edge[:-1]) == 0))
            yield pa.concat_arrays(parts) if parts else pa.array([], KIND)

    return docs.withColumn(out, F.arrow_udf(detect, "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:binary>")(F.col(text).cast("binary")))


KIND = pa.struct(
    [("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())]
)


def _returned(words: Words, sizes: np.ndarray, runs: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The result of a block: words that are kept move together, with one space before all but a row's first."""
    row, start, size = words.row[kept], words.starts[kept], (words.ends - words.starts)[kept]
    later = np.append(False, row[1:] == row[:-1])
    ends = np.cumsum(size + later)
    body = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    shift = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    body[shift + np.repeat(ends - size, size)] = words.body[shift + np.repeat(start, size)]
    per_row = np.bincount(row, weights=size + later, minlength=len(sizes)).astype(np.int64)
    cuts = np.concatenate([[0], np.cumsum(per_row)])
    collapsed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(body)])
    lists = np.concatenate([[0], np.cumsum(np.bincount(runs[:, 0], minlength=len(sizes)))])
    each = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
    return pa.StructArray.from_arrays([pa.array(sizes), pa.ListArray.from_arrays(pa.array(lists, pa.int32()), each), collapsed], ["n_words", "runs", "collapsed"])
