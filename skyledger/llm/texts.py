"""Words of texts as arrays: spans, 64-bit word hashes and rolling window hashes, a block of rows at a time.

A block is a slice of an Arrow batch with at most ``BLOCK`` bytes of text, or one longer text. All arrays of
a block are local to a task; hashing walks a long text in pieces, so its memory follows its word count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64
#: Odd multipliers of the two hash families; any odd number can be undone modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# One random 64-bit value for each byte and family; drawn from a fixed seed, so alike in every task.
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) * U(2) + U(1)

#: The word characters that the contracts name, as byte tables.
SPACES = np.ones(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Cache(dict):
    """Filled anew in each task; it is not sent along with the functions that use it."""

    def __reduce__(self):
        return _Cache, ()


_powers = _Cache()


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        m = max(1024, 1 << (n - 1).bit_length())
        steps = np.full(m, base, U)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if m <= 1 << 21:
            _powers[base] = have
    return have[:n]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    ends = np.cumsum(np.diff(raw(batch.column(text))[1]))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each row begins; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.empty(0, np.uint8)
    return body, starts - starts[0]


class Words:
    """Words of a block's rows, in order: byte spans, row of each word, words per row."""

    def __init__(self, column: pa.Array, allowed: np.ndarray = SPACES, lower: bool = False):
        body, self.rows = raw(column)
        self.body = LOWER[body] if lower and len(body) else body
        n = len(self.body)
        inside = np.zeros(n + 1, bool)
        inside[:n] = allowed[self.body]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = self.rows[1:-1]
        first[cuts] = inside[cuts]  # a word ends where its row ends
        self.starts = np.flatnonzero(first)
        last = inside[:n].copy()
        if n:
            last[:-1] &= ~inside[1:n] | first[1:n]
        self.ends = np.flatnonzero(last) + 1
        edges = np.searchsorted(self.starts, self.rows)
        self.counts = np.diff(edges)
        self.first = edges[:-1]
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> bytes:
        return self.body[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self, family: int = 0, upto: int | None = None) -> np.ndarray:
        """64 bits for each word (or for its first ``upto`` bytes)."""
        lens = self.ends - self.starts
        if upto:
            lens = np.minimum(lens, upto)
        out = np.empty(len(lens), U)
        done = np.cumsum(lens)
        at = 0
        while at < len(lens):
            before = done[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(done, before + BLOCK, "right")))
            some, where = lens[at:stop], self.starts[at:stop]
            begins = done[at:stop] - some - before
            within = np.arange(int(done[stop - 1] - before)) - np.repeat(begins, some)
            values = _BYTES[family][self.body[within + np.repeat(where, some)]]
            values *= powers(BASES[family], int(some.max()))[within]
            out[at:stop] = np.add.reduceat(values, begins)
            at = stop
        return mixed(out + lens.astype(U) * U(BASES[1 - family]))

    def whole(self, n: int) -> np.ndarray:
        """For each word, whether the ``n`` words from it on lie in its row."""
        ok = np.zeros(len(self), bool)
        if len(self) >= n:
            ok[: len(self) - n + 1] = self.row[: len(self) - n + 1] == self.row[n - 1 :]
        return ok


def rolling(h: np.ndarray, n: int, family: int = 0) -> np.ndarray:
    """64 bits for the ``n`` words from each word on; meaningless where fewer follow."""
    out = np.zeros(len(h), U)
    m = len(h) - n + 1
    if m <= 0:
        return out
    base = BASES[family]
    total = np.zeros(m, U)
    # A short window is summed directly; a long one by doubling, so that memory stays a few arrays.
    done, have, part = 0, 1, h
    want, power = n, base
    while want:
        if want & 1:
            factor = U(pow(base, done, 1 << 64))
            total += part[done : done + m] * factor
            done += have
        want >>= 1
        if want:
            step = part.copy()
            step[: len(part) - have] += part[have:] * U(power)
            part = step
            power = power * power % (1 << 64)
            have *= 2
    out[:m] = mixed(total + U(n))
    return out


def sliding(x: np.ndarray, w: int, fold=np.minimum) -> np.ndarray:
    """Fold of the ``w`` values from each place on; at the end, of those that are left."""
    out, have = x.copy(), 1
    while have < w:
        step = min(have, w - have)
        out[: len(out) - step] = fold(out[: len(out) - step], out[step:]) if step < len(out) else out[: len(out) - step]
        have += step
    return out
