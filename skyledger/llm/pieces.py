"""SentencePiece encoding and decoding: a score-ordered agenda of adjacent symbol pairs, for merge-type vocabularies.

A text is normalised by the vocabulary's own rules and cut into units where no piece of the vocabulary has two such
characters side by side: before a space sign that follows something else. Merges never reach over such a cut, so a text's
ids are those of its units in order. Every distinct unit of a block starts as single characters; the agenda holds its
adjacent pairs that form a piece, and each step takes the pair with the highest score (of equal ones the leftmost), joins
it and enters the two new pairs beside it. Steps run for all units of a block at once, as array operations, and end for
a unit when its agenda is empty; a long unit has a heap of its own. What is no piece at the end is spelt in bytes.

Each Arrow batch checks its new units against the sentencepiece library, and raises where the ids differ (a vocabulary
of another type, or one with user-defined pieces). Decoding is the library's.

Memory: a block has ``BLOCK`` bytes of text, or one longer text; a task remembers the ids of up to ``KEPT`` units, or of one
block, and then begins anew; the tables that are broadcast grow with the vocabulary only.

Defined cases: a null or empty text has the end id alone and decodes to an empty string; each byte that is not UTF-8
counts as U+FFFD; names of special pieces in a text are ordinary text; repeated rows are encoded alike; other columns pass.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.shared import tidy, unused
from skyledger.llm.texts import blocks, raw

BLOCK = 4 << 20
KEPT = 1 << 18
#: Units of more characters have a heap each.
LONG = 48
SPACE = "▁"
NEVER = np.iinfo(np.int64).max
SPOT_BITS = 21


def _spot(key: np.ndarray) -> np.ndarray:
    """Place of each pair in a table of 2**SPOT_BITS."""
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SPOT_BITS)


class Vocabulary:
    """Tables of a merge-type model: symbols, and for each pair of them that forms a piece its rank and the symbol formed.

    Symbols below ``len(ids)`` are pieces, or characters that pieces consist of (id -1 when no piece themselves);
    ``len(ids)`` + c is the character c that no piece has.
    """

    def __init__(self, model: bytes):
        self.model = model
        sp = self.library()
        size = sp.get_piece_size()
        spelt = [i for i in range(size) if sp.is_byte(i)]
        if len(spelt) != 256:
            raise ValueError("the vocabulary does not spell unknown characters in bytes")
        self.bytes = [i for _, i in sorted((int(sp.id_to_piece(i)[1:-1], 16), i) for i in spelt)]
        self.end = sp.eos_id()
        score = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        symbols = {s: k for k, s in enumerate(dict.fromkeys([*score, *(c for p in score for c in p)]))}
        self.ids = np.array([score[s][1] if s in score else -1 for s in symbols], np.int32)
        self.chars = np.arange(0x110000, dtype=np.int32) + np.int32(len(symbols))
        singles = [(ord(s), k) for s, k in symbols.items() if len(s) == 1]
        self.chars[[c for c, _ in singles]] = [k for _, k in singles]
        order = {v: r for r, v in enumerate(sorted({v for v, _ in score.values()}, reverse=True))}
        pairs = sorted(
            (symbols[p[:k]] << 32 | symbols[p[k:]], order[v], symbols[p])
            for p, (v, _) in score.items()
            for k in range(1, len(p))
            if p[:k] in symbols and p[k:] in symbols
        )
        self.pairs, self.ranks, self.formed = (np.array(x, np.int64) for x in zip(*pairs))
        self.maybe = np.zeros(1 << SPOT_BITS, bool)
        self.maybe[_spot(self.pairs)] = True
        within = {p[k : k + 2] for p in score for k in range(len(p) - 1)}
        if any(x[1] == SPACE and x[0] != SPACE for x in within):
            raise ValueError("a piece has a space sign after another character")
        self.prefixed = sp.normalize("a") == SPACE + "a"

    def library(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NEVER`` if it forms no piece) and the symbol formed."""
        key = left.astype(np.int64) << 32 | right
        rank, formed = np.full(len(key), NEVER), np.zeros(len(key), np.int64)
        likely = np.flatnonzero(self.maybe[_spot(key)])  # most pairs that form no piece are not searched for
        spot = np.minimum(np.searchsorted(self.pairs, key[likely]), len(self.pairs) - 1)
        known = self.pairs[spot] == key[likely]
        rank[likely[known]], formed[likely[known]] = self.ranks[spot[known]], self.formed[spot[known]]
        return rank, formed


def merged(v: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of all units, one after another, and where each unit's begin (with the end); no unit is empty."""
    sym = v.chars[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)].astype(np.int64)
    unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
    done, owner = [], []
    last = np.append(unit[1:] != unit[:-1], True)
    rank, formed = v.ranked(sym, np.append(sym[1:], 0))
    rank[last] = NEVER
    while len(sym):
        starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
        best = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(sym)))
        ended = np.repeat(best == NEVER, sizes)
        if ended.any():
            done.append(sym[ended])
            owner.append(unit[ended])
            on = ~ended
            sym, unit, rank, formed, sizes, best = sym[on], unit[on], rank[on], formed[on], sizes[best != NEVER], best[best != NEVER]
            if not len(sym):
                break
        # The leftmost pair of the best rank in each unit.
        hits = np.flatnonzero(rank == np.repeat(best, sizes))
        at = hits[np.append(True, unit[hits[1:]] != unit[hits[:-1]])]
        sym[at] = formed[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))  # places after the right halves are gone
        sym, unit, rank, formed = sym[keep], unit[keep], rank[keep], formed[keep]
        for spots in (at, at[at > 0] - 1):
            after = np.minimum(spots + 1, len(sym) - 1)
            rank[spots], formed[spots] = v.ranked(sym[spots], sym[after])
            rank[spots[(after == spots) | (unit[after] != unit[spots])]] = NEVER
    flat, owners = np.concatenate(done or [sym]), np.concatenate(owner or [unit])
    back = np.argsort(owners, kind="stable")
    return flat[back], np.searchsorted(owners[back], np.arange(len(units) + 1))


def agenda(v: Vocabulary, unit: str) -> np.ndarray:
    """Final symbols of one long unit: the same order of merges, from a heap."""
    sym = v.chars[np.frombuffer(unit.encode("utf-32-le"), np.uint32)].astype(np.int64)
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank, formed = v.ranked(sym[:-1], sym[1:])
    spots = np.flatnonzero(rank != NEVER)
    symbols = sym.tolist()
    heap = [(r, i, symbols[i], symbols[i + 1], f) for r, i, f in zip(rank[spots].tolist(), spots.tolist(), formed[spots].tolist())]
    heapq.heapify(heap)

    def enter(i: int, j: int) -> None:
        key = symbols[i] << 32 | symbols[j]
        k = int(np.searchsorted(v.pairs, key))
        if k < len(v.pairs) and v.pairs[k] == key:
            heapq.heappush(heap, (int(v.ranks[k]), i, symbols[i], symbols[j], int(v.formed[k])))

    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of its halves has been joined to something else
        symbols[i], symbols[j], after[i] = new, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
            enter(i, after[i])
        if before[i] >= 0:
            enter(before[i], i)
    return np.array([s for s in symbols if s >= 0])


class Encoder:
    """Encodes blocks of texts. The ids of all units met lie in one array; from ``KEPT`` units on it is begun anew."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.sp = vocabulary, vocabulary.library()
        self.unit = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.edges = np.empty(0, np.int32), np.zeros(1, np.int64)

    def spelt(self, symbols: np.ndarray) -> list[int]:
        """Ids of symbols, in bytes where a symbol is no piece."""
        v, out = self.v, []
        for s in symbols.tolist():
            if s < len(v.ids) and v.ids[s] >= 0:
                out.append(int(v.ids[s]))
                continue
            char = chr(s - len(v.ids)) if s >= len(v.ids) else chr(int(np.flatnonzero(v.chars == s)[0]))
            out.extend(v.bytes[b] for b in char.encode())
        return out

    def learn(self, units: list[str]) -> None:
        """Enter the ids of new units, each checked against the library."""
        units = sorted(units, key=len)  # those with a heap of their own come last
        short = units[: bisect.bisect_right(units, LONG, key=len)]
        flat, edges = merged(self.v, short)
        # Pieces, ASCII characters that are none (one byte each), and -1 for what takes several bytes.
        ids, sizes = np.concatenate([self.v.ids, self.v.bytes[:128], [-1]]).astype(np.int32)[np.minimum(flat, len(self.v.ids) + 128)], np.diff(edges)
        parts, done = [], 0
        for k in np.unique(np.searchsorted(edges, np.flatnonzero(ids < 0), "right") - 1).tolist():
            own = self.spelt(flat[edges[k] : edges[k + 1]])
            parts += [ids[done : edges[k]], np.array(own, np.int32)]
            done, sizes[k] = edges[k + 1], len(own)
        parts.append(ids[done:])
        parts += (long := [np.array(self.spelt(agenda(self.v, u)), np.int32) for u in units[len(short) :]])
        found, sizes = np.concatenate(parts), np.concatenate([sizes, np.array([len(x) for x in long], np.int64)])
        self.check(units, found, sizes)
        self.index |= zip(units, range(len(self.index), len(self.index) + len(units)))
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, found])

    def check(self, units: list[str], found: np.ndarray, sizes: np.ndarray) -> None:
        """Raise unless the library gives the same ids.

        It puts a space sign before a text if the vocabulary says so; a unit then goes without its first sign. That sign
        alone has no pair, and as an empty text no ids.
        """
        theirs = self.sp.encode([u[1:] for u in units] if self.v.prefixed else units, num_threads=1)
        same = np.fromiter(map(len, theirs), np.int64, len(units)) == sizes
        if self.v.prefixed:
            same |= np.fromiter((u == SPACE for u in units), bool, len(units))
        if same.all():
            theirs = [x or [self.v.ids[self.v.chars[ord(SPACE)]]] for x in theirs]
            if np.array_equal(np.fromiter(itertools.chain.from_iterable(theirs), np.int32, len(found)), found):
                return
        raise ValueError("the sentencepiece library encodes a unit otherwise: the vocabulary is not of the merge type, or has pieces of the user's")

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, each with the end id, and where each text's begin (with the end)."""
        cut = [self.unit.findall(self.sp.normalize(t).decode()) if t else [] for t in texts]
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        met = list(itertools.chain.from_iterable(cut))
        units = np.fromiter(map(self.index.get, met, itertools.repeat(-1)), np.int64, len(met))
        missing = np.flatnonzero(units < 0)
        unknown = [met[i] for i in missing.tolist()]
        new = list(dict.fromkeys(unknown))
        if len(self.index) + len(new) > KEPT:
            self.forget()
            missing, unknown, new = slice(None), met, list(dict.fromkeys(met))
        if new:
            self.learn(new)
            units[missing] = np.fromiter(map(self.index.__getitem__, unknown), np.int64, len(unknown))
        sizes = np.diff(self.edges)[units]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        where = np.arange(ends[-1]) + np.repeat(self.edges[units] - ends[:-1], sizes)
        last = ends[np.cumsum(per_text)]  # the end id follows a text's last unit
        return np.insert(self.flat[where], last, self.v.end), np.concatenate([[0], last + np.arange(1, len(cut) + 1)])


def encoded(docs: DataFrame, model: str, *, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text and, if named, the library's decoding of them.

    ``model``: a sentencepiece model file that the driver reads; its bytes and tables are broadcast (their size is the
    vocabulary's).
    """
    with open(model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary(f.read())))

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary.__new__(Vocabulary)
        vars(v).update(shared.value)
        encoder = Encoder(v)
        for batch in batches:
            for part in blocks(batch, body, BLOCK):
                data, edges = raw(part.column(body))
                flat, cuts = encoder.encode([data[a:b].tobytes() for a, b in zip(edges, edges[1:])])
                columns = [part.column(c) for c in names[:passed]]
                columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32())))
                if decoded:
                    lists = [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
                    columns.append(pa.array(encoder.sp.decode(lists, num_threads=1), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([pa.field(n, c.type) for n, c in zip(names, columns)]))

    body, passed = unused(docs, "_body"), len(docs.columns)
    names = [*docs.columns, ids, *([decoded] if decoded else [])]
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, "string")
    # The text goes along as bytes too: what is not UTF-8 is the normaliser's to replace.
    return docs.withColumn(body, F.col(text).cast("binary")).mapInArrow(encode, schema)


def decoded(docs: DataFrame, model: str, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of each list of ids; a null list gives a null text."""
    with open(model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for lists in batches:
            yield pa.array([None if x is None else sp.decode(x) for x in lists.to_pylist()], pa.string())

    return docs.withColumn(text, F.arrow_udf(decode, "string")(F.col(ids)))
