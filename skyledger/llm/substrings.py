"""Substring dedup by level-wise doubling: words covered by a window that also starts earlier are removed.

Levels have 5, 10, ... words and double up to the window. At each level a window that may still repeat stands for itself by
its anchors, the smallest hashes of its grams of that length (equal windows have equal anchors, so none is lost); the
grams are counted over all documents, combined before the shuffle, and a window whose anchor occurs once is out.
Survivors alone are extended to twice the length; at the window's own length they are compared by 128-bit
fingerprints and all but the earliest occurrence is marked. Doubling ends there: longer repeats consist of repeated
windows, so no candidate beyond it can change a removal.

Repeated grams go to the next level as a bitmap of fixed size, a filter that never misses: a fuller one only leaves
more windows for the exact comparison. A task sends one row per window content and flush, whatever the number of its copies,
so a passage in a third of all documents is no hot key; its other copies are marked on the spot. Only different texts that share
an id, or have none, and begin the passage at the same word are sent each.

Defined cases: null, empty and short texts have no window and lose nothing; earlier means smaller id, or the same id and an earlier
start, so that equal rows with one id keep their words; rows that share an id but not a text are marked apart; a null id
comes last; bytes that are not UTF-8 are kept as they are; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shared import bitmap, settled, within
from skyledger.llm.texts import SPACES, U, Words, blocks, raw, rolling, sliding

WINDOW = 20
SHORTEST = 5
BITS = 26
#: Candidate windows that a task compares among themselves before it sends one of each content.
FLUSH = 1 << 20
#: Candidate windows per reducing task.
PER_TASK = 500_000
_LAST = (1 << 63) - 1
_START = (1 << 32) - 1


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Halvings of the window down to about ``shortest`` words, shortest first, without the window."""
    out = []
    n = window // 2
    while n >= shortest:
        out.append(n)
        n //= 2
    return out[::-1] or [max(1, window // 2)]


def _candidates(w: Words, h: np.ndarray, window: int, done: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Which windows still may repeat after the levels done."""
    alive = w.whole(window)
    for n, bits in done:
        alive &= within(bits, sliding(rolling(h, n), window - n + 1))
    return alive


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(own, id, tag, text): the id as given, the order of documents, and 31 bits that tell apart texts that share an id."""
    tag = F.pmod(F.xxhash64(F.lit("tag"), F.col(text)), F.lit(1 << 31)).alias("tag")
    return docs.select(F.col(doc_id).alias("own"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("id"), tag, F.col(text).alias("text"))


def _repeated(rows: DataFrame, window: int, n: int, done: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, int]:
    """Bitmap of the anchors of ``n`` words that occur more than once, and the number of candidate windows."""
    shared = rows.sparkSession.sparkContext.broadcast(done)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                w = Words(part.column("text"))
                h = w.hashes()
                alive = _candidates(w, h, window, shared.value)
                g = rolling(h, n)
                span = window - n + 1
                least = np.where(alive, sliding(g, span), U(0))
                # A gram is an anchor if it is the smallest of some candidate window that holds it.
                chosen = sliding(least[::-1], span, np.maximum)[::-1]
                values, counts = np.unique(g[(chosen == g) & (chosen != 0)], return_counts=True)
                grams = pa.array(np.append(values.view(np.int64), 0), mask=np.arange(len(values) + 1) == len(values))
                yield pa.RecordBatch.from_arrays([grams, pa.array(np.append(counts, alive.sum()).astype(np.int64))], ["gram", "n"])

    counted = rows.select("text").mapInArrow(anchors, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    found = settled(counted.where("n > 1 OR gram IS NULL"))
    alive = found.where("gram IS NULL").agg(F.sum("n")).first()[0] or 0
    return bitmap(found, "gram", BITS), alive


def _later(h1: np.ndarray, h2: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with equal fingerprints: the places of the first of each text that has the earliest start, and of those that start later."""
    start, tag = pos & _START, pos >> 32
    order = np.lexsort((tag, start, ids, h2, h1))
    a, b, i, s = h1[order], h2[order], ids[order], start[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    later = (i != i[head]) | (s != s[head])
    # Texts that share an id tie; each is sent, as an earlier occurrence elsewhere marks them all.
    tied = ~later
    tied[1:] &= new[1:] | (tag[order][1:] != tag[order][:-1])
    return order[tied], order[later]


def repeats(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, tag, start, run): runs of windows of (id, tag, text) rows whose words also start earlier."""
    done: list[tuple[int, np.ndarray]] = []
    alive = 0
    for n in levels(window):
        bits, alive = _repeated(rows, window, n, done)
        done = [*done, (n, bits)]
    shared = rows.sparkSession.sparkContext.broadcast(done)
    names = ["h1", "h2", "id", "pos", "run"]

    def sent(held: list[tuple]) -> pa.RecordBatch:
        h1, h2, ids, pos = (np.concatenate([x[k] for x in held]) for k in range(4))
        first, later = _later(h1, h2, ids, pos)
        # Copies met here are marked at once, consecutive windows as one run; they need no partner and no fingerprint.
        i, p = ids[later], pos[later]
        order = np.lexsort((p, i))
        i, p = i[order], p[order]
        begins = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (p[1:] != p[:-1] + 1))[: len(i)])
        runs = np.diff(np.append(begins, len(i)))
        none = np.zeros(len(begins), U)
        columns = [
            np.concatenate([h1[first], none]).view(np.int64), np.concatenate([h2[first], none]).view(np.int64),
            np.concatenate([ids[first], i[begins]]), np.concatenate([pos[first], p[begins]]),
            np.concatenate([np.zeros(len(first), np.int64), runs]).astype(np.int32),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in blocks(batch):
                w = Words(part.column("text"))
                h = w.hashes()
                at = np.flatnonzero(_candidates(w, h, window, shared.value))
                if len(at):
                    row = w.row[at]
                    ids, tags = (part.column(c).to_numpy()[row] for c in ("id", "tag"))
                    held.append((rolling(h, window)[at], rolling(w.hashes(1), window, 1)[at], ids, (tags << 32) | (at - w.first[row])))
                    size += len(at)
                if size >= FLUSH:
                    yield sent(held)
                    held, size = [], 0
        if held:
            yield sent(held)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        h1, h2, ids, pos, run = (table[c].to_numpy() for c in names)
        one = np.flatnonzero(run == 0)
        _, later = _later(h1[one], h2[one], ids[one], pos[one])
        out = np.concatenate([np.flatnonzero(run), one[later]])
        for a in range(0, len(out), 1 << 17):
            some = out[a : a + (1 << 17)]
            columns = [ids[some], pos[some] >> 32, (pos[some] & _START).astype(np.int32), np.maximum(run[some], 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "tag", "start", "run"])

    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-alive // PER_TASK))
    windows = rows.mapInArrow(emit, "h1 bigint, h2 bigint, id bigint, pos bigint, run int")
    dealt = windows.repartition(tasks, F.when(F.col("run") == 0, F.col("h1")).otherwise(F.col("id")))
    return dealt.mapInArrow(settle, "id bigint, tag bigint, start int, run int")


def _covered(starts: np.ndarray, runs: np.ndarray, words: int, window: int) -> np.ndarray:
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + runs - 1 + window, words), -1)
    return np.cumsum(edge)[:words] > 0


def removed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: kept words joined by one space, or their SHA-256 with ``digest``."""
    rows = _keyed(docs, doc_id, text)
    marks = settled(repeats(rows.select("id", "tag", "text"), window).groupBy("id", "tag").agg(F.collect_set(F.struct("start", "run")).alias("starts")))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(marks, "id", BITS))
    # ``kept`` is final where no mark can exist; else it carries the text to the marks.
    say = (lambda b: hashlib.sha256(b).hexdigest().encode()) if digest else (lambda b: b)
    fields = "id bigint, tag bigint, whole boolean, n_words bigint, kept binary"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                hit = within(shared.value, part.column("id").to_numpy().view(U))
                counts, kept = [], []
                body, edges = raw(part.column("text"))
                for a, b, maybe in zip(edges, edges[1:], hit):
                    words = body[a:b].tobytes().split()
                    counts.append(len(words))
                    joined = b" ".join(words)
                    kept.append(joined if maybe else say(joined))
                yield pa.RecordBatch.from_arrays(
                    [part.column("own"), part.column("id"), part.column("tag"), pa.array(~hit), pa.array(counts, pa.int64()), pa.array(kept, pa.binary())],
                    ["own", "id", "tag", "whole", "n_words", "kept"],
                )

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, kept = [], []
            for t, whole, starts in zip(batch.column("kept"), batch.column("whole"), batch.column("starts")):
                t = t.as_py()
                if whole.as_py():
                    gone.append(0)
                    kept.append(t)
                    continue
                words = t.split()
                if starts.is_valid:
                    lost = _covered(*(starts.values.field(k).to_numpy().astype(np.int64) for k in (0, 1)), len(words), window)
                    words, n = [x for x, out in zip(words, lost) if not out], int(lost.sum())
                else:
                    n = 0
                gone.append(n)
                kept.append(say(b" ".join(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), batch.column("n_words"), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], ["own", "n_words", "n_removed", "kept"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    started = rows.mapInArrow(first, f"own {kind}, {fields}")
    met = started.join(marks, ["id", "tag"], "left").select("own", "whole", "n_words", "kept", "starts")
    out = met.mapInArrow(last, f"own {kind}, n_words bigint, n_removed bigint, kept binary")
    return out.select(F.col("own").alias(doc_id), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))
