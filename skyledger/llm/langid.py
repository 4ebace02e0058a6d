"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text is the mean of the embeddings of its byte 2-, 3- and 4-grams (letters lower-cased, everything else a
space), hashed to ``BUCKETS`` rows per order; a linear softmax reads the mean. Both layers are trained together by
stochastic gradient descent in numpy on a bounded sample: at most ``per_language`` distinct labelled texts of each of at most
``languages`` languages, chosen by a hash, whole texts and short spans of them. A fifth of the sample is kept back: on it a
temperature is fitted, and a text is rejected that scores lower than halfway between chance and the least certain text kept back.

Scoring walks every whole text. Embedding and softmax are both linear, so their product is tabulated once and a text
costs one table row per n-gram.

Defined cases: a null or empty text, or one without a letter, is ``und`` with score 0 and rejected; without labelled
rows there is nothing to learn and every text is ``und``; a single language is predicted with score 1; equal scores go
to the first language in code-point order; repeated rows are scored alike; other columns pass through.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm.shared import tidy, unused
from skyledger.llm.texts import LOWER, blocks, raw

ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
#: Bytes that are scored at once, whatever the length of a text.
PIECE = 1 << 17
DIM = 16
#: Bytes that count as letters of a word: ASCII letters and everything beyond ASCII.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x41:0x5B] = LOWER[0x41:0x5B]
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclasses.dataclass
class Model:
    """``table``: (orders, buckets + 1, languages); the last bucket is empty and takes n-grams cut by a row's end."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, body: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Mean n-gram scores of each row of a block."""
        sums = np.zeros((len(rows) - 1, len(self.languages)))
        most = max(ORDERS) - 1
        for at in range(0, len(body), PIECE):
            # Rows that the piece touches, cut to it; n-grams of its last bytes reach beyond it.
            stop = min(at + PIECE, len(body))
            first, last = np.searchsorted(rows, at, "right") - 1, np.searchsorted(rows, stop)
            ends = np.clip(rows[first : last + 1] - at, 0, None)
            reach = min(stop + most, rows[last]) - at
            grams = _grams(body[at : at + reach], np.minimum(ends, reach))
            total = np.zeros((stop - at, len(self.languages)), np.float32)
            for t, spots in zip(self.table, grams):
                total += t[spots[: stop - at]]
            full = np.flatnonzero(np.diff(np.minimum(ends, stop - at)))
            sums[first + full] += np.add.reduceat(total, ends[full], axis=0, dtype=np.float64)
        return self.bias + sums / np.maximum(1, len(ORDERS) * np.diff(rows))[:, None]

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language index (-1: ``und``) and probability of each text."""
        best, score = [np.empty(0, int)], [np.empty(0)]
        for part in blocks(pa.RecordBatch.from_arrays([column], ["text"])):
            body, rows = raw(part.column(0))
            letters = _lettered(body, rows)
            if not self.languages:
                best.append(np.full(len(letters), -1))
                score.append(np.zeros(len(letters)))
                continue
            p = _softmax(self.logits(_FOLD[body], rows) / self.temperature)
            top = p.argmax(axis=1)
            best.append(np.where(letters, top, -1))
            score.append(np.where(letters, p[np.arange(len(top)), top], 0.0))
        return np.concatenate(best), np.concatenate(score)


def _grams(body: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram that begins at each byte, for each order."""
    out = []
    value = body.astype(np.uint32)
    left = np.repeat(rows[1:], np.diff(rows)) - np.arange(len(body))
    for n in range(2, max(ORDERS) + 1):
        if len(body) >= n:
            value[: len(body) - n + 1] += body[n - 1 :].astype(np.uint32) << np.uint32(8 * (n - 1))
        if n in ORDERS:
            spots = ((value * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)
            spots[left < n] = BUCKETS
            out.append(spots)
    return out


def _lettered(body: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each row has a letter of any script."""
    out = np.zeros(len(rows) - 1, bool)
    full = np.flatnonzero(np.diff(rows))
    if len(full):
        ascii_letter = (_FOLD[body] != 0x20) & (body < 0x80)
        out[full] = np.logical_or.reduceat(ascii_letter, rows[:-1][full])
        for i in full[~out[full]]:
            out[i] = any(c.isalpha() for c in body[rows[i] : rows[i + 1]].tobytes().decode("utf-8", "ignore"))
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _spans(texts: list[str], rng: np.random.Generator) -> list[str]:
    """Each text, and a span of one to twelve of its words."""
    out = []
    for t in texts:
        words = t.split()
        n = int(rng.integers(1, 13))
        at = int(rng.integers(0, max(1, len(words) - n)))
        out += [t, " ".join(words[at : at + n])]
    return out


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (order, bucket) rows of each text and their shares, all in two arrays, and where each text's begin.

    The arrays are as long as all n-grams but only touched as far as they are filled, and go back to the system at once.
    """
    bodies = [_FOLD[np.frombuffer(t.encode("utf-8", "ignore"), np.uint8)] if t else np.empty(0, np.uint8) for t in texts]
    room = len(ORDERS) * sum(map(len, bodies))
    rows, shares, edges = np.empty(room, np.int32), np.empty(room, np.float32), [0]
    for body in bodies:
        at = edges[-1]
        if len(body):
            spots = _grams(body, np.array([0, len(body)]))
            flat = np.concatenate([s[s != BUCKETS] + k * (BUCKETS + 1) for k, s in enumerate(spots)])
            ids, counts = np.unique(flat, return_counts=True)
            rows[at : at + len(ids)], shares[at : at + len(ids)] = ids, counts / (len(ORDERS) * len(body))
            at += len(ids)
        edges.append(at)
    return rows, shares, np.array(edges)


def fit(texts: list[str], langs: list[str], *, epochs: int = 6, rate: float = 20.0, seed: int = 7) -> Model:
    """Train on labelled texts; every fifth text calibrates."""
    languages = sorted(set(langs))
    c = len(languages)
    rng = np.random.default_rng(seed)
    if c < 2:
        return Model(languages, np.zeros((len(ORDERS), BUCKETS + 1, c), np.float32), np.zeros(c))
    index = {x: i for i, x in enumerate(languages)}
    held = np.arange(len(texts)) % 5 == 4
    train = [t for t, h in zip(texts, held) if not h]
    labels = np.repeat([index[x] for x, h in zip(langs, held) if not h], 2)
    rows, shares, edges = _features(_spans(train, rng))
    emb = rng.standard_normal((len(ORDERS) * (BUCKETS + 1), DIM), np.float32) * np.float32(0.3)
    soft, bias = rng.normal(0, 0.3, (DIM, c)).astype(np.float32), np.zeros(c)
    steps, step = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            ids, share = rows[edges[i] : edges[i + 1]], shares[edges[i] : edges[i + 1]]
            lr = rate * (1 - step / steps)
            step += 1
            if not len(ids):
                continue
            mean = share @ emb[ids]
            p = _softmax((mean @ soft + bias)[None])[0]
            p[labels[i]] -= 1
            back = (soft @ p).astype(np.float32)
            soft -= (0.005 * lr * np.outer(mean, p)).astype(np.float32)
            bias -= 0.0005 * lr * p
            emb[ids] -= np.float32(lr) * share[:, None] * back
    table = (emb @ soft).reshape(len(ORDERS), BUCKETS + 1, c).astype(np.float32)
    table[:, BUCKETS] = 0
    model = Model(languages, table, bias)
    kept = [(t, index[x]) for t, x, h in zip(texts, langs, held) if h] or [(t, index[x]) for t, x in zip(texts, langs)]
    _calibrate(model, [t for t, _ in kept], np.array([k for _, k in kept]))
    return model


def _calibrate(model: Model, texts: list[str], labels: np.ndarray) -> None:
    """The temperature that makes labelled texts and spans likeliest, and the score below which a text is rejected."""
    both = pa.array(_spans(texts, np.random.default_rng(11)), pa.string())
    parts = [raw(p.column(0)) for p in blocks(pa.RecordBatch.from_arrays([both], ["text"]))]
    z = np.concatenate([model.logits(_FOLD[b], r) for b, r in parts])
    at = (np.arange(len(z)), np.repeat(labels, 2))
    fits = [(-np.log(_softmax(z / t)[at] + 1e-9).mean(), t) for t in np.geomspace(0.01, 10, 80)]
    model.temperature = float(min(fits)[1])
    top = np.sort(_softmax(z[::2] / model.temperature).max(axis=1))
    # A text in none of the languages scores about chance, so the threshold is not far above it, however sure the labelled texts are.
    chance = 1 / len(model.languages)
    model.threshold = float(min((chance + top[0]) / 2, chance + 0.2))


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang", per_language: int = 900, languages: int = 500) -> Model:
    """Fit on at most ``per_language`` distinct texts of each of the ``languages`` most frequent labels, the documented bound.

    Distinct texts are counted by their hashes and drawn by a hash against a share per language; copies of a drawn text are
    dropped per task first, and an ordered limit per language makes the bound exact. Nothing else reaches the driver.
    """
    body, code = F.col(text).cast("binary"), F.xxhash64(F.lit("language sample"), F.col(text).cast("binary"))
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(text) != ""))
    rows = rows.select(F.col(lang).alias("l"), body.alias("t"), code.alias("k"))
    counts = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("k", 0.02).alias("d"))
    counts = counts.orderBy(F.desc("n"), "l").limit(languages)
    share = F.least(F.lit(1.0), F.lit(1.3 * per_language) / F.greatest(F.lit(1), "d"))
    limits = counts.select(F.col("l").alias("_l"), (share * (1 << 30)).cast("long").alias("_below"))
    drawn = rows.join(F.broadcast(limits), F.col("l") == F.col("_l")).where(F.pmod("k", F.lit(1 << 30)) < F.col("_below"))
    one = drawn.groupBy("l", "k").agg(F.min("t").alias("t"))
    place = F.row_number().over(W.partitionBy("l").orderBy("k"))
    sample = one.withColumn("place", place).where(F.col("place") <= per_language).select("l", "t", "k").toArrow()
    if not sample.num_rows:
        return Model([], np.zeros((len(ORDERS), BUCKETS + 1, 0), np.float32), np.zeros(0))
    sample = sample.sort_by([("k", "ascending"), ("l", "ascending")])
    return fit([t.decode("utf-8", "replace") for t in sample["t"].to_pylist()], sample["l"].to_pylist())


def identify(docs: DataFrame, model: Model, *, text: str = "text", lang_pred: str = "lang_pred", score: str = "score", rejected: str = "rejected") -> DataFrame:
    """``docs`` with the predicted language, its calibrated probability and whether the text is rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @tidy
    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(**shared.value)
        for column in columns:
            best, p = m.predict(column)
            names = pa.array([*m.languages, "und"], pa.string()).take(pa.array(best % (len(m.languages) + 1)))
            yield pa.StructArray.from_arrays([names, pa.array(p, pa.float64()), pa.array((best < 0) | (p < m.threshold))], ["l", "s", "r"])

    said = unused(docs, "_said")
    out = docs.withColumn(said, F.arrow_udf(judge, "struct<l:string,s:double,r:boolean>")(F.col(text)))
    return out.select(*docs.columns, F.col(f"{said}.l").alias(lang_pred), F.col(f"{said}.s").alias(score), F.col(f"{said}.r").alias(rejected))


def held_out(doc_id: str, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as held out by neither."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))
