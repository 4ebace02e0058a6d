"""Importance resampling towards a target corpus by hashed word n-grams.

Text becomes features in bytes: one 256-byte table lower-cases A-Z and blanks every separator, ``bytes.split`` yields the
words, and crc32 of an n-gram is chained from the crc32 of its first n - 1 words. Features fall into ``buckets`` by that
value. Every task sums its counters into one array of ``buckets`` counts, so a corpus sends ``buckets`` rows a task, and two
arrays of that fixed size are all that reaches the driver.

A bucket's gain is the log ratio of its smoothed shares in target and source, in floored thousandths; a document's
weight is the floored mean gain of its features. Its score adds Gumbel noise drawn from a hash of its id, so the highest
scores are a sample without replacement with probabilities in proportion to exp(weight / 1000). The draw counts
documents per score (integers in a narrow range), finds the least score drawn, and ranks only the rows at or above it,
in range partitions.

Defined cases: a null, empty or wordless text has no features and weight 0; an empty source or target has smoothed
shares alone; a null id hashes as an empty one and comes last among ties, repeated ids are told apart by weight and then
arbitrarily, each with a rank of its own; bytes that are not ASCII belong to words, whether or not they are UTF-8; other columns
pass through.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm.shared import buckets_for, settled, tidy, unused
from skyledger.llm.texts import blocks, raw

BUCKETS = 10_000
#: Letters are lower-cased, digits, small letters and bytes beyond ASCII stay, all else is a blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(text: bytes, longest: int) -> tuple[Counter, int]:
    """How often each crc32 of the text's runs of one to ``longest`` words occurs, and how many words it has."""
    words = text.translate(TABLE).split()
    crc = zlib.crc32
    # Equal words have equal values, so each is hashed once.
    counts = Counter()
    for word, n in Counter(words).items():
        counts[crc(word)] += n
    if longest > 1:
        spaced = [b" " + w for w in words]
        seeds = [crc(w) for w in words]
        for n in range(1, longest):
            seeds = [crc(w, seed) for w, seed in zip(itertools.islice(spaced, n, None), seeds)]
            counts.update(seeds)
    return counts, len(words)


def _bucketed(counts: Counter, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and count of each distinct value."""
    n = len(counts)
    return np.fromiter(counts.keys(), np.int64, n) % buckets, np.fromiter(counts.values(), np.int64, n)


def histogram(docs: DataFrame, *, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in blocks(batch, "body"):
                data, edges = raw(part.column("body"))
                for a, b in zip(edges, edges[1:]):
                    spots, n = _bucketed(features(data[a:b].tobytes(), longest)[0], buckets)
                    np.add.at(total, spots, n)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])

    rows = docs.select(F.col(text).cast("binary").alias("body")).mapInArrow(count, "bucket bigint, n bigint")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed shares, per bucket."""
    s, t, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((b + 1) * (s + k) / ((a + 1) * (t + k)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, *, text: str = "text", longest: int = 1, out: str = "weighed") -> DataFrame:
    """``docs`` with a struct (n_words, n_features, weight)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    @tidy
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain = shared.value
        for column in batches:
            rows = []
            for part in blocks(pa.RecordBatch.from_arrays([column], ["body"]), "body"):
                data, edges = raw(part.column("body"))
                for a, b in zip(edges, edges[1:]):
                    counts, words = features(data[a:b].tobytes(), longest)
                    spots, n = _bucketed(counts, len(gain))
                    size = int(n.sum())
                    rows.append((words, size, int((gain[spots] * n).sum()) // size if size else 0))
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n_words", "n_features", "weight"])

    judge = F.arrow_udf(weigh, "struct<n_words:bigint,n_features:bigint,weight:bigint>")
    return docs.withColumn(out, judge(F.col(text).cast("binary")))


def noisy(weight, key, seed: str):
    """Weight plus Gumbel noise from a hash of ``seed``:id, in floored thousandths."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def drawn(scored: DataFrame, take: int, *, row: str, key: str, score: str = "score", eligible: str = "eligible", rank: str = "rank") -> DataFrame:
    """``scored`` with ranks 1 to ``take`` for its eligible rows in order of score, then key; null for the others.

    ``scored`` must be settled, as it is read several times, with a number of its own for each row. Scores are counted
    first; they lie in a range that the counts' logarithms bound, so the counts are few however many documents there are.
    """
    counts = scored.where(eligible).groupBy(score).count().toArrow().sort_by([(score, "descending")])
    passed = np.cumsum(counts["count"].to_numpy())
    if take <= 0 or not len(passed):
        return scored.withColumn(rank, F.lit(None).cast("long"))
    take = min(take, int(passed[-1]))
    cut = counts[score][int(np.searchsorted(passed, take))].as_py()
    order = [F.col(score).desc(), F.col(key).asc_nulls_last(), F.col(row)]
    top = scored.where(F.col(eligible) & (F.col(score) >= cut)).select(score, key, row)
    top = settled(top.repartitionByRange(buckets_for(take), *order).withColumn("_part", F.spark_partition_id()))
    sizes = dict(top.groupBy("_part").count().collect())  # one row a partition
    offsets = [(p, sum(n for q, n in sizes.items() if q < p)) for p in sizes]
    offsets = scored.sparkSession.createDataFrame(offsets, "_part int, _before bigint")
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order)) + F.col("_before")
    ranks = top.join(F.broadcast(offsets), "_part").select(row, place.cast("long").alias(rank)).where(F.col(rank) <= take)
    return scored.join(ranks, row, "left")


def resampled(docs: DataFrame, target: DataFrame, *, key: str, text: str = "text", target_text: str = "text", keep: list[str] | None = None, longest: int = 1, buckets: int = BUCKETS, seed: str = "2024", share: int = 10, least_words: int = 20) -> DataFrame:
    """``docs`` (or its columns ``keep``) with a struct ``drawn`` (n_words, n_features, weight, score, rank).

    ``share`` percent of the documents with at least ``least_words`` words are drawn; rank is null for all others.
    """
    options = {"longest": longest, "buckets": buckets}
    gain = gains(histogram(docs, text=text, **options), histogram(target, text=target_text, **options))
    kept = docs.columns if keep is None else keep
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.struct(*map(F.col, kept)).alias("_doc"))
    score = noisy(F.col("_w.weight"), F.col("_key"), seed).alias("score")
    scored = weighted(rows, gain, text="_text", longest=longest, out="_w").select(
        F.monotonically_increasing_id().alias("_row"), "_key", "_doc", "_w", score, (F.col("_w.n_words") >= least_words).alias("eligible")
    )
    scored = settled(scored)
    ranks = drawn(scored, share * scored.where("eligible").count() // 100, row="_row", key="_key")
    return ranks.select("_doc.*", F.struct("_w.*", "score", "rank").alias(unused(docs, "drawn")))
