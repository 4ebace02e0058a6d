"""Benchmark decontamination: a prefix-filtered join of documents with item windows.

A window is ``window`` consecutive words of an item; a shorter item is one window. Its tokens are its word
shingles. Shingles are ordered by rarity in the documents; a window occurs only where its rarest shingle does, so that
one shingle (the prefix that an exact match needs) is all that is joined. The shingle's place in the window gives
the place where the window would begin (positional bound), which must leave room for all its words inside the document
(length bound); the words found there are then compared one by one. Matches are therefore exact.

Both passes over the documents test shingles against a bitmap of fixed size made from the items; what passes is joined
on the shingle, with Spark's choice of strategy. A fuller bitmap passes more rows and changes no result, so
items may grow without bound. A shingle that many documents share is counted before its shuffle and avoided by rarity.

Defined cases: null or wordless documents have no words, no hits and are not contaminated; null or wordless items
have no windows; null item ids are not listed; equal items all count; repeated documents are judged row by row,
whatever their ids; bytes that are not UTF-8 belong to words, which are compared with U+FFFD in their place; other columns do
not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm.shared import bitmap, settled, tidy, unused, within
from skyledger.llm.texts import ALNUM, U, Words, blocks, rolling

WINDOW = 13
SHINGLE = 5


def _salted(h: np.ndarray, n: int) -> np.ndarray:
    """Shingles of different lengths must not meet."""
    return h ^ U(n * 0x2545F4914F6CDD1D % (1 << 64))


def item_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, n, shingles): every window of every item, its words joined by a space."""

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                w = Words(part.column("text"), ALNUM, lower=True)
                h = w.hashes()
                rows, texts, sizes, shingles = [], [], [], []
                for i in np.flatnonzero(w.counts):
                    n = min(window, int(w.counts[i]))
                    s = min(shingle, n)
                    words = [w.text(j) for j in range(w.first[i], w.first[i] + w.counts[i])]
                    grams = _salted(rolling(h[w.first[i] : w.first[i] + w.counts[i]], s), s).view(np.int64)
                    for at in range(len(words) - n + 1):
                        rows.append(i)
                        texts.append(b" ".join(words[at : at + n]).decode("utf-8", "replace"))
                        sizes.append(n)
                        shingles.append(grams[at : at + n - s + 1].tolist())
                ids = part.column("item_id").take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(shingles, pa.list_(pa.int64()))],
                    ["item_id", "words", "n", "shingles"],
                )

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, f"item_id {kind}, words string, n int, shingles array<bigint>")


def _counted(docs: DataFrame, text: str, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(shingle, freq): how often each shingle that the bitmap may hold occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                w = Words(part.column("text"), ALNUM, lower=True)
                h, found = w.hashes(), []
                for s in sizes:
                    g = _salted(rolling(h, s), s)
                    found.append(g[w.whole(s) & within(shared.value, g)])
                values, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["shingle", "freq"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "shingle bigint, freq bigint")
    return rows.groupBy("shingle").agg(F.sum("freq").alias("freq"))


def _sought(docs: DataFrame, text: str, key: str, bits: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """One row per document: its words, and each prefix shingle with the words around it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @tidy
    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                w = Words(part.column("text"), ALNUM, lower=True)
                h = w.hashes()
                out: list[list] = [[] for _ in range(part.num_rows)]
                for s in sizes:
                    g = _salted(rolling(h, s), s)
                    for p in np.flatnonzero(w.whole(s) & within(shared.value, g)):
                        i = w.row[p]
                        begin = max(p - (window - s), w.first[i])
                        end = min(p + window, w.first[i] + w.counts[i])
                        near = b" ".join(w.text(j) for j in range(begin, end)).decode("utf-8", "replace")
                        out[i].append({"shingle": int(g[p].view(np.int64)), "at": int(p - w.first[i]), "inset": int(p - begin), "near": near})
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(w.counts.astype(np.int64)), pa.array(out, pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int64()), ("inset", pa.int32()), ("near", pa.string())])))],
                    ["key", "n_words", "found"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(seek, f"key {kind}, n_words bigint, found array<struct<shingle:bigint,at:bigint,inset:int,near:string>>")


def report(docs: DataFrame, items: DataFrame, key: str, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, share: int = 20) -> DataFrame:
    """One row per document row: ``key``, n_words, n_hit, items (sorted ids as text), contaminated.

    ``contaminated``: some word is hit and at least one in ``share`` of the words.
    """
    listed = settled(item_windows(items, item_id, item_text, window, shingle))
    windows = listed.select("words", "n", "shingles").dropDuplicates(["words", "n"])
    sizes = [r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect()]  # at most ``shingle`` values
    places = windows.select("words", "n", F.posexplode("shingles").alias("inset", "shingle"))
    freq = _counted(docs, text, bitmap(places, "shingle"), sizes) if sizes else None
    id_column = unused(docs, "_row")
    numbered = docs.select(F.col(key), F.col(text), F.monotonically_increasing_id().alias(id_column))
    if freq is None:
        rarest = places.select("words", "n", "shingle", F.col("inset").alias("offset")).limit(0)
    else:
        # A window with a shingle that no document has cannot occur.
        rarest = settled(
            places.join(freq, "shingle", "left")
            .groupBy("words", "n")
            .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "shingle", "inset")).alias("r"))
            .where("r.freq > 0")
            .select("words", "n", "r.shingle", F.col("r.inset").alias("offset"))
        )
    both = numbered.select(id_column, F.struct(F.col(key), F.col(id_column)).alias("_key"), text)
    found = settled(_sought(both, text, "_key", bitmap(rarest, "shingle"), sizes, window))
    row = F.col(f"key.{id_column}")
    hits = (
        found.select(row.alias("row"), F.explode("found").alias("f"))
        .select("row", "f.*")
        .join(rarest, "shingle")
        .withColumn("begin", F.col("inset") - F.col("offset"))
        .where("begin >= 0")
        .where(F.array_join(F.slice(F.split("near", " "), F.col("begin") + 1, F.col("n")), " ") == F.col("words"))
        .select("row", (F.col("at") - F.col("offset")).alias("start"), "n", "words")
    )
    hits = settled(hits)
    ends = hits.groupBy("row", "start").agg((F.col("start") + F.max("n")).alias("end"))
    before = F.max("end").over(W.partitionBy("row").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))))
    words_hit = ends.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = (
        hits.select("row", "words", "n").distinct()
        .join(listed.select("words", "n", F.col("item_id").cast("string").alias("item")).distinct(), ["words", "n"])
        .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        found.select(F.col(f"key.{key}").alias(key), row.alias("row"), "n_words")
        .join(words_hit, "row", "left")
        .join(named, "row", "left")
        .select(
            key, "n_words", n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame, *, text: str = "text", item_text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, all columns kept. Equal texts share a verdict."""
    mark = unused(docs, "_mark")
    marked = docs.withColumn(mark, F.struct(F.md5(F.col(text).cast("binary")), F.length(text)))
    verdicts = report(marked, items, mark, text=text, item_text=item_text, **options)
    dirty = verdicts.where("contaminated").select(mark).distinct()
    return marked.join(dirty, mark, "left_anti").select(*docs.columns)
