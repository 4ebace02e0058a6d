"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources, in code-point order with null last, weigh 5, 2, 1, repeating, and share the words of all documents. A
target stops at ``EPOCHS`` times its source's size, the excess being shared again by weight (water filling). A source
is taken in whole epochs as often as its target holds it; the rest of the target is filled by documents in the order
of their keys, an exponential variate divided by the document's quality weight, until the next would pass the
budget. As documents are indivisible, up to two closing documents then fill the gap that is left as nearly as
one document each can.

A key depends on the document alone, so reruns agree, and a choice is a cut on the key: nothing is joined by id.
The cut is found on a histogram of keys (at most ``BINS`` rows a source, combined before the shuffle) and then
exactly inside one bin, so a source with most of the rows is never sorted in one task.

Defined cases: a null or empty text has size 0, and is taken 0 words; a null source is a source; equal rows (id and text)
have one key and are taken together; null ids are hashed as such; an empty table gives an empty result. The table of
sources, one row each, is ordered in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm.shared import settled, unused
from skyledger.llm.texts import SPACES, Words, blocks

WEIGHTS = (5, 2, 1)
EPOCHS = 3
BINS = 4096
SEED = 17
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def _measure(column: pa.Array) -> pa.Array:
    """Words, and a quality weight from 0.5 to 1: half and half the share of letters among all bytes but white space."""
    sizes, quality = [], []
    for part in blocks(pa.RecordBatch.from_arrays([column], ["text"])):
        w = Words(part.column(0))
        solid = np.concatenate([[0], np.cumsum(SPACES[w.body])])
        letter = np.concatenate([[0], np.cumsum(_LETTER[w.body])])
        n = np.diff(solid[w.rows])
        sizes.append(w.counts.astype(np.int64))
        quality.append(0.5 + 0.5 * np.diff(letter[w.rows]) / np.maximum(n, 1))
    sizes, quality = (np.concatenate(x) if x else np.empty(0) for x in (sizes, quality))
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(quality, pa.float64())], ["size", "weight"])


def _keyed(docs: DataFrame, doc_id: str, source: str, text: str, out: str) -> DataFrame:
    """``docs`` with ``out``: source, size and sampling key."""
    said = unused(docs, "_measured")
    hashed = F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text))
    uniform = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / float(1 << 53)
    measured = docs.withColumn(said, F.arrow_udf(_measure, "struct<size:bigint,weight:double>")(F.col(text)))
    key = -F.log(uniform) / F.col(f"{said}.weight")
    return measured.withColumn(out, F.struct(F.col(source).alias("source"), F.col(f"{said}.size").alias("size"), key.alias("key"))).drop(said)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) for (source, source_size)."""
    order = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(order - 1, F.lit(len(weights))) + 1)
    listed = sizes.withColumn("weight", weight).withColumn("cap", epochs * F.col("source_size").cast("double"))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # If the sources before this one are capped, this is what a unit of weight gets of the rest.
    level = (F.sum("source_size").over(every) - (F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, 0)) - F.col("cap"))) / F.sum(
        "weight"
    ).over(by_cap.rowsBetween(0, W.unboundedFollowing))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    return (
        listed.withColumn("level", level)
        .withColumn("level", F.max(fits).over(every))
        .select("source", "source_size", F.least("cap", F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"))
    )


def _chosen(b: str = "bin", cut: str = "cut"):
    return F.coalesce((F.col("kb") < F.col(b)) | ((F.col("kb") == F.col(b)) & (F.col("key") <= F.col(cut))), F.lit(False))


def _bin():
    return F.least(F.floor((1 - F.exp(-F.col("key"))) * BINS), F.lit(BINS - 1)).cast("int")


def choices(keyed: DataFrame) -> DataFrame:
    """One row per source: size, target, whole epochs, and which keys the fractional epoch takes."""
    units = settled(keyed.groupBy("source", "key").agg(F.sum("size").alias("size")).where("size > 0").withColumn("kb", _bin()))
    # A source of empty documents has a target too: none.
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets(sizes).withColumn("full", full).withColumn("budget", F.col("target") - F.col("full") * F.col("source_size"))
    plan = settled(plan)

    def join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
        return a.join(b.withColumnRenamed("source", "_other"), F.col("source").eqNullSafe(F.col("_other")), how).drop("_other")

    filled = units.groupBy("source", "kb").agg(F.sum("size").alias("s"))
    filled = filled.withColumn("cum", F.sum("s").over(W.partitionBy("source").orderBy("kb")))
    edge = join(filled, plan.select("source", "budget")).where("cum > budget").groupBy("source").agg(
        F.min_by(F.struct(F.col("kb").alias("bin"), (F.col("cum") - F.col("s")).alias("below")), "kb").alias("e")
    )
    plan = join(plan, edge.select("source", "e.bin", "e.below"), "left").withColumn("bin", F.coalesce("bin", F.lit(BINS)))
    inside = join(units, plan.select("source", "budget", "bin", "below")).where("kb = bin")
    inside = inside.withColumn("cum", F.col("below") + F.sum("size").over(W.partitionBy("source").orderBy("key")))
    cuts = inside.where("cum <= budget").groupBy("source").agg(F.max("key").alias("cut"))
    plan = settled(join(plan, cuts, "left").drop("below"))
    for closing in ("first_close", "second_close"):
        taken = [F.coalesce(F.col("key") == F.col(c), F.lit(False)) for c in plan.columns if c.endswith("_close")]
        mark = _chosen()
        for t in taken:
            mark = mark | t
        marked = join(units, plan).withColumn("in", mark)
        gap = marked.groupBy("source").agg((F.max("budget") - F.coalesce(F.sum(F.when(F.col("in"), F.col("size"))), F.lit(0))).alias("gap"))
        best = (
            join(marked.where("NOT in").select("source", "key", "size"), gap)
            .where("size <= gap")
            .groupBy("source")
            .agg(F.max(F.struct(F.col("size"), (-F.col("key")).alias("k"))).alias("best"))
            .select("source", (-F.col("best.k")).alias(closing))
        )
        plan = settled(join(plan, best, "left"))
    return plan


def mix(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", out: str = "mix") -> DataFrame:
    """``docs`` with struct ``out``: size, source_size, target and how often the document is taken (0 to ``EPOCHS``)."""
    keyed = _keyed(docs, doc_id, source, text, out)
    plan = choices(settled(keyed.select(f"{out}.*")))
    at = unused(docs, "_plan")
    plan = plan.select(F.struct(*[F.col(c) for c in plan.columns]).alias(at))
    joined = keyed.join(plan, F.col(f"{out}.source").eqNullSafe(F.col(f"{at}.source")), "inner")
    key, kb = F.col(f"{out}.key"), F.least(F.floor((1 - F.exp(-F.col(f"{out}.key"))) * BINS), F.lit(BINS - 1))
    p = lambda c: F.col(f"{at}.{c}")
    fraction = F.coalesce((kb < p("bin")) | ((kb == p("bin")) & (key <= p("cut"))), F.lit(False))
    for closing in ("first_close", "second_close"):
        fraction = fraction | F.coalesce(key == p(closing), F.lit(False))
    times = F.when(F.col(f"{out}.size") > 0, p("full") + fraction.cast("long")).otherwise(F.least(p("full"), F.lit(1)))
    return joined.withColumn(
        out, F.struct(F.col(f"{out}.size").alias("size"), p("source_size").alias("source_size"), p("target").alias("target"), times.alias("times"))
    ).drop(at)


def mixed(docs: DataFrame, **columns: str) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept."""
    out = unused(docs, "_mix")
    taken = mix(docs, **columns, out=out)
    return taken.withColumn(out, F.explode(F.expr(f"array_repeat(0, cast(`{out}`.times AS INT))"))).select(*docs.columns)
