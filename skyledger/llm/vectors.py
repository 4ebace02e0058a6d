"""Near-duplicate vectors within equal labels by a small-world graph per shard.

Equal vectors are collapsed first (counted before the shuffle), so a vector in a third of all rows is one. The distinct vectors of a
label are dealt to shards of about ``SHARD``, a large label to many; each shard is indexed once, written to the shared
checkpoint folder, and queried with every vector of its label, a pair of shards per task. A pair's beams widen twofold until
an audit of ``AUDIT`` queries against all vectors of the shard finds a recall of ``RECALL``, and for a query whose beam
holds nothing but links until it does; at the shard's size the search is exhaustive. What is found is verified by its cosine
in double precision. A task returns link counts and a spanning forest of its links, never the pairs.

Defined cases: null, empty and zero vectors, vectors with null or non-finite parts, and rows without a label or id link with
nothing and are their own component; vectors of different length do not link; rows with equal vectors count one
another; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import components
from skyledger.llm.graph import Graph
from skyledger.llm.shared import settled

SHARD = 8192
AUDIT, RECALL = 512, 0.995
FIRST_BEAM = 64
#: Single precision decides what is verified; it errs by far less than this.
SLACK = 1e-4


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _index(table: pa.Table) -> pa.Table:
    table = table.sort_by("id")
    raw = _matrix(table["vector"])
    # Scaled by powers of two, which no cosine feels, so that squares of very large or small parts neither overflow nor vanish.
    raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])
    unit = (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)
    graph = Graph(unit)
    layers = [x.tobytes() for x in graph.layers]
    columns = {c: table[c].slice(0, 1) for c in ("label", "dim", "shard", "shards")}
    blobs = {"ids": [table["id"].to_numpy().tobytes()], "copies": [table["copies"].to_numpy().tobytes()], "raw": [raw.tobytes()]}
    return pa.table({**columns, **{k: pa.array(v, pa.binary()) for k, v in blobs.items()}, "layers": pa.array([layers], pa.list_(pa.binary()))})


class _Shard:
    def __init__(self, ids: bytes, copies: bytes, raw: bytes, layers: list[bytes] | None):
        self.ids, self.copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        self.raw = np.frombuffer(raw, np.float64).reshape(len(self.ids), -1)
        self.norm = np.linalg.norm(self.raw, axis=1)
        self.unit = (self.raw / self.norm[:, None]).astype(np.float32)
        if layers is not None:
            self.graph = Graph(self.unit, [np.frombuffer(x, np.int32).reshape(len(self.ids), -1) for x in layers])


def _found(queries: np.ndarray, shard: _Shard, least: float):
    """Links of a block of queries: blocks of (query rows, shard rows), after widening and audits."""
    n = len(shard.ids)
    audit = np.random.default_rng(3).permutation(len(queries))[:AUDIT]
    exact = queries[audit] @ shard.unit.T >= least
    width = min(FIRST_BEAM, n)
    while width < n:
        ids, sims = shard.graph.search(queries[audit], width)
        got = ((sims >= least) & (ids >= 0)).sum()
        # Beams that are full of links are widened one by one below.
        full = sims[:, -1] >= least
        if got >= RECALL * exact[~full].sum() + got - ((sims >= least) & (ids >= 0))[~full].sum():
            break
        width *= 2
    open_ = np.arange(len(queries))
    while len(open_):
        left = []
        for a in range(0, len(open_), 512):
            some = open_[a : a + 512]
            ids, sims = shard.graph.search(queries[some], min(width, n))
            good = (sims >= least) & (ids >= 0)
            full = good[:, -1] & (ids.shape[1] < n)
            left.append(some[full])
            q, k = np.nonzero(good & ~full[:, None])
            yield some[q], ids[q, k].astype(np.int64)
        open_ = np.concatenate(left)
        width *= 2


def _links(table: pa.Table, least: float) -> pa.Table:
    """Link counts (kind 0: id, count) and forest (kind 1: two ids) of one pair of shards."""
    row = {c: table[c][0].as_py() for c in table.column_names}
    b = _Shard(row["ids"], row["copies"], row["raw"], row["layers"])
    a = _Shard(row["q_ids"], row["q_copies"], row["q_raw"], None)
    same = row["a"] == row["b"]
    shift = 0 if same else len(b.ids)
    ids = b.ids if same else np.concatenate([b.ids, a.ids])
    copies = b.copies if same else np.concatenate([b.copies, a.copies])
    counts, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for q, x in _found(a.unit, b, least - SLACK):
        cosine = np.einsum("ed,ed->e", a.raw[q], b.raw[x]) / (a.norm[q] * b.norm[x])
        ok = cosine >= least
        if same:
            ok &= q != x
        q, x = q[ok], x[ok]
        np.add.at(counts, q + shift, b.copies[x])
        if not same:
            np.add.at(counts, x, a.copies[q])
        root = _united(root, q + shift, x)
    hung = np.flatnonzero(root != np.arange(len(ids)))
    linked = np.flatnonzero(counts)
    kinds = np.concatenate([np.zeros(len(linked), np.int32), np.ones(len(hung), np.int32)])
    return pa.table({"kind": kinds, "u": np.concatenate([ids[linked], ids[hung]]), "v": np.concatenate([counts[linked], ids[root[hung]]])})


def _united(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining each ``a`` with its ``b``: smaller roots spread until nothing changes."""
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if (low == high).all():
            return root
        root = root.copy()
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return root


def near_vectors(rows: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93, shard: int = SHARD) -> DataFrame:
    """(id, n_links, component_id) of every row."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    sound = v.isNotNull() & F.col(label).isNotNull() & F.col(vec_id).isNotNull() & F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    marked = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), v.alias("vector"), sound.alias("sound"))
    keys = [F.xxhash64(F.lit(i), "vector").alias(f"h{i}") for i in (1, 2)]
    keyed = marked.where("sound").select("id", "label", "vector", F.size("vector").alias("dim"), *keys)
    group = ["label", "dim", "h1", "h2"]
    classes = keyed.groupBy(*group).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    classes = settled(classes)
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("h1", "h2"), F.col("shards")).cast("int"))
    # A class is known by its smallest id; of rows that share an id the classes share a node.
    dealt = dealt.select("label", "dim", "shard", "shards", F.col("rep").alias("id"), "copies", "vector")
    kind = marked.schema["label"].dataType.simpleString()
    index = settled(
        dealt.groupBy("label", "dim", "shard").applyInArrow(
            lambda t: _index(t), f"label {kind}, dim int, shard int, shards int, ids binary, copies binary, raw binary, layers array<binary>"
        )
    )
    held = index.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("shard")))).withColumnRenamed("shard", "b")
    asked = index.withColumn("b", F.explode(F.sequence(F.col("shard"), F.col("shards") - 1))).select(
        "label", "dim", F.col("shard").alias("a"), "b", F.col("ids").alias("q_ids"), F.col("copies").alias("q_copies"), F.col("raw").alias("q_raw")
    )
    pair = ["label", "dim", "a", "b"]
    found = settled(
        held.drop("shards").join(asked, pair).groupBy(*pair).applyInArrow(lambda t: _links(t, least), "kind int, u bigint, v bigint")
    )
    counts = found.where("kind = 0").groupBy(F.col("u").alias("rep")).agg(F.sum("v").alias("links"))
    of = components(found.where("kind = 1"), "u", "v").withColumnRenamed("id", "rep")
    named = classes.drop("vector").join(counts, "rep", "left").join(of, "rep", "left")
    named = named.select(*group, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    linked = keyed.drop("vector").join(named, group).select("id", "n_links", F.col("component").alias("component_id"))
    alone = marked.where(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)
