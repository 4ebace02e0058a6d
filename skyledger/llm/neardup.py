"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is its set of word shingles. Equal sets are collapsed first (their digests are grouped, combined before the
shuffle). Each distinct set has ``HASHES`` MinHash values of 16 bits; tree t of ``TREES`` sorts all sets by the values
from ``t * STEP`` on, cyclically, ``DEPTH`` of them. In a sorted order the sets with the longest common prefix are
neighbours: each set is paired with the next ones that share at least ``SHALLOW`` values. Where few sets share such a prefix
all of them are paired; the more there are, the fewer next ones (``NEAR`` down to ``LEAST``), which in that order are those
that share most values: so depth adapts to each region, and a set has a bounded number of pairs however large its region. Orders are made by range partitions of
unique keys, so no region lands in one task; neighbours across partitions meet in small boundary groups.

Pairs are filtered by set sizes (exact) and by agreement of the sorted values (a pair at the threshold fails it less than
once in a million), and confirmed on full sets. First each set meets the smallest id of its group of candidates;
pairs inside the components so confirmed are settled, and the rest of the pairs are confirmed one by one. Then come the
regions of more than ``FULL`` sets, where neighbours were capped: every two sets of a region that lie in different components
are compared on their full sets, in tiles of at most ``TILE`` sets or ``VALUES`` shingles a side; a pair of several regions is
compared in the first. A tile returns links that join its components, not all pairs. So every pair that shares a prefix in some
tree is either inside a component or compared, dense region or not, and a pair of similarity 0.85 is missed only if it shares
none, with probability 7e-6. The comparisons of a region that does not hang together grow with the square of its sets.

Defined cases: null, empty and wordless texts have no shingles and link with nothing; a text of fewer words than a shingle is
one shingle; rows that share an id are one document; a null id is linked with nothing, its component is null and it is
kept; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import components
from skyledger.llm.shared import bitmap, released, settled, tidy, unused, within
from skyledger.llm.texts import SPACES, U, Words, blocks, mixed, rolling

HASHES, TREES, STEP, DEPTH = 64, 16, 4, 24
SHALLOW, AGREE = 4, 11
NEAR, LEAST, DENSE = 12, 2, 96
#: Regions of up to this many sets have all their pairs among the neighbours.
FULL = max(m for m in range(1, NEAR + 2) if min(DENSE // m, NEAR) >= m - 1)
TILE, VALUES = 512, 1 << 19
_DRAW = np.random.Generator(np.random.PCG64(99)).integers(1, 1 << 63, size=(2, HASHES), dtype=np.uint64)


def _shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block, and where each row's begin (rows + 1 edges)."""
    h = w.hashes()
    g = rolling(h, k)
    ok = w.whole(k)
    for n in range(1, k):  # a shorter text is one shingle
        at = w.first[w.counts == n]
        if len(at):
            g[at] = rolling(h, n)[at] ^ U(n)
            ok[at] = True
    n = np.where(w.counts >= k, w.counts - k + 1, np.minimum(w.counts, 1))
    return g[ok], np.concatenate([[0], np.cumsum(n)])


def _distinct(g: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    return [np.unique(g[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a byte matrix as a binary column."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def signatures(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(id, n, d1, d2, sig): distinct shingles, digest of the set, MinHash values."""

    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                g, edges = _shingles(Words(part.column("text"), SPACES, lower=True), k)
                rows = part.num_rows
                full = np.flatnonzero(np.diff(edges))
                sig = np.zeros((rows, HASHES), ">u2")
                n, d1, d2 = np.zeros(rows, np.int64), np.zeros(rows, U), np.zeros(rows, U)
                if len(full):
                    starts = edges[:-1][full]
                    for j in range(HASHES):
                        least = np.minimum.reduceat((g ^ _DRAW[0, j]) * (_DRAW[1, j] | U(1)), starts)
                        sig[full, j] = mixed(least) & U(0xFFFF)
                    sets = _distinct(g, edges)
                    n[:] = [len(s) for s in sets]
                    flat = np.concatenate(sets)
                    begin = (np.cumsum(n) - n)[full]
                    d1[full] = np.add.reduceat(mixed(flat), begin)
                    d2[full] = np.add.reduceat(mixed(flat ^ U(0x5851F42D4C957F2D)), begin)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), _binary(sig.view(np.uint8).reshape(rows, -1))],
                    ["id", "n", "d1", "d2", "sig"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(sign, "id bigint, n bigint, d1 bigint, d2 bigint, sig binary")


def _matrix(signatures: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Signatures as rows of their values."""
    return np.frombuffer(b"".join(signatures.to_pylist()), ">u2").reshape(len(signatures), HASHES).astype(np.uint16)


#: Columns of a sorted row: tree, key in its order, id, set size, component so far.
_ROW = {"tree": pa.int32(), "key": pa.binary(), "id": pa.int64(), "n": pa.int64(), "of": pa.int64()}
_ROW_DDL = "tree int, key binary, id bigint, n bigint, of bigint"


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A set's key in every tree."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = _matrix(batch.column("sig"))
        for t in range(TREES):
            key = np.roll(sig, -t * STEP, axis=1)[:, :DEPTH].astype(">u2").view(np.uint8).reshape(batch.num_rows, -1)
            rest = [batch.column(c) for c in ("id", "n", "of")]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, t, np.int32)), _binary(key), *rest], list(_ROW))


def _pairs(table: pa.Table, share: int) -> dict[str, np.ndarray]:
    """Pairs of a sorted run of trees: each row with the next ones that share its prefix and are of another component."""
    m = table.num_rows
    keys = np.frombuffer(b"".join(table["key"].to_pylist()), ">u2").reshape(m, DEPTH)
    tree, ids, n, of = (table[c].to_numpy() for c in ("tree", "id", "n", "of"))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    new = np.ones(m, bool)
    new[1:] = (tree[1:] != tree[:-1]) | (keys[1:, :SHALLOW] != keys[:-1, :SHALLOW]).any(axis=1)
    first = np.flatnonzero(new)
    reach = np.clip(DENSE // np.diff(np.append(first, m)), LEAST, NEAR)[np.cumsum(new) - 1]
    for j in range(1, min(NEAR, m - 1) + 1):
        same = np.flatnonzero((reach[:-j] >= j) & (tree[:-j] == tree[j:]) & (of[:-j] != of[j:]) & (keys[:-j, 0] == keys[j:, 0]))
        equal = keys[same] == keys[same + j]
        small, large = np.minimum(n[same], n[same + j]), np.maximum(n[same], n[same + j])
        same = same[equal[:, :SHALLOW].all(axis=1) & (equal.sum(axis=1) >= AGREE) & (100 * small >= share * large)]
        out.append((ids[same], ids[same + j]))
    a, b = (np.concatenate([x[i] for x in out]) if out else np.empty(0, np.int64) for i in (0, 1))
    return {"a": np.minimum(a, b), "b": np.maximum(a, b)}


def candidates(classes: DataFrame, share: int) -> DataFrame:
    """Distinct (a, b) of ``classes`` (id, n, sig, of) that neighbour in some tree and differ in ``of``."""
    count = classes.count() * TREES
    spread = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, count // 200_000, min(spread, count // 2_000))
    order = ["tree", "key", "id"]
    planted = classes.select("id", "n", "sig", "of").mapInArrow(_planted, _ROW_DDL)
    runs = planted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kind = f"a bigint, b bigint, edge int, {_ROW_DDL}"
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("edge", pa.int32()), *_ROW.items()])

    def shaped(rows: int, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[f.name], f.type) if isinstance(columns.get(f.name), np.ndarray) else columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in fields]
        return pa.RecordBatch.from_arrays(arrays, schema=fields)

    def edge(rows: pa.Table, at: int) -> Iterator[pa.RecordBatch]:
        for batch in rows.combine_chunks().to_batches():
            yield shaped(batch.num_rows, edge=np.full(batch.num_rows, at, np.int32), **{c: batch.column(c) for c in _ROW})

    @tidy
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tail, seen = TaskContext.get().partitionId(), None, set()
        head = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            if head is None or head.num_rows < NEAR:
                head = now.slice(0, NEAR) if head is None else pa.concat_tables([head, now]).slice(0, NEAR)
            run = now if tail is None else pa.concat_tables([tail, now])
            found = _pairs(run, share)
            # A pair met in one batch's tail may come again; the distinct below removes it.
            pairs = np.unique(np.stack([found["a"], found["b"]], axis=1), axis=0)
            yield shaped(len(pairs), a=np.ascontiguousarray(pairs[:, 0]), b=np.ascontiguousarray(pairs[:, 1]))
            tail = run.slice(max(0, run.num_rows - NEAR))
        if head is not None:
            yield from edge(head, at - 1)
            yield from edge(tail, at)

    def join_edge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("tree", "ascending"), ("key", "ascending"), ("id", "ascending")])
        return pa.table(_pairs(rows, share), schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    walked = settled(runs.mapInArrow(walk, kind))
    met = walked.where("edge IS NOT NULL").groupBy("edge").applyInArrow(lambda t: join_edge(t), "a bigint, b bigint")
    return walked.where("a IS NOT NULL").select("a", "b").unionByName(met).distinct()


def sets_of(docs: DataFrame, doc_id: str, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """(id, set) of the documents in ``wanted`` (id); a bitmap of fixed size spares most others."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "id"))

    @tidy
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False).view(U)
            batch = batch.filter(pa.array(within(shared.value, ids)))
            for part in blocks(batch, "text"):
                sets = _distinct(*_shingles(Words(part.column("text"), SPACES, lower=True), k))
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(ends), values)], ["id", "set"])

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(gather, "id bigint, set array<bigint>").join(wanted.select("id").distinct(), "id", "left_semi")


def confirmed(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs whose full sets have ``100 * intersection >= share * union``."""
    a, b = (sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}")) for c in ("a", "b"))
    inter = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", inter.alias("i"), (F.size("set_a") + F.size("set_b")).alias("s"))
    return both.where("100 * i >= %d * (s - i)" % share).select("a", "b")


def regions(classes: DataFrame) -> DataFrame:
    """(tree, region, id) of the sets that share a prefix with ``FULL`` others or more; prefixes of equal hash are one region."""

    @tidy
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("sig"))
            for t, places in enumerate(_places()):
                h = np.full(len(sig), t, U)
                for j in places:
                    h = mixed(h ^ (sig[:, j].astype(U) + U(1)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), t, np.int32)), pa.array(h.view(np.int64)), batch.column("id")], ["tree", "region", "id"])

    planted = classes.select("id", "sig").mapInArrow(plant, "tree int, region bigint, id bigint")
    full = settled(planted.groupBy("tree", "region").count().where(F.col("count") > FULL).select("tree", "region"))
    shared = classes.sparkSession.sparkContext.broadcast(bitmap(full, "region"))

    def spared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(within(shared.value, batch.column("region").to_numpy().view(U))))

    return planted.mapInArrow(spared, "tree int, region bigint, id bigint").join(full, ["tree", "region"], "left_semi")


def _places() -> np.ndarray:
    """Places of the prefix's values in a signature, for each tree."""
    return (np.arange(TREES)[:, None] * STEP + np.arange(SHALLOW)) % HASHES


def agreeing(values: int, share: int, miss: float = 1e-7) -> int:
    """So many of ``values`` MinHash values agree at least, but for a share ``miss`` of the pairs at the threshold."""
    p, below = share / 100, 0.0
    for n in range(values + 1):
        below += math.comb(values, n) * p**n * (1 - p) ** (values - n)
        if below > miss:
            return n
    return values


def _tile(table: pa.Table, share: int, agree: int) -> np.ndarray:
    """Links (a, b) that join the components of a tile's sets: rows of the lower side with rows of the upper one."""
    table = table.combine_chunks()
    ids, n, of, side, low, high = (table[c].to_numpy() for c in ("id", "n", "of", "side", "low", "high"))
    sig, places = _matrix(table["sig"]), _places()
    sets = table["set"].combine_chunks()
    _, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    edges = np.append(0, np.cumsum(n))
    _, label = np.unique(of, return_inverse=True)
    held = np.zeros(flat.max(initial=0) + 1, bool)
    left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
    home = table["tree"][0].as_py()
    out = []
    for x in left:
        y = right[(label[right] != label[x]) & (100 * np.minimum(n[right], n[x]) >= share * np.maximum(n[right], n[x]))]
        if low[0] == high[0]:
            y = y[y > x]
        same = sig[y] == sig[x]
        prefix = same[:, places].all(axis=2)
        # Compared in the first region that both are in.
        y = y[(same.sum(axis=1) >= agree) & prefix[:, home] & ~prefix[:, :home].any(axis=1)]
        if not len(y):
            continue
        held[flat[edges[x] : edges[x + 1]]] = True
        size = n[y]
        starts = np.cumsum(size) - size
        both = np.add.reduceat(held[flat[np.repeat(edges[y] - starts, size) + np.arange(size.sum())]], starts, dtype=np.int64)
        held[flat[edges[x] : edges[x + 1]]] = False
        y = y[100 * both >= share * (size + n[x] - both)]
        if len(y):
            met, one = np.unique(label[y], return_index=True)
            out.append(np.stack([np.full(len(one), ids[x]), ids[y[one]]], axis=1))
            label[np.isin(label, met)] = label[x]
    pairs = np.concatenate(out) if out else np.empty((0, 2), np.int64)
    return np.sort(pairs, axis=1)


def joining(dense: DataFrame, classes: DataFrame, of: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Links (a, b) between the components ``of`` (id, component) of the sets in ``dense`` (tree, region, id); all that matter."""
    named = classes.join(of, "id", "left").select("id", "n", F.coalesce("component", "id").alias("of"))
    rows = settled(dense.join(named, "id"))
    sums = rows.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("v"), F.min("of").alias("low"), F.max("of").alias("high"))
    blocks = F.ceil(F.greatest(F.col("m") / TILE, F.col("v") / VALUES)).cast("int").alias("blocks")
    split = sums.where("low <> high").select("tree", "region", blocks)
    sided = rows.join(split, ["tree", "region"]).withColumn("side", F.pmod(F.xxhash64("tree", "id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = sided.select("tree", "region", "id", "n", "of", "side", other).withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
    full = placed.drop("other").join(sets.join(classes.select("id", "sig"), "id"), "id")
    agree, kind = agreeing(HASHES, share), pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def tile(table: pa.Table) -> pa.Table:
        pairs = _tile(table, share, agree)
        return pa.table([np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])], schema=kind)

    return full.groupBy("tree", "region", "low", "high").applyInArrow(lambda t: tile(t), "a bigint, b bigint").distinct()


def components_of(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 5, share: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``: sets of ``k``-word shingles, similarity ``share`` percent or more."""
    signed = settled(signatures(docs, doc_id, text, k))
    members = signed.where("n > 0 AND id IS NOT NULL")
    classes = settled(members.groupBy("d1", "d2", "n").agg(F.min("id").alias("id"), F.first("sig").alias("sig")))
    pairs = settled(candidates(classes.withColumn("of", F.col("id")), share))
    groups = components(pairs)
    dense = settled(regions(classes))
    wanted = settled(groups.select("id").unionByName(dense.select("id")).distinct())
    sets = settled(sets_of(docs, doc_id, text, k, wanted))
    stars = groups.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
    links = settled(confirmed(stars, sets, share))
    of = settled(components(links))
    side = lambda c: of.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
    open_pairs = (
        pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    )
    late = settled(confirmed(open_pairs, sets, share))
    if not late.isEmpty():
        links = settled(links.unionByName(late))
        of = settled(components(links))
    released(docs.sparkSession)
    if not dense.isEmpty():
        joins = settled(joining(dense, classes, of, sets, share))
        if not joins.isEmpty():
            of = settled(components(links.unionByName(joins)))
    released(docs.sparkSession)
    named = classes.join(of, "id", "left").select("d1", "d2", "n", F.coalesce("component", "id").alias("component"))
    return signed.join(named, ["d1", "d2", "n"], "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")
    )


def deduplicated(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group: the rows whose id is their component's, all columns kept; of rows that share an id, one."""
    found = components_of(docs, doc_id=doc_id, **options)
    gone = settled(found.where("id IS NOT NULL AND component_id <> id").select("id").distinct())
    mark = unused(docs, "_id")
    kept = docs.withColumn(mark, F.col(doc_id).cast("long")).join(gone.withColumnRenamed("id", mark), mark, "left_anti")
    repeated = docs.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1")
    if not repeated.isEmpty():  # only then are texts shuffled by id
        kept = kept.where(F.col(mark).isNull()).unionByName(kept.where(F.col(mark).isNotNull()).dropDuplicates([mark]))
    return kept.select(*docs.columns)
