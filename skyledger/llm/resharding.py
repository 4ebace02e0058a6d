"""Resharding by minimum-cost flow: old shard sizes and new capacities decide how many bytes go from where to where.

Rows are grouped in blocks of equal texts, which move as one; a group larger than ``1 / SPLIT`` of a shard is cut into
blocks of about that size by the rows' numbers within it, so that one text in a third of all rows cannot fill a shard. The old layout deals blocks to
``old`` shards by a hash. The flow network has one node per old and new shard: staying costs nothing, a moved byte costs
one, so the optimal flow moves the fewest bytes that the capacities allow; it is solved on the driver and is as large as
the two shard counts, whatever the rows. Blocks of an old shard are lined up by falling size (a distributed sort
with running sums per partition) and the flow cuts the line: the first and largest stay, the cuts fall among small blocks.

Only shards that gain or lose rows are written again by ``rewrite``, beside the old files, and shards that empty are removed.

Defined cases: a null text has size 1, checksum 0, and is equal to other nulls but not to the empty text; null or repeated
ids are rows like others; an empty table has no rows to place; extra columns pass through.
"""

from __future__ import annotations

import heapq
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skyledger.llm.shared import buckets_for, ranked, settled, unused

SHARDS = 8
OLD_SHARDS = 6
SPLIT = 256


def min_cost_flow(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard, moving the fewest: successive shortest paths with potentials.

    ``sum(capacity)`` must be at least ``sum(supply)``; shard i staying shard i is free, any other arc costs 1 a byte.
    """
    m, n = len(supply), len(capacity)
    source, sink = m + n, m + n + 1
    arcs: list[list[int]] = []  # to, left, cost; arc k's reverse is k ^ 1
    out: list[list[int]] = [[] for _ in range(m + n + 2)]

    def arc(a: int, b: int, room: int, cost: int) -> None:
        for x, y, left, c in ((a, b, room, cost), (b, a, 0, -cost)):
            out[x].append(len(arcs))
            arcs.append([y, left, c])

    for i, s in enumerate(supply):
        arc(source, i, s, 0)
        for j in range(n):
            arc(i, m + j, s, int(i != j))
    for j, c in enumerate(capacity):
        arc(m + j, sink, c, 0)
    potential = [0] * (m + n + 2)
    while True:
        far, via, heap = {source: 0}, {}, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k in out[a]:
                b, left, cost = arcs[k]
                reach = d + cost + potential[a] - potential[b]
                if left and reach < far.get(b, 1 << 62):
                    far[b], via[b] = reach, k
                    heapq.heappush(heap, (reach, b))
        if sink not in far:
            break
        potential = [p + far.get(v, max(far.values())) for v, p in enumerate(potential)]
        path, v = [], sink
        while v != source:
            path.append(via[v])
            v = arcs[via[v] ^ 1][0]
        push = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push
    flow: dict[tuple[int, int], int] = defaultdict(int)
    for i in range(m):
        for k in out[i]:
            if k % 2 == 0 and m <= arcs[k][0] < m + n and arcs[k ^ 1][1]:
                flow[i, arcs[k][0] - m] += arcs[k ^ 1][1]
    return dict(flow)


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def _sized(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with struct ``name``: size, checksum and a 64-bit hash of the group of equal texts."""
    empty = F.coalesce(F.col(text), F.lit(""))
    group = F.xxhash64(F.lit("group"), F.col(text), F.col(text).isNull())
    return docs.withColumn(
        name, F.struct((F.octet_length(empty) + 1).cast("long").alias("size"), F.crc32(empty.cast("binary")).alias("crc"), group.alias("group"))
    )


def _pick(values: list[tuple[object, object]], otherwise):
    """CASE over at most a few hundred conditions made on the driver."""
    chosen = None
    for condition, value in values:
        chosen = F.when(condition, F.lit(value)) if chosen is None else chosen.when(condition, F.lit(value))
    return otherwise if chosen is None else chosen.otherwise(otherwise)


def plan_blocks(rows: DataFrame, shards: int, old: int) -> tuple[DataFrame, DataFrame]:
    """(group, part, bytes, old, shard) of every block of ``rows`` (group, size), and (group, per) of the groups that are split.

    The rows of a group are alike, so a split group's parts are ``per`` rows each, whichever these are.
    """
    groups = settled(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")))
    total = groups.agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0
    limit = max(1, total // (shards * SPLIT))
    per = F.greatest(F.lit(1), F.expr(f"{limit}L div size"))
    # At most total / limit groups are that large, so this table has at most shards * SPLIT rows, all told.
    large = groups.where((F.col("n") * F.col("size") > 2 * limit) & (F.col("n") > 1)).select("group", per.alias("per"))
    cut = groups.join(F.broadcast(large), "group", "left").withColumn("per", F.coalesce("per", "n"))
    parts = cut.withColumn("part", F.explode(F.sequence(F.lit(0), F.expr("cast((n - 1) div per as int)"))))
    blocks = parts.select("group", "part", (F.least("per", F.col("n") - F.col("part") * F.col("per")) * F.col("size")).alias("bytes"))
    blocks = blocks.withColumn("old", F.pmod(F.xxhash64("group"), F.lit(old)).cast("int"))
    order = ["old", F.desc("bytes"), "group", "part"]
    lined = settled(blocks.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.spark_partition_id()))
    sums = lined.groupBy("old", "at").agg(F.sum("bytes").alias("bytes")).collect()  # per-partition bookkeeping
    supply = [sum(r.bytes for r in sums if r.old == i) for i in range(old)]
    flow = min_cost_flow(supply, even_capacities(total, shards))
    before, seen = [], defaultdict(int)
    for r in sorted(sums, key=lambda r: (r.old, r["at"])):
        before.append((r.old, r["at"], seen[r.old]))
        seen[r.old] += r.bytes
    offsets = lined.sparkSession.createDataFrame(before or [(0, 0, 0)], "_old int, _at int, before long")
    running = F.sum("bytes").over(W.partitionBy("old", "at").orderBy(F.desc("bytes"), "group", "part").rowsBetween(W.unboundedPreceding, 0))
    middle = F.col("before") + F.col("run") - F.col("bytes") / 2
    cuts, last = [], {}
    for i in range(old):
        end = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != i, -flow[i, j], j)):
            end += flow[i, j]
            cuts.append(((F.col("old") == i) & (F.col("middle") <= end), j))
            last[i] = j
    placed = (
        lined.withColumn("run", running)
        .join(F.broadcast(offsets), (F.col("old") == F.col("_old")) & (F.col("at") == F.col("_at")))
        .withColumn("middle", middle)
        .withColumn("shard", _pick([*cuts, *[(F.col("old") == i, j) for i, j in last.items()]], F.lit(0)).cast("int"))
    )
    return placed.select("group", "part", "bytes", "old", "shard"), large


def reshard(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, shards: int = SHARDS, old: int = OLD_SHARDS, out: str = "placed") -> DataFrame:
    """``docs`` (or its columns ``keep``) with struct ``out``: row, size, crc, old and shard.

    Sizes of shards are equal to within about a small block; ``row`` is a number of its own for each row. What is kept of the rows is
    written once, so that their numbers last.
    """
    kept = docs.columns if keep is None else keep
    own, group, size = (unused(docs, f"_{c}") for c in ("own", "group", "size"))
    base = _sized(docs, text, own).select(*kept, own, F.monotonically_increasing_id().alias(group))
    base = settled(base.select(*kept, F.struct(F.col(group).alias("row"), f"{own}.*").alias(own)))
    blocks, large = plan_blocks(base.select(f"{own}.group", f"{own}.size"), shards, old)
    blocks, large = settled(blocks), F.broadcast(settled(large))
    split = base.select(*kept, own, F.col(f"{own}.group").alias(group)).join(large.select(F.col("group").alias(group), F.col("per").alias(size)), group, "left")
    part = unused(docs, "_part")
    whole = split.where(F.col(size).isNull()).withColumn(part, F.lit(0))
    cut = split.where(F.col(size).isNotNull())
    rows = cut.count()
    if rows:
        # Rows are numbered within their group, though it be a third of all; ``per`` of them make a part.
        cut = ranked(cut, [group], F.xxhash64(F.lit("part"), F.col(f"{own}.row")), part, buckets_for(rows))
        whole = whole.unionByName(cut.withColumn(part, F.expr(f"cast(`{part}` div `{size}` as int)")))
    side = blocks.select(F.col("group").alias(group), F.col("part").alias(part), F.struct("old", "shard").alias(size))
    joined = whole.drop(size).join(side, [group, part])
    return joined.select(*kept, F.struct(f"{own}.row", f"{own}.size", f"{own}.crc", f"{size}.old", f"{size}.shard").alias(out))


def slotted(placed: DataFrame, *, doc_id: str = "doc_id", out: str = "placed") -> DataFrame:
    """(id, row, size, crc, old, shard, slot): slots of a shard are gapless from 0 in order of a hash."""
    rows = settled(placed.select(F.col(doc_id).alias("id"), f"{out}.*"))
    return ranked(rows, ["shard"], F.xxhash64(F.lit("slot"), F.col("id"), F.col("crc"), F.col("row")), "slot", buckets_for(rows.count()))


def rewrite(placed: DataFrame, path: str, *, out: str = "placed", shard: str = "shard") -> list[int]:
    """Bring the files below ``path`` (``shard=N`` folders) to the plan that ``reshard`` made, and return the shards written.

    A shard is written again if it gains or loses rows, or has no folder yet; the others stay untouched. All of them are
    written beside the old ones first, in one job, and only then change places with them; a shard that has lost all its rows goes. If
    the job fails nothing has changed.
    """
    spark = placed.sparkSession
    moves = placed.groupBy(f"{out}.old", f"{out}.shard").count().collect()  # old x new rows at most
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def folder(*names: str):
        return spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))

    full = {r["shard"] for r in moves}
    there = {s.getPath().getName() for s in fs.listStatus(folder())} if fs.exists(folder()) else set()
    there = {int(n.split("=")[1]) for n in there if n.startswith(f"{shard}=")}
    affected = {x for r in moves if r.old != r["shard"] for x in (r.old, r["shard"])} | (full - there) | (there - full)
    draft = f"_next-{uuid.uuid4().hex[:12]}"
    rows = placed.withColumn(shard, F.col(f"{out}.shard")).where(F.col(shard).isin(sorted(affected)))
    # The rebalance splits a shard over as many tasks as its bytes ask for.
    rows.drop(out).hint("rebalance", shard).write.partitionBy(shard).parquet(str(folder(draft)))
    for n in sorted(affected):
        name = f"{shard}={n}"
        fs.delete(folder(name), True)
        if n in full:
            fs.rename(folder(draft, name), folder(name))
    fs.delete(folder(draft), True)
    return sorted(affected & full)
