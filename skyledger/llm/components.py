"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shared import released, settled

#: Links that a task of a round reads; rounds of few links have few tasks, whatever the number of shuffle partitions.
LINKS = 50_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``id``, ``component``) of every node of ``links``; the component is its smallest node.

    Each round joins the links with one minimum per node (combined before the shuffle, so a node with a third
    of all links costs one row per task; the join's hot side is split by adaptive execution). Rounds grow with the
    logarithm of the longest chain. Links with a null end are ignored. The lineage is cut every round, and what is kept of it lies in
    as many partitions as its rows need: the driver remembers every task of a session, and rounds are many.
    """
    edges = settled(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    seen, rows = None, edges.count()
    while True:
        edges = settled(_small(_large(edges.coalesce(_parts(rows)))).distinct().coalesce(_parts(rows)))
        released(edges.sparkSession)
        # Settled once every node hangs on a root: then no node is both a child and a parent.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        seen, rows = now, now[0]


def _parts(rows: int) -> int:
    """Partitions of about ``LINKS`` rows each; a round at most doubles its links."""
    return 1 + 2 * rows // LINKS


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are hung on the smallest of these neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))
