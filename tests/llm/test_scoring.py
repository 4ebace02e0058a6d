import collections
import math
import random
import re
import zlib

import edges
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import lm, mixing, resharding, vectors
from skyledger.llm.graph import Graph

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return [*SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None]


def base(rows, train):
    counts = collections.Counter(x for t in train for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = tokens(t)
        out.append((i, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2])


@pytest.mark.parametrize("hot", [1 << 19, 50])
def test_counts_and_base(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT", hot)  # the rare words' join gives what the broadcast counts give
    rows = [(i, edges.words(60, i, 200 + i)) for i in range(40)] + [(r.doc_id, r.text) for r in edges.documents(spark).collect() if r.doc_id != 9]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learn = [t for i, t in rows if i is None or i % 3]
    got = lm.scored(docs, docs.where("doc_id IS NULL OR doc_id % 3 <> 0")).collect()
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(base(rows, learn), key=key)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9) and g[5] < 0


def test_probabilities_sum_to_one():
    counts = np.random.default_rng(0).integers(0, 50, lm.OUTPUTS).astype(float)
    scorer = lm.Scorer.of(lm.first_parameters(counts).astype(float))
    for one, two in ((0, 0), (5, 200), (lm.CONTEXTS - 1, lm.CONTEXTS - 1)):
        every = np.arange(lm.OUTPUTS)
        p = np.exp(scorer.log_probability(every, np.full(lm.OUTPUTS, one), np.full(lm.OUTPUTS, two)))
        assert p.sum() == pytest.approx(1, abs=1e-5)


def test_learns_what_follows(spark):
    r = random.Random(1)
    rows = [(i, " ".join(x for _ in range(150) for x in r.choice(["red apple", "blue sky", "green tree", "old house"]).split())) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.scored(docs, docs.where("doc_id % 4 <> 0")).where("doc_id % 4 = 0").collect()
    assert all(g.score > 0.97 * g.base_score for g in got)


def test_scores_of_edges(spark):
    docs = edges.documents(spark)
    got = lm.scored(docs, docs).collect()
    assert len(got) == docs.count() and all(g.n_tokens == g.n_known for g in got)
    assert {g.n_tokens for g in got if g.doc_id in (4, 5, 6)} == {1}
    empty = edges.no_documents(spark)
    assert lm.scored(empty, docs).count() == 0
    alone = lm.scored(docs, empty).collect()
    assert all(g.train_tokens == 0 and g.base_score == 0 and g.n_known == 0 for g in alone)


def filled(sizes, weights=(5, 2, 1), epochs=3):
    """Targets by sharing the excess again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(epochs * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        target = {s: epochs * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in open_) for s in order}
        new = {s for s in open_ if target[s] > epochs * sizes[s]}
        if not new:
            return target
        capped |= new


def test_mix(spark):
    r = random.Random(4)
    rows = [(i, edges.words(r.choice([0, 3, 30, 200]), i), r.choice(["a", "a", "a", "b", "é", "Z", "tiny", None] if i > 5 else ["tiny"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).select("doc_id", "source", "mix.*").collect()
    sizes = collections.Counter()
    for i, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = filled(sizes), collections.Counter()
    for g in got:
        assert g.source_size == sizes[g.source] and g.target == pytest.approx(want[g.source])
        assert 0 <= g.times <= 3
        taken[g.source] += g.times * g["size"]
    assert all(abs(taken[s] - want[s]) <= max(60, 0.02 * want[s]) for s in sizes)
    again = mixing.mix(docs.repartition(5)).select("doc_id", "source", "mix.*").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mixed(docs).count() == sum(g.times for g in got)


def test_heavier_documents_come_first(spark):
    rows = [(i, ("word " if i % 2 else "12# ") * 10, "s" if i < 2000 else "t") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).where("source = 't'").selectExpr("doc_id % 2 AS good", "mix.times AS times").collect()
    share = [np.mean([g.times for g in got if g.good == k]) for k in (0, 1)]
    assert share[1] > 1.3 * share[0]


def test_mix_edges(spark):
    docs = edges.documents(spark)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and got.count() > 0
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.mix(edges.no_documents(spark)).count() == 0 and mixing.mixed(edges.no_documents(spark)).count() == 0
    silent = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.mix.target for r in mixing.mix(silent).collect()] == [0.0, 0.0]


def cheapest(supply, capacity):
    """Fewest moved bytes: what exceeds its own shard's capacity has to move."""
    return sum(max(0, s - (capacity[i] if i < len(capacity) else 0)) for i, s in enumerate(supply))


def test_flow_moves_the_fewest_bytes():
    r = random.Random(2)
    for _ in range(200):
        supply = [r.randrange(0, 500) for _ in range(r.randrange(1, 9))]
        capacity = resharding.even_capacities(sum(supply), r.randrange(1, 9))
        flow = resharding.min_cost_flow(supply, capacity)
        for i, s in enumerate(supply):
            assert sum(f for (a, _), f in flow.items() if a == i) == s
        for j, c in enumerate(capacity):
            assert sum(f for (_, b), f in flow.items() if b == j) <= c
        assert sum(f for (a, b), f in flow.items() if a != b) == cheapest(supply, capacity)


def test_shards(spark):
    rows = [(i, edges.words(5 + i % 60, i)) for i in range(1500)] + [(5000 + i, "the same text again") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = resharding.reshard(docs)
    got = resharding.slotted(placed).collect()
    assert sorted(r.id for r in got) == sorted(i for i, _ in rows)
    sizes = collections.Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 8
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    old = collections.Counter()
    for r in got:
        old[r.old] += r["size"]
    moved = sum(r["size"] for r in got if r.old != r.shard)
    need = cheapest([old[i] for i in range(6)], resharding.even_capacities(sum(old.values()), 8))
    assert moved <= 1.02 * need + 2000


def shards_of(spark, path):
    return {(r.doc_id, r.shard) for r in spark.read.parquet(path).select("doc_id", "shard").collect()}


def test_rewrite_touches_only_affected_shards(spark, tmp_path):
    rows = [(i, edges.words(20, i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "shards")
    placed = resharding.reshard(docs, shards=8, old=6)
    assert resharding.rewrite(placed, path) == list(range(8))
    want = {(r.doc_id, r.shard) for r in placed.select("doc_id", "placed.shard").collect()}
    assert shards_of(spark, path) == want
    staying = placed.withColumn("placed", F.col("placed").withField("old", F.col("placed.shard")))
    kept = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "shards").rglob("*.parquet")}
    assert resharding.rewrite(staying, path) == []
    swapped = F.when(F.col("doc_id") == rows[0][0], (F.col("placed.shard") + 1) % 8).otherwise(F.col("placed.shard"))
    (moved,) = [s for i, s in want if i == rows[0][0]]
    assert resharding.rewrite(staying.withColumn("placed", F.col("placed").withField("shard", swapped)), path) == sorted({moved, (moved + 1) % 8})
    assert shards_of(spark, path) == {(i, (s + 1) % 8 if i == rows[0][0] else s) for i, s in want}
    same = {p.name for p in (tmp_path / "shards").rglob("*.parquet") if kept.get(p.name) == p.stat().st_mtime_ns}
    assert len(same) >= len(kept) * 5 // 8


def test_shards_that_empty_are_removed(spark, tmp_path):
    docs = spark.createDataFrame([(i, edges.words(20, i)) for i in range(400)], "doc_id long, text string")
    path = str(tmp_path / "shards")
    resharding.rewrite(resharding.reshard(docs, shards=8, old=6), path)
    resharding.rewrite(resharding.reshard(docs, shards=6, old=8), path)
    got = shards_of(spark, path)
    assert len(got) == 400 and {s for _, s in got} == set(range(6))
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()} == {f"shard={k}" for k in range(6)}


@pytest.mark.parametrize("same", [None, 7])
def test_copies_with_one_id_are_spread(spark, same):
    rows = [(same, "copied text")] * 900 + [(i, edges.words(2, i)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resharding.slotted(resharding.reshard(docs)).collect()
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert r.crc == zlib.crc32(b"copied text") or r.id is not None and r.id < 100
    assert len(got) == 1000 and max(sizes.values()) - min(sizes.values()) <= 40 and len(sizes) == 8
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_checksums(spark):
    docs = edges.documents(spark).select("doc_id", "text")
    for r in resharding.reshard(docs).collect():
        body = (r.text or "").encode()
        assert (r.placed.crc, r.placed["size"]) == (zlib.crc32(body), len(body) + 1)


def test_shard_edges(spark):
    docs = edges.documents(spark)
    got = resharding.slotted(resharding.reshard(docs)).collect()
    assert len(got) == docs.count() and {r["size"] for r in got if r.id == 4} == {1}
    assert resharding.slotted(resharding.reshard(edges.no_documents(spark))).count() == 0


def links(rows, least):
    parent = {i: i for i, *_ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = collections.Counter()
    good = [(i, np.array(e, float), lab) for i, e, lab in rows if i is not None and e and lab is not None and None not in e and np.isfinite(np.array(e, float)).all() and any(e)]
    for k, (i, a, p) in enumerate(good):
        for j, b, q in good[k + 1 :]:
            if p == q and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                n[i] += 1
                n[j] += 1
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (n[i], root(i)) for i in parent}


@pytest.mark.parametrize("shard", [8192, 150])
def test_vectors_equal_brute_force(spark, shard):
    rng = np.random.default_rng(6)
    rows = []
    for label in (1, 2):
        centres = rng.normal(size=(40, 16))
        for c in centres:
            for _ in range(rng.choice([1, 2, 30])):
                rows.append((len(rows), (c + rng.normal(0, rng.choice([0.02, 0.25]), 16)).tolist(), label))
    same = rng.normal(size=16).tolist()
    rows += [(len(rows) + i, same, 1) for i in range(60)]
    odd = [[0.0] * 16, None, [], [float("nan")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [float("inf")] * 16]
    rows += [(9000 + i, e, 1) for i, e in enumerate(odd)] + [(9100, same, None), (None, same, 1)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), shard=shard).collect()
    want = links(rows, 0.93)
    assert {r.id: (r.n_links, r.component_id) for r in got if r.id is not None} == want
    assert [(r.n_links, r.component_id) for r in got if r.id is None] == [(0, None)]


def test_very_large_and_small_parts(spark):
    rows = [(1, [1e300, 1e300], 1), (2, [1e-300, 1e-300], 1), (3, [1.0, -1.0], 1)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.id: (r.n_links, r.component_id) for r in got} == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, _ = Graph(x).search(x[:200], 64)
    exact = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids, exact)]) >= 0.9


def test_tokens_keep_rows_apart():
    h, group, at = lm.tokens(pa.array(["a b", None, "", "B a"]))
    assert at.tolist() == [0, 3, 4, 5, 8] and h[0] == h[6] and h[1] == h[5] and set(h[[2, 3, 4, 7]]) == {lm.END}
