import hashlib
import random
import re

import edges
import pytest

from skyledger.llm import decontaminate, neardup, substrings
from skyledger.llm.components import components

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(text, k):
    w = SPACE.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def linked(rows, k, share):
    """Smallest id reachable, by comparing all pairs; rows that share an id are one document."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if a and b and 100 * len(a & b) >= share * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


def near_copies(n, groups, seed):
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = edges.words(r.randrange(20, 150), seed * 1000 + g, 3000).split()
        for _ in range(r.choice([1, 1, 2, 5, n])):
            w = list(base)
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(len(w))] = f"new{r.randrange(999)}"
            out.append(" ".join(w))
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("k, share", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, share):
    rows = near_copies(40, 40, k)
    got = neardup.components_of(spark.createDataFrame(rows, "doc_id long, text string"), k=k, share=share).collect()
    want = linked(rows, k, share)
    assert {r.id: r.component_id for r in got} == want
    assert {r.id: r.n_shingles for r in got} == {i: len(shingles(t, k)) for i, t in rows}


def test_near_duplicate_edges(spark):
    docs = edges.documents(spark)
    got = neardup.components_of(docs, k=3, share=85).collect()
    want = linked([(r.doc_id, r.text) for r in docs.collect()], 3, 85)
    assert len(got) == docs.count()
    for r in got:
        assert r.component_id == (want[r.id] if r.id is not None else None)
    kept = neardup.deduplicated(docs, k=3, share=85)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(13) == 1 and 2 not in ids and {4, 5, 6, 7, 8, 9} <= set(ids) and ids.count(None) == 2
    empty = edges.no_documents(spark)
    assert neardup.components_of(empty).count() == 0 and neardup.deduplicated(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 1150), (7, 7), (None, 3), (3, None)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}, 5000: 1000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def removal(rows, window):
    """(n_words, n_removed, kept) of every row, by looking at all windows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first = {}
    texts = [SPACE.findall(t or "") for _, t in rows]
    for i in order:
        for s in range(len(texts[i]) - window + 1):
            key, at = tuple(texts[i][s : s + window]), ((rows[i][0] is None, rows[i][0] or 0), s)
            first[key] = min(first.get(key, at), at)
    out = []
    for (doc, _), w in zip(rows, texts):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < ((doc is None, doc or 0), s):
                gone |= set(range(s, s + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:])))


@pytest.mark.parametrize("window", [20, 7, 3, 1])
def test_substrings_equal_brute_force(spark, window):
    r = random.Random(window)
    passages = [edges.words(r.randrange(10, 70), 8000 + i) for i in range(6)]
    rows = []
    for i in range(80):
        parts = [edges.words(r.randrange(0, 40), i * 1000 + j, 3000) for j in range(3)]
        rows.append((r.randrange(500), ("  " if i % 3 else "\n").join([parts[0], r.choice(passages), parts[1], r.choice(passages), parts[2]])))
    rows = list({i: (i, t) for i, t in rows}.values())
    got = substrings.removed(spark.createDataFrame(rows, "doc_id long, text string"), window=window).collect()
    assert ordered(map(tuple, got)) == ordered(removal(rows, window))


def test_substring_edges(spark):
    docs = edges.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ordered(map(tuple, substrings.removed(docs).collect()))
    want = ordered(removal(rows, 20))
    assert got == want
    hashed = ordered(map(tuple, substrings.removed(docs, digest=True).collect()))
    assert sorted(r[3] for r in hashed) == sorted(hashlib.sha256(r[3].encode()).hexdigest() for r in want)
    assert substrings.removed(edges.no_documents(spark)).count() == 0


def contamination(docs, items):
    """n_words, n_hit, items by trying every window at every place."""
    windows = []
    for item, t in items:
        w = ALNUM.findall(lower(t))
        n = min(13, len(w))
        windows += [(item, w[i : i + n]) for i in range(len(w) - n + 1)] if w else []
    out = []
    for doc, t in docs:
        w = ALNUM.findall(lower(t))
        hit, named = set(), set()
        for item, x in windows:
            for s in range(len(w) - len(x) + 1):
                if w[s : s + len(x)] == x:
                    hit |= set(range(s, s + len(x)))
                    if item is not None:
                        named.add(str(item))
        out.append((doc, len(w), len(hit), sorted(named), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def test_contamination_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in edges.documents(spark).collect() if r.doc_id != 9]
    items = [(1, edges.PASSAGE), (2, edges.PASSAGE[: len(edges.PASSAGE) // 2]), (3, "Two, Words!"), (4, "one"), (5, None), (6, "..."), (7, edges.words(30, 77)), (None, "two"), (8, "ab ab ab")]
    got = decontaminate.report(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), "doc_id"
    ).collect()
    assert ordered(map(tuple, got)) == ordered(contamination(docs, items))


def test_contaminated_documents_go(spark):
    docs = edges.documents(spark)
    items = spark.createDataFrame([(1, edges.PASSAGE, 5)], "item_id long, text string, row int")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {10, 11, 15}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none).count() == docs.count()
    assert decontaminate.decontaminate(edges.no_documents(spark), items).count() == 0
    assert decontaminate.report(edges.no_documents(spark), items, "doc_id").count() == 0


def test_sole_link_of_two_dense_clusters(spark):
    """Only the two originals are similar enough; the nearest neighbours of either are its own copies."""
    r = random.Random(5)
    first = [f"a{i}" for i in range(198)]
    originals = [first, [*first[:176], *(f"b{i}" for i in range(22))]]
    rows = [(500 + n, " ".join(w)) for n, w in enumerate(originals)]
    for n in range(240):
        w = list(originals[n % 2])
        w[r.randrange(170)] = f"new{n}"
        rows.append((n, " ".join(w)))
    want = linked(rows, 1, 80)
    assert len(set(want.values())) == 1 and len(set(linked(rows[1:], 1, 80).values())) == 2
    got = neardup.components_of(spark.createDataFrame(rows, "doc_id long, text string"), k=1, share=80).collect()
    assert {r.id: r.component_id for r in got} == want


def test_texts_that_share_an_id_all_lose_a_passage(spark):
    """The earlier occurrence lies in another task than the texts, which tie among themselves."""
    passage = edges.words(25, 77)
    rows = [(1, f"x {passage}"), *((i, f"{passage} {n}{i}") for i in (None, 7) for n in "abc")]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows[:1], 1), "doc_id long, text string").unionByName(
        spark.createDataFrame(spark.sparkContext.parallelize(rows[1:], 1), "doc_id long, text string")
    )
    got = sorted(r.n_removed for r in substrings.removed(docs).collect())
    assert got == [0, 25, 25, 25, 25, 25, 25]


def test_malformed_texts(spark):
    passage = b" ".join(b"w%d" % i for i in range(25)) + b" \xff\xfe end"
    docs = spark.createDataFrame([(1, b"one " + passage), (2, passage + b" \xc3"), (3, b"\xe4")], "doc_id long, b binary").selectExpr("doc_id", "cast(b as string) AS text")
    got = {r.doc_id: (r.n_removed, bytes(r.k)) for r in substrings.removed(docs).selectExpr("doc_id", "n_removed", "cast(kept AS binary) AS k").collect()}
    assert got == {1: (0, b"one " + passage), 2: (27, b"\xc3"), 3: (0, b"\xe4")}
    items = docs.where("doc_id = 1").selectExpr("doc_id AS item_id", "text")
    hits = {r.doc_id: r.n_hit for r in decontaminate.report(docs, items, "doc_id").collect()}
    assert hits == {1: 28, 2: 27, 3: 0}
    assert neardup.components_of(docs, k=3, share=85).count() == 3
