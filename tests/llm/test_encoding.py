"""Pieces, periodic runs and importance resampling against the library, brute force and plain arithmetic."""

import itertools
import math
import random
import zlib
from collections import Counter

import edges
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skyledger.llm import pieces, resample, runs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["▁", " ", "a", "the", "\n", "\t", "é", "梦", "𝄞", "\0", "<s>", "</s>", "<0x0A>", "日本", "   ", "ing", "ß", "0", "...", "▁▁", "​"]
MALFORMED = b"good words \xff\xfe \xe4\xb8 tail \xc3"


def binary(spark, bodies):
    """Texts of any bytes, as strings."""
    rows = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, body binary")
    return rows.select("doc_id", F.col("body").cast("string").alias("text"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def lists(got):
    flat, cuts = got
    return [flat[a:b].tolist() for a, b in itertools.pairwise(cuts)]


def test_ids_are_the_librarys(library):
    r = random.Random(3)
    texts = ["".join(r.choice(ODD) for _ in range(r.randrange(150))).encode() for _ in range(400)]
    texts += [bytes(r.randrange(256) for _ in range(r.randrange(50))) for _ in range(400)]
    texts += [b"", b" ", b"  ", "▁".encode(), b"x" * 3000, "ü".encode() * 700, MALFORMED]
    encoder = pieces.Encoder(pieces.Vocabulary(library.serialized_model_proto()))
    want = library.encode(texts, add_eos=True)
    assert lists(encoder.encode(texts)) == want
    assert lists(encoder.encode(texts)) == want  # all units known


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 50)
    texts = [edges.words(30, k).encode() for k in range(40)]
    encoder = pieces.Encoder(pieces.Vocabulary(library.serialized_model_proto()))
    assert [x for k in range(0, 40, 7) for x in lists(encoder.encode(texts[k : k + 7]))] == library.encode(texts, add_eos=True)


def test_a_difference_is_an_error(library):
    encoder = pieces.Encoder(pieces.Vocabulary(library.serialized_model_proto()))
    encoder.v.ranks = encoder.v.ranks[::-1]
    with pytest.raises(ValueError):
        encoder.encode([b"international understanding"])


def test_round_trip_of_edges(spark, library):
    docs = edges.documents(spark)
    got = pieces.encoded(docs, MODEL, decoded="back")
    assert got.columns == [*docs.columns, "ids", "back"]
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all(r.ids == library.encode(r.text or "", add_eos=True) and r.back == (r.text or "") for r in rows)
    assert {tuple(r.ids) for r in rows if not r.text} == {(library.eos_id(),)}
    again = pieces.decoded(got.select("ids", "back"), MODEL).collect()
    assert all(r.decoded == r.back for r in again)
    assert pieces.encoded(edges.no_documents(spark), MODEL).count() == 0


def test_malformed_text_is_encoded(spark, library):
    (row,) = pieces.encoded(binary(spark, [MALFORMED]), MODEL, decoded="back").collect()
    assert row.ids == library.encode(MALFORMED, add_eos=True) and "�" in row.back


def plain_runs(w, exponent=4, least=6):
    """Every stretch by every period, smallest period first."""
    out, n = {}, len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, exponent * q):
                out.setdefault((s, i + q - s), q)
            i += i == s
    return sorted((s, length, q) for (s, length), q in out.items())


def repetitive(r, letters=3):
    w = []
    for _ in range(r.randrange(8)):
        b = [r.randrange(letters) for _ in range(r.randrange(1, 9))]
        w += b * r.randrange(1, 12) + b[: r.randrange(len(b) + 1)] + [r.randrange(letters) for _ in range(r.randrange(5))]
    return w


@pytest.mark.parametrize("batch", [7, 1 << 18])
def test_runs_of_random_words(batch):
    r = random.Random(5)
    for _ in range(60):
        texts = [repetitive(r) for _ in range(r.randrange(1, 6))]
        codes = np.array([c for t in texts for c in t], np.int64)
        got = runs.found(codes, np.array([len(t) for t in texts]), batch=batch)
        want = [(k, *x) for k, t in enumerate(texts) for x in plain_runs(t)]
        assert [tuple(x) for x in got.tolist()] == sorted(want, key=lambda x: (x[0], x[1], x[3]))


@pytest.mark.parametrize("modulus", [1, 2, 7, 31])
def test_extensions(modulus):
    r = random.Random(modulus)
    cover, steps = runs.difference_cover(modulus)
    assert {(a - b) % modulus for a in cover for b in cover} == set(range(modulus)) and steps.max() < modulus
    codes = np.array(repetitive(r, 2) + repetitive(r, 2) + [99])
    i, j = (x.ravel() for x in np.meshgrid(range(len(codes)), range(len(codes))))
    i, j = i[i != j], j[i != j]
    got = runs.Extensions(codes, (cover, steps)).lce(i, j)

    def plain(a, b):
        return next(k for k in itertools.count() if max(a, b) + k >= len(codes) or codes[a + k] != codes[b + k])

    assert got.tolist() == [plain(a, b) for a, b in zip(i, j)]


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs_of_texts(spark):
    r = random.Random(8)
    texts = [" ".join(f"w{x}" for x in repetitive(r)) for _ in range(30)] + ["ab " * 20_000, "a\nb\tc \x0b" * 9, "a b\x1ca b\x1c" * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edges.documents(spark).select("doc_id", "text"))
    for row in runs.periodic_runs(docs).collect():
        words = [w.decode() for w in (row.text or "").encode().split()]
        want = plain_runs(words) if len(words) < 3000 else [(0, 20_000, 1)] if "ab " in row.text else []
        assert [tuple(x) for x in row.periodic.runs] == want
        assert row.periodic.n_words == len(words) and bytes(row.periodic.collapsed).decode() == collapsed(words, want)


def test_periodic_runs_of_edges(spark):
    docs = edges.documents(spark)
    out = runs.periodic_runs(docs)
    assert out.columns == [*docs.columns, "periodic"] and out.count() == docs.count()
    assert runs.periodic_runs(edges.no_documents(spark)).count() == 0
    (row,) = runs.periodic_runs(binary(spark, [b"\xff\xfe a " * 8])).collect()
    assert [tuple(x) for x in row.periodic.runs] == [(0, 16, 2)] and bytes(row.periodic.collapsed) == b"\xff\xfe a"


def words_of(body):
    return "".join(chr(c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() and c < 128 or c >= 128 else " " for c in body).encode("latin-1").split()


def grams(body, longest):
    w = words_of(body)
    return [zlib.crc32(b" ".join(w[i : i + n])) for n in range(1, longest + 1) for i in range(len(w) - n + 1)], len(w)


@pytest.mark.parametrize("longest", [1, 3])
def test_features_are_runs_of_words(longest):
    r = random.Random(2)
    for body in [b"", b" .", MALFORMED, "Ärger, ÄRGER é 12-ab".encode(), *(bytes(r.randrange(256) for _ in range(200)) for _ in range(50))]:
        want, n = grams(body, longest)
        got, size = resample.features(body, longest)
        assert got == Counter(want) and size == n


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling(spark, longest):
    r = random.Random(1)
    bodies = [" ".join(r.choice(["red", "Blue", "sky", "é", f"x{r.randrange(50)}"]) for _ in range(r.randrange(60))).encode() for _ in range(400)] + [b"", MALFORMED * 9]
    docs = binary(spark, bodies).unionByName(spark.createDataFrame([(5, None), (None, "red " * 30), (7, "red " * 30), (7, "red " * 30)], "doc_id long, text string"))
    target = spark.createDataFrame([("blue sky blue",), (None,), ("",)], "text string")
    got = resample.resampled(docs, target, key="doc_id", longest=longest, buckets=97, share=25).collect()

    def spots(body):
        values, n = grams(body, longest)
        return [v % 97 for v in values], n

    rows = [(i, spots(b)) for i, b in [*enumerate(bodies), (5, b""), (None, b"red " * 30), (7, b"red " * 30), (7, b"red " * 30)]]
    s, t = Counter(k for _, (f, _) in rows for k in f), Counter(spots(b"blue sky blue")[0])
    gain = [math.floor(1000 * math.log((t[k] + 1) * (s.total() + 97) / ((s[k] + 1) * (t.total() + 97)))) for k in range(97)]
    want = []
    for i, (f, n) in rows:
        weight = sum(gain[k] for k in f) // len(f) if f else 0
        h = int(__import__("hashlib").sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in want if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0]))
    drawn = Counter(order[: 25 * len(order) // 100])
    assert Counter((g.doc_id, *g.drawn[:4]) for g in got) == Counter(want)
    ranked = sorted((g for g in got if g.drawn.rank), key=lambda g: g.drawn.rank)
    assert [g.drawn.rank for g in ranked] == list(range(1, drawn.total() + 1))
    assert [(g.doc_id, *g.drawn[:4]) for g in ranked] == order[: drawn.total()]


def test_resampling_of_edges(spark):
    docs, empty = edges.documents(spark), edges.no_documents(spark)
    out = resample.resampled(docs, empty, key="doc_id", share=100)
    assert out.columns == [*docs.columns, "drawn"] and out.count() == docs.count()
    assert all((r.drawn.rank is not None) == (r.drawn.n_words >= 20) for r in out.collect())
    assert resample.resampled(empty, docs, key="doc_id").count() == 0


def test_pairs_that_form_no_piece_are_told_without_a_search(monkeypatch):
    import numpy as np
    import public_tokenizers

    from skyledger.llm import pieces as p

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        v = p.Vocabulary(f.read())
    rng = np.random.default_rng(1)
    none = rng.integers(0, len(v.ids), (2, 20_000))
    left, right = np.concatenate([v.pairs >> 32, none[0]]), np.concatenate([v.pairs & 0xFFFFFFFF, none[1]])
    formed = dict(zip(v.pairs.tolist(), zip(v.ranks.tolist(), v.formed.tolist())))
    searched, search = [], np.searchsorted
    monkeypatch.setattr(p.np, "searchsorted", lambda a, x, *rest: searched.append(len(x)) or search(a, x, *rest))
    rank, new = v.ranked(left, right)
    for key, r, n in zip((left << 32 | right).tolist(), rank.tolist(), new.tolist()):
        assert (r, n) == formed.get(key, (p.NEVER, 0))
    assert sum(searched) < len(v.pairs) + 5_000
