import random

import edges
import pyarrow as pa
import pytest

from skyledger.llm import langid

EN = ["the cat and the dog went to the house", "this is what they said about the weather", "where is the other one that we saw"]
DE = ["der hund und die katze sind im haus", "das ist was sie über das wetter sagten", "wo ist der andere den wir gesehen haben"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang) for lang, ts in (("en", EN), ("de", DE)) for t in ts for _ in range(12)]
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def test_new_sentences(spark, model):
    docs = spark.createDataFrame([("the dog said this",), ("die katze und der hund",), ("1234 ...",), (None,), ("",)], "text string")
    got = langid.identify(docs, model).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got) and [r.rejected for r in got[2:]] == [True] * 3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.held_out("doc_id", 3, 1)
    got = langid.identify(docs.where(out), langid.train(docs.where(~out))).select("lang", "lang_pred", "rejected").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_texts_in_no_known_language_are_rejected(spark):
    model = langid.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    r = random.Random(1)
    noise = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(150)) for _ in range(10)]
    strange = "Привет как дела сегодня хорошая погода и мы идем гулять в парк вместе с друзьями"
    got = langid.identify(spark.createDataFrame([(t,) for t in [*noise, strange]], "text string"), model).collect()
    assert sum(g.rejected for g in got) >= 10


def test_prediction_reads_the_whole_text(spark, model):
    one = "the dog said this to the cat "
    other = "die katze und der hund sind im haus "
    got = langid.identify(spark.createDataFrame([(one + other * 60,)], "text string"), model).first()
    assert got.lang_pred == "de"


def test_nothing_to_learn_from(spark):
    model = langid.train(spark.createDataFrame([("x y", None), (None, "en")], "text string, lang string"))
    got = langid.identify(edges.documents(spark), model)
    assert {(r.lang_pred, r["rejected"]) for r in got.select("lang_pred", "rejected").collect()} == {("und", True)}


def test_edges_and_empty_table(spark):
    docs = edges.documents(spark)
    model = langid.train(docs)
    got = langid.identify(docs, model, score="p").collect()
    assert len(got) == docs.count()
    assert [r.lang_pred for r in got if r.doc_id in (4, 5, 6)] == ["und"] * 3
    assert langid.identify(edges.no_documents(spark), model, score="p").count() == 0
    assert langid.train(edges.no_documents(spark)).languages == []


def test_one_language(spark):
    model = langid.train(spark.createDataFrame([("abc def", "en")] * 3, "text string, lang string"))
    got = langid.identify(spark.createDataFrame([("abc",)], "text string"), model).first()
    assert (got.lang_pred, got.score, got.rejected) == ("en", 1.0, False)


def test_sample_is_bounded_and_distinct(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit", lambda texts, langs: seen.append((texts, langs)))
    rows = [("copied text", "en")] * 3000 + [(f"text number {i}", lang) for i in range(200) for lang in ("en", "de")] + [("x", f"junk{i}") for i in range(40)]
    langid.train(spark.createDataFrame(rows, "text string, lang string"), per_language=50, languages=3)
    ((texts, langs),) = seen
    assert len(set(zip(texts, langs))) == len(texts) and set(langs) == {"en", "de", "junk0"}
    assert 40 <= langs.count("en") <= 50 and 40 <= langs.count("de") <= 50


def test_long_texts_are_scored_in_pieces(model, monkeypatch):
    texts = pa.array(["", "the cat", "a" * 999, "der hund und die katze " * 30, "", "x"])
    want = model.predict(texts)
    for size in (1, 3, 100):
        monkeypatch.setattr(langid, "PIECE", size)
        got = model.predict(texts)
        assert got[0].tolist() == want[0].tolist() and got[1] == pytest.approx(want[1])


def test_malformed_texts(spark):
    rows = spark.createDataFrame([(t.encode(), lang) for lang, ts in (("en", EN), ("de", DE)) for t in ts] + [(b"the \xff dog \xc3", "en")], "b binary, lang string")
    docs = rows.selectExpr("cast(b as string) AS text", "lang")
    assert langid.identify(docs, langid.train(docs)).count() == 7
