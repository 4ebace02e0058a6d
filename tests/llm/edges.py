"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, row long, score double, size long, shard int, part int, found string, Text_ string, h long, start long, _said int"
CLASH = (7, "k", 3, 0.5, 9, 1, 2, "f", "t", 5, 6, 1)


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


LONG = words(30_000, 99, 5000)
PASSAGE = words(60, 5)


def rows():
    base = words(120, 1)
    near = base.split()
    near[7] = "changed"
    out = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, " ".join(near), "en", "b"),
        (4, None, "en", "b"),
        (5, "", "de", "b"),
        (6, " \t\n ", "de", None),
        (7, "one", None, "c"),
        (8, "two words", "de", "c"),
        (9, LONG, "de", "c"),
        (10, words(50, 2) + " " + PASSAGE + " " + words(50, 3), "en", "d"),
        (11, words(30, 4) + "\n" + PASSAGE.upper() + ". " + words(20, 6), "en", "d"),
        (12, "12345 !!! ???", "en", "d"),
        (None, words(40, 7), "en", "d"),
        (None, None, None, None),
        (13, words(40, 8), "en", "e"),
        (13, words(40, 8), "en", "e"),
        (13, words(45, 9), "de", "e"),
        (14, "ab " * 60, "de", "é"),
        (15, words(10, 10) + " " + PASSAGE + " " + words(200, 11), "de", "Z"),
    ]
    return [(*r, len(r[1] or ""), *CLASH) for r in out]


def documents(spark):
    return spark.createDataFrame(rows(), COLUMNS)


def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)
