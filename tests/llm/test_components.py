from skyledger.llm import components as c


def test_rounds_of_few_links_have_few_partitions(spark, monkeypatch):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    kept, settled = [], c.settled
    monkeypatch.setattr(c, "settled", lambda df: kept.append(settled(df)) or kept[-1])
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (5, 5)], "a long, b long")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = sorted(tuple(r) for r in c.components(links).collect())
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert found == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7)]
    assert [df.rdd.getNumPartitions() for df in kept[1:]] == [1] * (len(kept) - 1)


def test_partitions_follow_the_links():
    assert [c._parts(n) for n in (0, c.LINKS // 4, c.LINKS, 50 * c.LINKS)] == [1, 1, 3, 101]
