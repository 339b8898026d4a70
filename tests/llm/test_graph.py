"""Connected components against union-find, and how many rounds they take."""

import random

from chronofold.llm import graph


def brute(links):
    top = {n: n for link in links for n in link}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    return {n: root(n) for n in top}


def found(df):
    return {r["node"]: r["label"] for r in df.collect()}


def test_random_graphs(spark, monkeypatch):
    rng = random.Random(2)
    links = [(rng.randrange(300) - 100, rng.randrange(300) - 100) for _ in range(150)] + [(0, 500 + k) for k in range(100)] + [(7, 7)]
    df = spark.createDataFrame(links * 2 + [(None, 3), (4, None)], "a long, b long").repartition(5)
    assert found(graph.components(df)) == brute([link for link in links if link[0] != link[1]])


def test_a_long_path_takes_few_rounds(spark):
    """Ascending ids along a path, over many tasks that join up nothing by themselves."""
    df = spark.range(5000, numPartitions=64).selectExpr("id AS a", "id + 1 AS b")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        labels, rounds = graph.components_and_rounds(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert rounds <= 20 and labels.count() == 5001 and labels.where("label <> 0").isEmpty()


def test_no_links(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
