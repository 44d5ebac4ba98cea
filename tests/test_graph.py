import random

from docloom.operators.graph import connected_components


def brute(pairs):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def test_components_equal_union_find(spark):
    rnd = random.Random(1)
    pairs = [(i, i - 1) for i in range(1, 20)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(60)]
    pairs += [(300, 300), (400, 401), (400, 401)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == brute(pairs)


def test_components_of_nulls_and_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
    got = connected_components(spark.createDataFrame([("x", None), ("b", "a")], "a string, b string"), "a", "b").collect()
    assert {(r.node, r.component) for r in got} == {("b", "a"), ("a", "a")}


def test_hot_centres_are_split(spark):
    """A star of half of all nodes, chains and small groups, with and without sub-stars."""
    rnd = random.Random(4)
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(300, 360)] + [(rnd.randrange(400, 500), rnd.randrange(400, 500)) for _ in range(60)]
    df = spark.createDataFrame([(b, a) if rnd.random() < 0.5 else (a, b) for a, b in edges], "a long, b long").repartition(3)
    found = [{r.node: r.component for r in connected_components(df, "a", "b", hot_edges=n).collect()} for n in (5, 1_000_000)]
    assert found[0] == found[1] and all(found[0][i] == 0 for i in range(300)) and all(found[0][i] == 300 for i in range(300, 361))
