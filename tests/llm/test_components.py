import random

from loomgraph.llm.components import components


def brute(links):
    label = {x: x for two in links for x in two}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], moved = low, True
    alone = {x for x in label if all(a == b for a, b in links if x in (a, b))}
    return {x: r for x, r in label.items() if x not in alone}


def test_components(spark):
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(5000, 5000 + i) for i in range(1, 200)]
    rest = [(r.randrange(400), r.randrange(400)) for _ in range(260)]
    links = [*chain[::-1], *star, *rest, (9, 9)]
    found = {x.v: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == brute(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_strings(spark):
    found = {x.v: x.root for x in components(spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string")).collect()}
    assert found == {"a": "a", "b": "a", "c": "a"}
