"""Connected components against a plain union-find, in one part and in several."""

import random

import numpy as np
import pytest

from waybill.llm import components


def plain(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


def some_links(seed):
    pick = random.Random(seed)
    path = [(k, k + 1) for k in range(-40, 60)]
    star = [(1000, k) for k in range(1001, 1080)]
    loose = [(pick.randrange(2000, 2300), pick.randrange(2000, 2300)) for _ in range(150)]
    links = path + star + loose + star[:5] + [(b, a) for a, b in path[:9]]
    pick.shuffle(links)
    return [(a, b) for a, b in links if a != b]


@pytest.mark.parametrize("seed", range(4))
def test_forest(seed):
    links = some_links(seed)
    a, b = np.array(links, np.int64).T
    found = dict(zip(*(v.tolist() for v in components.forest(a, b))))
    assert found == {x: low for x, low in plain(links).items() if x != low}


@pytest.mark.parametrize("part", [40, 500_000])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr(components, "PART_LINKS", part)
    links = some_links(7)
    frame = spark.createDataFrame([*links, (None, 5), (5, None), (9000, 9000)], "x long, y long")
    found = {r["node"]: r["component"] for r in components.components(frame.repartition(16), "x", "y").collect()}
    assert found == plain(links)


def test_no_links(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
