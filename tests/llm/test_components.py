"""Components equal union-find whatever the tasks hold; few links take few stages."""

import random

import pytest

from txnwatch.llm import components as C


def union_find(links):
    label = {x: x for link in links for x in link if link[0] != link[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


@pytest.mark.parametrize(("links_", "nodes"), [(1 << 16, 1 << 18), (40, 1 << 18), (25, 7)])
def test_components_of_chains_stars_and_copies(spark, monkeypatch, links_, nodes):
    monkeypatch.setattr(C, "LINKS", links_)
    monkeypatch.setattr(C, "NODES", nodes)
    rng = random.Random(6)
    chain = rng.sample(range(1000, 2000), 40)
    links = [*zip(chain, chain[1:]), *[(5, k) for k in range(2000, 2040)], *[(k, -7) for k in range(3000, 3020)], (9, 9), (3019, 2001)]
    links += [(rng.randrange(4000, 4200), rng.randrange(4000, 4200)) for _ in range(90)] + links[:10]
    rng.shuffle(links)
    got = C.connected(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.label for r in got} == union_find(links)
    assert C.connected(spark.createDataFrame([(4, 4)], "a long, b long")).collect() == []


def test_few_links_take_few_stages(spark):
    rng = random.Random(1)
    chain = rng.sample(range(10 ** 6), 500)
    links = spark.createDataFrame(list(zip(chain, chain[1:])), "a long, b long").checkpoint()
    sc = spark.sparkContext
    sc.setJobGroup("components", "components")
    try:
        assert {r.label for r in C.connected(links).collect()} == {min(chain)}
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert len(stages) <= 15  # 182 when every round dealt all links out several times
