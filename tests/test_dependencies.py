"""Closure of dependencies against all truth assignments of small sets."""

import itertools
import random

import pytest

from marketlake.operators import dependencies

HOLDS = {
    "implies": lambda a, b: b or not a,
    "equivalent": lambda a, b: a == b,
    "mutex": lambda a, b: not (a and b),
    "complement": lambda a, b: a != b,
}


def reach(spark, links):
    df = spark.createDataFrame(links, "outcome_id_a string, outcome_id_b string, relationship_type string")
    return dependencies.closure(dependencies.implications(df))


@pytest.mark.parametrize("seed", range(4))
def test_what_follows_holds_in_every_world(spark, rows, seed):
    rng = random.Random(seed)
    names = "abcdef"
    links = [(*rng.sample(names, 2), rng.choice([*HOLDS, "composite"])) for _ in range(7)]
    worlds = []
    for values in itertools.product([False, True], repeat=len(names)):
        world = dict(zip(names, values))
        if all(HOLDS[k](world[a], world[b]) for a, b, k in links if k in HOLDS):
            worlds.append(world)
    found = reach(spark, links)
    literal = lambda text, world: world[text[1:]] == (text[0] == "+")
    for src, dst in rows(found):
        assert all(literal(dst, w) for w in worlds if literal(src, w))
    conflicts = dict(rows(dependencies.contradictions(found)))
    assert ("contradiction" in conflicts.values()) == (not worlds)
    for name, kind in conflicts.items():
        if kind != "contradiction":
            assert not any(w[name] == (kind == "never true") for w in worlds)
    if worlds:  # and nothing that follows is missing
        for a, b in itertools.permutations(names, 2):
            if all(w[b] for w in worlds if w[a]) and not all(w[b] for w in worlds) and any(w[a] for w in worlds):
                assert (a, b, "implies") in rows(dependencies.derived_relations(found))


def test_chain_cycle_and_conflict(spark, rows):
    chain = [(f"n{i:02}", f"n{i + 1:02}", "implies") for i in range(20)]
    found = reach(spark, [*chain, ("x", "y", "implies"), ("y", "z", "equivalent"), ("z", "x", "implies"), ("p", "q", "implies"), ("p", "q", "mutex")])
    relations = rows(dependencies.derived_relations(found))
    assert sum(r == "implies" and a[0] == "n" for a, _, r in relations) == 210
    assert rows(dependencies.equivalence_cycles(found)) == [("x", "x"), ("y", "x"), ("z", "x")]
    assert rows(dependencies.contradictions(found)) == [("p", "never true")]


def test_nothing_to_close(spark):
    assert reach(spark, []).isEmpty()
    assert reach(spark, [("a", "b", "upper_bound"), (None, "b", "implies")]).isEmpty()
