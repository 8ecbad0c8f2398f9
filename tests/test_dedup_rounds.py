"""Duplicate removal in rounds that only look at what the last one touched."""

import random

import pytest

from recordtide.operators import dedup
from recordtide.operators.dedup import canonical_rank, dedup_fixpoint
from tests.test_relations import rows


def brute(nodes, refs, rank):
    """All nodes grouped anew in every round."""
    alive, edges, moved = dict((n[0], n[1:]) for n in nodes), set(refs), {}
    while True:
        groups = {}
        for node, facts in alive.items():
            if facts[0] is not None:
                groups.setdefault((facts[0], frozenset((s, t) for o, s, t in edges if o == node)), []).append(node)
        step = {}
        for members in groups.values():
            if len(members) > 1 and len({alive[m][1:] for m in members}) == 1:
                head = min(members, key=rank)
                step |= {m: head for m in members if m != head}
        if not step:
            return sorted(moved.items())
        alive = {n: f for n, f in alive.items() if n not in step}
        edges = {(o, s, step.get(t, t)) for o, s, t in edges if o not in step}
        moved = {old: step.get(new, new) for old, new in moved.items()} | step


def plain(name):
    return len(name), name


@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, seed):
    """Acyclic references with few contents, so that merges cascade; families that keep some groups apart for a while."""
    choose = random.Random(seed)
    names = [f"n{k:03d}" for k in range(60)]
    nodes = [(n, choose.choice(["a", "b", None]) if k > 8 else "leaf", choose.choice(["f", "f", "f", "g", None])) for k, n in enumerate(names)]
    refs = [(names[k], choose.choice("xy"), names[choose.randrange(max(1, k // 2))]) for k in range(1, 60) for _ in range(choose.choice([0, 1, 1, 2, 3]))]
    refs += [("nobody", "x", "n000"), ("n001", "x", None), ("n001", None, "n000")]
    frames = spark.createDataFrame(nodes, "id string, content string, kind string"), spark.createDataFrame(refs, "owner string, slot string, target string")
    assert rows(dedup_fixpoint(*frames, "kind")) == brute(nodes, refs, plain)
    assert rows(dedup_fixpoint(*frames, bucket_rows=5, regroup_below=0)) == brute([n[:2] for n in nodes], refs, plain)


def test_a_deep_chain_costs_what_it_redirects(spark, monkeypatch):
    """Two chains of 8 levels merge level by level; a round handles a few rows although the table has thousands."""
    levels = 8
    nodes = [(f"n{level:02d}{copy}", f"level {level}") for level in range(levels) for copy in "ab"]
    refs = [(f"n{level:02d}{copy}", "child", f"n{level - 1:02d}{copy}") for level in range(1, levels) for copy in "ab"]
    nodes += [(f"other{k}", f"other {k}") for k in range(5000)]
    refs += [(f"other{k}", "child", f"n{k % levels:02d}z") for k in range(5000)]
    seen, elect = [], dedup.remap_table

    def counted(members, *args):
        seen.append(members.count())
        return elect(members, *args)

    monkeypatch.setattr(dedup, "remap_table", counted)
    found = dedup_fixpoint(spark.createDataFrame(nodes, "id string, content string"), spark.createDataFrame(refs, "owner string, slot string, target string"), regroup_below=0)
    assert rows(found) == [(f"n{level:02d}b", f"n{level:02d}a") for level in range(levels)]
    assert seen[0] == len(nodes) and len(seen) == levels and max(seen[1:]) <= 2


def test_a_group_becomes_mergeable_when_a_member_leaves(spark):
    """``c`` keeps ``a`` and ``b`` apart by its family, until its reference changes."""
    nodes = [("a", "same", "f"), ("b", "same", "f"), ("c", "same", "g"), ("t1", "leaf", "f"), ("t2", "leaf", "f"), ("u", "top", "f")]
    refs = [("a", "x", "t2"), ("b", "x", "t2"), ("c", "x", "t2"), ("u", "x", "a")]
    frames = spark.createDataFrame(nodes, "id string, content string, kind string"), spark.createDataFrame(refs, "owner string, slot string, target string")
    for below in (0, 1000):
        assert rows(dedup_fixpoint(*frames, "kind", regroup_below=below)) == brute(nodes, refs, plain)


def test_rank_is_the_canonical_order(spark):
    names = [("n001",), ("n0010",), ("n000",)]
    best = spark.createDataFrame(names, "name string").selectExpr("name").orderBy(canonical_rank(dedup.F.col("name"))).collect()
    assert [r.name for r in best] == sorted((n for n, in names), key=plain)
