"""Sync plans by folder digests against the plan that compares every file."""

import random

import pytest

from beamwright.operators import digests, inventory

SCHEMA = "rel_path string, checksum string, folder string"


def rows_of(df, *extra):
    return sorted((tuple(r) for r in df.select("rel_path", "checksum", "target_checksum", "action", *extra).collect()), key=repr)


def folder(path):
    return path.rpartition("/")[0]


def deep(rng, n):
    return "/".join(rng.choice("abc") for _ in range(rng.randint(0, n))) + f"/f{rng.randint(0, 10**9)}"


@pytest.mark.parametrize("depth", [2, 30])
def test_tree_plan_equals_flat_plan(spark, depth):
    """Paths at the root, with a leading or a doubled slash, null checksums and paths, a hot folder, folders on one side only."""
    rng = random.Random(depth)
    paths = {deep(rng, depth) for _ in range(150)} | {f"hot/{i}" for i in range(200)} | {"top", "/top", "a//b", "a/b", "/a/b", "x/y/", "x"}
    source = [(p, rng.choice([None, "1", "2"]), "clash") for p in sorted(paths)]
    target = []
    for p, c, k in source:
        draw = 1 if p.startswith("hot/") else rng.random()
        if draw > 0.08:
            target.append((p, "other" if draw < 0.12 else c, k))
    target += [("only/there/f", "1", "k"), ("hot/199/extra", "1", "k")]
    a = spark.createDataFrame([*source, (None, "1", "k"), (None, None, "k")], SCHEMA).repartition(5)
    b = spark.createDataFrame([*target, (None, "1", "k")], SCHEMA).repartition(3)
    plan = digests.tree_sync_plan(a, b)
    assert rows_of(plan) == rows_of(inventory.sync_plan(a, b))
    mine, theirs = {}, {}
    for rows, held in ((source, mine), (target, theirs)):
        for p, c, _ in rows:
            held.setdefault(folder(p), set()).add((p, c))
    differ = {f for f in mine if mine[f] != theirs.get(f)}
    assert "hot" not in differ and differ
    opened = {r.rel_path for r in plan.filter("compared").collect() if r.rel_path is not None}
    assert opened == {p for p, _, _ in source if folder(p) in differ}


def test_tree_counts_and_reuse(spark):
    a = spark.createDataFrame([("a/b/x", "1", ""), ("a/y", "2", ""), ("z", None, "")], SCHEMA)
    tree = digests.folder_tree(a)
    assert {(r.folder, r.depth, r.files) for r in tree.collect()} == {("", 0, 3), ("a", 1, 2), ("a/b", 2, 1)}
    plan = digests.tree_sync_plan(a, a, tree, tree)
    assert {(r.action, r.compared) for r in plan.collect()} == {("SKIP_SAME", False)}


def test_repeated_rows(spark):
    """A path listed twice on one side differs from one listed once, so its folder is compared as the flat plan does."""
    a = spark.createDataFrame([("a/x", "1", ""), ("a/x", "1", "")], SCHEMA)
    b = spark.createDataFrame([("a/x", "1", "")], SCHEMA)
    assert rows_of(digests.tree_sync_plan(a, b), "compared") == [("a/x", "1", "1", "SKIP_SAME", True)] * 2


def test_empty_inventories(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([("a/x", "1", "")], SCHEMA)
    assert digests.folder_tree(none).count() == 0
    assert digests.tree_sync_plan(none, some).count() == 0
    assert rows_of(digests.tree_sync_plan(some, none), "compared") == [("a/x", "1", None, "COPY_NEW", True)]
