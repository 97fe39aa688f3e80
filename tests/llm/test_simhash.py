"""BK-trees against all pairs, and SimHash components against brute force."""

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import DOCS, LOWER, documents, odd_rows, words
from tidewake.llm import bk_tree, simhash_dedup


def plain_fingerprint(text, width=4):
    ws = [w.translate(LOWER) for w in words(text)]
    if not ws:
        return 0
    n = max(1, len(ws) - width + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i:i + width]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(rows, radius=4):
    """Component by row, from all pairs of fingerprints."""
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((d, f"{p:016x}", least.get(root(i))) for i, ((d, _, _), p) in enumerate(zip(rows, prints))), key=str)


def around(rng, n, flips):
    centre = int(rng.integers(0, 1 << 63))
    return np.unique(np.array([centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, flips + 1), replace=False)) for _ in range(n)], np.uint64))


def test_trees_find_what_all_pairs_find():
    rng = np.random.default_rng(1)
    trees = [around(rng, 300, 5), around(rng, 1, 0), np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64)), around(rng, 80, 20)]
    values, sizes = np.concatenate(trees), np.array([len(t) for t in trees])
    forest = bk_tree.build(values, sizes)
    child = np.flatnonzero(forest.parent >= 0)
    assert (bk_tree.distances(values[child], values[forest.parent[child]]) == forest.distance[child]).all()
    assert len(set(zip(forest.parent[child], forest.distance[child]))) == len(child)  # one child an edge
    asked = np.repeat(np.arange(len(sizes)), sizes)
    for radius in (0, 1, 4):
        found = {(int(q), int(x)) for qs, xs in bk_tree.search(forest, values, asked, radius) for q, x in zip(qs, xs)}
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
        assert found == set(zip(*(x.tolist() for x in np.nonzero(near & (asked[:, None] == asked[None, :])))))
    one = bk_tree.build(trees[0], np.array([len(trees[0])]))
    again = bk_tree.from_bytes(one.to_bytes())
    assert all((getattr(one, k) == getattr(again, k)).all() for k in ("values", "parent", "distance", "roots"))


def test_search_leaves_subtrees_out():
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    forest = bk_tree.build(values, np.array([len(values)]))
    seen = []
    plain, bk_tree.distances = bk_tree.distances, lambda a, b: (seen.append(len(a)), plain(a, b))[1]
    try:
        list(bk_tree.search(forest, values[:100], np.zeros(100, np.int64), 4))
    finally:
        bk_tree.distances = plain
    assert sum(seen) < 0.6 * 100 * len(values)


def test_blocks_catch_every_pair_within_the_radius():
    rng = np.random.default_rng(3)
    for agree, many in ((1, 5), (2, 15), (3, 35)):
        masks = simhash_dedup.block_masks(4, agree)
        assert len(masks) == many
        for _ in range(300):
            flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(flips & m & (1 << 64) - 1 == 0 for m in masks)


@pytest.mark.parametrize("options", [{}, {"agree": 1}, {"shard_size": 4}])
def test_components_by_brute_force(spark, options):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(400)]
    rows = odd_rows()
    for k in range(60):  # a large group of near copies, which runs over several small shards
        own = list(base)
        for at in rng.choice(400, 3, replace=False):
            own[at] = f"x{k}"
        rows.append((100 + k, " ".join(own), "hot"))
    found = simhash_dedup.simhash_dedup(documents(spark, rows), **options).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows)


def test_query_by_brute_force(spark):
    from tidewake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op11_simhash_dedup"](spark, sf).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows)


def test_empty_table_and_kept_rows(spark):
    assert simhash_dedup.simhash_dedup(spark.createDataFrame([], DOCS)).collect() == []
    docs = documents(spark, [(3, "a b c d e", "s"), (2, "A b c  d e", "s"), (None, "a b c d e", "s"), (None, "quite another text", "s"), (5, None, "s")])
    kept = simhash_dedup.drop_simhash_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {2, 5, None}
