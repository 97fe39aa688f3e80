import collections
import hashlib
import re

from tests.llm.helpers import documents, odd_rows, words
from tidewake.llm.exact_dedup import drop_exact_copies, exact_dedup
from tidewake.llm.mixing import mix_sources, mixed_documents, source_targets


def dense(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_groups(spark):
    rows = odd_rows()
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[dense(t)].append((-len(t or ""), i is None, i or 0, i))
    out = exact_dedup(documents(spark, rows), first=8, growth=3).collect()
    want = collections.Counter((i, min(groups[dense(t)])[3], len(groups[dense(t)]), hashlib.sha256(dense(t).encode()).hexdigest()) for i, t, _ in rows)
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == want
    kept = collections.Counter(r.text_sha256 for r in out if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_digits_that_end_together(spark):
    """Texts that are prefixes of each other, around the borders of digits."""
    rows = [(i, "a" * n, "s") for i, n in enumerate([0, 7, 8, 9, 16, 24, 25, 31, 32, 33, 8, 32])]
    sizes = {r.doc_id: r.group_size for r in exact_dedup(documents(spark, rows), first=8, growth=1).collect()}
    assert sizes == {0: 1, 1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 2, 9: 1, 10: 2, 11: 2}


def test_exact_rows_that_stay(spark):
    docs = documents(spark, odd_rows())
    out = drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert len(out.collect()) == len({dense(t) for _, t, _ in odd_rows()})


def test_empty_tables(spark):
    none = documents(spark, [])
    assert exact_dedup(none).count() == drop_exact_copies(none).count() == mix_sources(none).count() == mixed_documents(none).count() == 0


def targets_by_rounds(sizes, weights, share, cap):
    """Share by weight, stop at the cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if level * weight[s] >= cap * sizes[s]}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
        if not full:
            return out | {s: level * weight[s] for s in open_}


def test_targets(spark):
    sizes = {"b": 100, "a": 3, "c": 50, "é": 7, None: 400, "zero": 0}
    table = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(table).collect()}
    want = targets_by_rounds(sizes, (3, 1, 2), 1.5, 2.0)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_mix(spark):
    rows = odd_rows() + [(100 + i, "w " * (1 + i * 7 % 50), f"s{i % 4}") for i in range(400)]
    out = mix_sources(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    want = targets_by_rounds(size, (3, 1, 2), 1.5, 2.0)
    taken, largest = collections.Counter(), collections.Counter()
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
    by_id = {i: s for i, _, s in rows if i is not None}
    for r in out:
        if r.doc_id is not None:
            taken[by_id[r.doc_id]] += r.taken
            largest[by_id[r.doc_id]] = max(largest[by_id[r.doc_id]], r.size)
            assert abs(r.target - want[by_id[r.doc_id]]) < 1e-6
    for s in ("s0", "s1", "s2", "s3", "b"):
        assert abs(taken[s] - want[s]) <= 2 * largest[s]
    again = mix_sources(documents(spark, rows[::-1]).repartition(5)).collect()
    assert collections.Counter(out) == collections.Counter(again)


def test_mixed_rows(spark):
    docs = documents(spark, odd_rows())
    taken = collections.Counter()
    for r in mix_sources(docs).collect():
        taken[r.doc_id] += r.copies if r.size else 0
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == +taken
