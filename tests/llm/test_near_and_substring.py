import collections
import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import documents, linked, odd_rows, words
from tidewake.llm.fm_index import BitVector, FMIndex
from tidewake.llm.near_dedup import REGISTERS, drop_near_copies, joint_estimate, near_dedup, sketch
from tidewake.llm.substring_dedup import Runs, substring_dedup


def family(seed, copies, length=120, edits=4):
    """A text and copies of it with a few words changed each: copies resemble the text more than each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(own))
    rng.shuffle(out)
    return out


def near_rows():
    texts = [t for s in range(6) for t in family(s, 25)] + family(7, 60, 90, 3)
    # A chain in which only neighbours are linked.
    rng = random.Random(1)
    chain = [f"c{i}" for i in range(150)]
    for _ in range(12):
        texts.append(" ".join(chain))
        at = rng.randrange(140)
        chain[at:at + 4] = [f"d{rng.randrange(10**6)}" for _ in range(4)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("width,percent,per_band", [(3, 85, 8), (5, 80, 6)])
def test_near_components(spark, width, percent, per_band):
    rows = near_rows()
    out = near_dedup(documents(spark, [(i, t, "s") for i, t in rows]), width=width, percent=percent, rows_per_band=per_band).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == sorted(linked(rows, width, percent))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_odd_rows(spark):
    rows = odd_rows()
    out = near_dedup(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    named = [(i, t) for i, t, _ in rows if i is not None]
    want = linked(named, 5, 80)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None) == sorted(want)
    assert documents(spark, rows).columns == drop_near_copies(documents(spark, rows)).columns
    assert near_dedup(documents(spark, [])).count() == 0


def test_sketch_estimates():
    rng = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.85, 0.95):
        both = int(2 * share / (1 + share) * 500)
        pool = rng.integers(0, 2**63, size=(60, 1000 - both), dtype=np.uint64)
        a, b = sketch([p[:500] for p in pool]), sketch([p[500 - both:] for p in pool])
        size = np.full(60, 500.0)
        estimates = joint_estimate(a, b, size, size)
        assert abs(estimates.mean() - both / (1000 - both)) < 0.02
        merged = sketch([np.unique(p) for p in pool])
        assert (merged == np.maximum(a, b)).all() and merged.shape == (60, REGISTERS)


def brute_passages(rows, window=13):
    least = {}
    for i, t in rows:
        ws = words(t)
        for k in range(len(ws) - window + 1):
            g = tuple(ws[k:k + window])
            least[g] = min(least.get(g, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t in rows:
        ws, gone = words(t), set()
        for k in range(len(ws) - window + 1):
            if least[tuple(ws[k:k + window])] < (float("inf") if i is None else i):
                gone.update(range(k, k + window))
        kept = [w for k, w in enumerate(ws) if k not in gone]
        out.append((i, len(ws), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def passage_rows():
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(50)]
    shared = [[rng.choice(vocabulary) for _ in range(n)] for n in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(120):
        ws = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        for s in rng.sample(shared, rng.randrange(3)):
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = s
        rows.append((i, " ".join(ws)))
    rows.append((200, "for " * 300))
    rows.append((201, "for " * 50 + "x " + "for " * 20))
    return rows


@pytest.mark.parametrize("hot", [5000, 3])
def test_passages(spark, hot):
    rows = passage_rows()
    docs = documents(spark, [(i, t, "s") for i, t in rows] + odd_rows())
    out = substring_dedup(docs, hot=hot).collect()
    want = brute_passages(rows + [(i, t) for i, t, _ in odd_rows()])
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == collections.Counter(want)
    assert all(sum(s.words for s in r.spans) == r.n_removed for r in out)
    assert substring_dedup(documents(spark, [])).count() == 0


def test_runs_cover_all_windows():
    texts = [t.encode() for _, t in passage_rows()] + [b"", b"a b c"]
    runs = Runs(texts, 13)
    windows = sum(max(0, len(t.split()) - 12) for t in texts)
    assert runs.count.sum() == windows


def test_fm_index():
    rng = np.random.default_rng(2)
    bits = rng.random(1000) < 0.3
    assert (BitVector(bits).rank(np.arange(1001)) == np.concatenate([[0], np.cumsum(bits)])).all()
    symbols = np.concatenate([np.append(rng.integers(1, 5, rng.integers(1, 40)), 0) for _ in range(40)])
    reach = 6
    index = FMIndex(symbols, 5, reach)
    starts = np.array([i for i in range(len(symbols) - reach) if (symbols[i:i + reach] > 0).all()])
    length, low, high = index.statistics(symbols, starts, reach)
    assert (length == reach).all()
    for s, a, b in zip(starts, low, high):
        same = {i for i in range(len(symbols) - reach) if (symbols[i:i + reach] == symbols[s:s + reach]).all()}
        assert set(index.suffixes[a:b].tolist()) == same
    # A pattern that is not there stops short.
    absent = np.array([4, 4, 4, 4, 4, 4, 4, 4])
    assert index.statistics(np.concatenate([symbols, absent]), np.array([len(symbols)]), 6)[0][0] <= 6
