"""The pipeline's stages on their own inputs, and the queries against the contract's columns."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.helpers import documents, linked, odd_rows, words
from tests.llm.test_models_and_quality import brute_figures, own_line, thin_rows
from tests.llm.test_tokens_and_warc import BYTE_BPE, WORD_BPE, check_packing
from tidewake.llm import mixing
from tidewake.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    inputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(stage(spark, inputs[-1], SMALL).cache())
    rows = [{r.doc_id: r.text for r in x.collect()} for x in inputs[:4]]
    assert all(x.columns == COLUMNS for x in inputs[1:-1])
    # Quality: what fails the base rules goes, clean documents stay.
    for i, t in rows[0].items():
        n, _, _, _, repeated = brute_figures(t)
        if n < 10 or 100 * repeated > 20 * n:
            assert i not in rows[1]
    assert len(rows[1]) > 0.8 * len(rows[0])
    # Exact: one row of each text.
    texts = collections.Counter("".join(words(t)) for t in rows[1].values())
    assert collections.Counter("".join(words(t)) for t in rows[2].values()) == collections.Counter(set(texts))
    # Near: one row of each component.
    components = {c for _, _, c in linked(list(rows[2].items()), 5, 80)}
    assert set(rows[3]) == components
    # Mixing: whole documents, at most twice.
    copies = collections.Counter(r.doc_id for r in inputs[4].collect())
    assert set(copies) <= set(rows[3]) and max(copies.values()) <= 2
    # Packing: every id once; rows that the mix repeats are packed each.
    pieces = inputs[5].collect()
    assert collections.Counter(p.doc_id for p in pieces if p.start == 0) == copies
    once = spark.createDataFrame([(i, rows[3][i], "s") for i in copies], "doc_id bigint, text string, source string")
    check_packing(corpus_pipeline.pack(spark, once, SMALL).collect(), [(i, rows[3][i]) for i in copies])


def brute_quality(rows):
    """Rows (id, text, source) that stay, without lines of more than 20 distinct documents of a source."""
    def normal(line):
        return re.sub("[1-9]", "0", " ".join(words(line)).lower())

    carriers, out = collections.defaultdict(set), []
    for _, t, s in rows:
        lines = tuple(normal(x) for x in (t or "").split("\n") if words(x))
        for x in lines:
            carriers[s, x].add(lines)
    for i, t, s in rows:
        n, _, _, _, repeated = brute_figures(t)
        lines = (t or "").split("\n")
        gone = [bool(words(x)) and len(carriers[s, normal(x)]) > 20 for x in lines]
        removed = sum(len(words(x)) for x, g in zip(lines, gone) if g)
        if n >= 10 and 100 * repeated <= 20 * n and 100 * (n - removed) >= 20 * n:
            out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g) if any(gone) else t, s))
    return out


def test_stages_row_for_row(spark):
    """Quality by brute force, mixing by its SQL and packing on the rows as the mix repeats them."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*COLUMNS)
    extra = [(10**6 + i, t, s) for i, t, s in thin_rows()]
    extra += [(2 * 10**6 + i, f"A common line of page {10 + i}\n" + own_line(i, 40), "lined") for i in range(30)]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in extra], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SMALL).cache()
    want = brute_quality([(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert collections.Counter((r.doc_id, r.text, r.source) for r in good.collect()) == collections.Counter(want)
    assert sum(s == "lined" and "common" not in t for _, t, s in want) == 30 and not any(s == "thin" for _, _, s in want)

    mixed = stages["mixing"](spark, good, SMALL).cache()
    con = duckdb.connect()
    con.register("documents", good.select("doc_id", "text", "source").toPandas())
    copies = {i: taken // size for i, size, _, _, taken in con.sql(mixing.QUERY_SQL).fetchall() if taken}
    known = {r.doc_id: tuple(r) for r in good.collect()}
    assert collections.Counter(map(tuple, mixed.collect())) == collections.Counter({known[i]: n for i, n in copies.items()})

    full = Tokenizer.from_file(BYTE_BPE)
    ids = {i: np.array(full.encode(known[i][1], add_special_tokens=False).ids + [0], "<u4") for i in copies}
    times, filled = {i: np.zeros(len(x), int) for i, x in ids.items()}, collections.Counter()
    for p in stages["packing"](spark, mixed, SMALL).collect():
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
        times[p.doc_id][p.start:p.start + p.length] += 1
        filled[p.sequence_id] += p.length
    assert all((times[i] == n).all() for i, n in copies.items())
    assert sorted(filled) == list(range(len(filled))) and all(filled[k] == 1024 for k in range(len(filled) - 1))


@pytest.mark.parametrize("rows", [odd_rows(), []])
def test_stages_on_odd_documents(spark, rows):
    """Nulls, empty and long texts, repeated rows, no rows, and columns with the names that operators use."""
    docs = documents(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        assert (docs.count() > 0) == bool(rows), name
        assert docs.columns == columns or name == "packing"


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 200
    assert corpus_pipeline.ORACLE_SQL is None


def small(spark, table):
    return spark.read.parquet(f"{SMALL}/{table}.parquet").collect()


def test_packing_query(spark):
    check_packing(QUERIES["op4_packing"](spark, SMALL).collect(), [(r.doc_id, r.text) for r in small(spark, "documents")])


def test_near_query(spark):
    rows = [(r.doc_id, r.text) for r in small(spark, "documents")]
    out = QUERIES["op6_near_dedup"](spark, SMALL)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()) == sorted(
        (i, n, c, i == c) for i, n, c in linked(rows, 3, 85))


def test_token_query(spark):
    full = Tokenizer.from_file(WORD_BPE)
    out = QUERIES["op8_token_counts"](spark, SMALL)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()}
    for r in small(spark, "documents"):
        n = len(full.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 2048)


def test_model_queries(spark):
    """Columns, folds and ranges; what is learned doesn't look at the held-out rows' labels."""
    docs = {r.doc_id: r for r in small(spark, "documents")}
    language = QUERIES["op5_language_id"](spark, SMALL)
    assert language.columns == ["doc_id", "held_out", "lang_pred", "score"]
    for r in language.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.lang_pred in {d.lang for d in docs.values()} | {"und"}
    toxic = QUERIES["op7_toxicity"](spark, SMALL)
    assert toxic.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = toxic.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)


def test_queries_are_complete():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(QUERIES)
    assert [n[: n.index("_")] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)
