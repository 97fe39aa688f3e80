"""Merkle manifests against a plain recursive version and against DuckDB."""

import hashlib
import zlib

import duckdb
import pytest

from pyspark.sql import functions as F
from tests.llm.helpers import DOCS, documents, odd_rows
from tidewake.llm import merkle
from tidewake.llm.queries import ORACLES, QUERIES


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climbed(nodes):
    """Root, and for each node its siblings with their side."""
    paths, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for k, span in enumerate(spans):
            other = k ^ 1
            for i in span:
                paths[i].append((k % 2, nodes[other] if other < len(nodes) else None))
        nodes = [sha(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
        spans = [sum(spans[k:k + 2], []) for k in range(0, len(spans), 2)]
    return nodes[0], paths


def plain_manifest(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    below = {name: climbed([leaf(r) for r in trees[name]]) for name in names}
    root, above = climbed([below[name][0] for name in names])
    out = []
    for name, high in zip(names, above):
        for row, low in zip(trees[name], below[name][1]):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            own = leaf((*row[:3], row[3] + 1, row[4]) if changed else row)
            for right, sibling in low + high:
                own = sha(own) if sibling is None else sha(sibling, own) if right else sha(own, sibling)
            out.append((row[0], leaf(row), below[name][0], root, sha(*[s or "" for _, s in low + high]), own, own == root))
    return sorted(out, key=str)


def result(docs):
    found = merkle.merkle_manifest(docs, merkle.DOCUMENT, current=merkle.tampered_documents()).drop("proof").collect()
    return sorted((tuple(r) for r in found), key=str)


def plain_rows(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]


@pytest.mark.parametrize("levels", [10, 2])
def test_odd_rows(spark, monkeypatch, levels):
    """Null and repeated ids and groups, a single-leaf group, whole texts; small blocks make several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = documents(spark, odd_rows() + [(1000 + i, f"text {i}", "s") for i in range(77)])
    lang = F.when(F.col("doc_id") == 4, "zz").when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") < 1000, F.col("lang")).otherwise("é")
    docs = docs.withColumn("lang", lang).withColumn("n_chars", F.when(F.col("doc_id") != 9, F.col("n_chars")))
    assert result(docs) == plain_manifest(plain_rows(docs))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_leaves(spark, n):
    docs = documents(spark, [(i, f"t{i}", None) for i in range(n)])
    assert result(docs) == plain_manifest(plain_rows(docs))


def test_empty_table(spark):
    assert result(spark.createDataFrame([], DOCS)) == []


def test_unchanged_rows_verify_and_changed_ones_do_not(spark):
    docs = documents(spark, [(i, f"t{i}", None) for i in range(60)])
    assert merkle.merkle_manifest(docs, merkle.DOCUMENT).where("verified").count() == 60
    changed = merkle.merkle_manifest(docs, merkle.DOCUMENT, current=merkle.row_hash(["doc_id", F.lit("other")]))
    assert changed.where("verified").count() == 0


def test_pointers_double(spark, monkeypatch):
    """The number of self-joins is logarithmic in the depth."""
    joins, plain = [], merkle._jumped
    monkeypatch.setattr(merkle, "_jumped", lambda left, right: joins.append(1) or plain(left, right))
    docs = documents(spark, [(i, f"t{i}", None) for i in range(300)])
    rows = docs.select(F.col("lang").alias("group"), F.col("doc_id").alias("order"), merkle.row_hash(["doc_id"]).alias("hash"), F.lit(1).alias("load"))
    manifest = merkle.build(rows)
    assert manifest.depth == 9
    proven = merkle.proofs(manifest)
    assert len(joins) == 2 * 4  # leaves and inner nodes, distances 1, 2, 4 and 8
    assert proven.where(F.col("up_level") != merkle.NOWHERE).isEmpty()
    assert {len(merkle.entries(bytes(r.segment))) for r in proven.collect()} == {9}


def test_query_by_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = con.execute(ORACLES["op12_merkle_manifest"]).df()
    found = QUERIES["op12_merkle_manifest"](spark, sf).toPandas()[list(expected.columns)]
    rows = [sorted(map(tuple, x.values.tolist()), key=str) for x in (found, expected)]
    assert rows[0] == rows[1] and len(rows[0]) == 200
