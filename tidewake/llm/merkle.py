"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

1. Rows are hashed, ordered within their group and numbered. Nodes of ten levels
   come from one block of 1,024 neighbours, so a group of any size takes a few rounds of
   bounded blocks. The roots of the groups are the leaves of one more tree.
2. Every node holds a segment, the siblings on the way to some ancestor, and points
   to that ancestor; at first its parent. A self-join with the ancestors
   appends their segments and takes over their pointers, so distances double: twenty
   levels take five joins. After ``k`` joins a pointer covers ``2**k`` levels, and
   only nodes of every ``2**k``-th level are still pointed to; the others go.
3. Segments of the leaves then reach from leaf to root: the proofs. A proof is folded
   over a row's present hash and compared with the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.session import materialize

# Levels that one block of neighbours gives.
LEVELS = 10

# Tree over the roots of the groups. Groups are named "" for null, else "=" and the value.
TOP = "^"

# A segment is a run of entries: a byte, and the 32 bytes of the sibling where there is one.
ALONE, LEFT, RIGHT = 0, 1, 2


def field(column: str | Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value as text."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def row_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of the columns, as 32 bytes. No two different rows have the same input."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def _numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Add ``place`` within the row's ``tree``, from 0, and the tree's ``total``.

    Rows are range partitioned, so a tree may span any number of tasks; a summary
    with one row per tree and partition says how many come before.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    stored = materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-rows")
    piece = F.shiftright("at", 33)
    pieces = stored.groupBy("tree", piece.alias("piece")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    each = Window.partitionBy("tree")
    earlier = F.coalesce(F.sum("n").over(each.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = materialize(pieces.select("tree", "piece", (F.col("first") - earlier).alias("zero"), F.sum("n").over(each).alias("total")), "merkle-pieces")
    joined = stored.withColumn("piece", piece).join(pieces, ["tree", "piece"])
    return joined.withColumn("place", F.col("at") - F.col("zero")).drop("at", "piece", "zero")


def _parent(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _block_nodes(level: int, first: int, hashes: list[bytes], total: int):
    """Nodes over the neighbours ``hashes``, which begin at place ``first`` of ``level``: (level, place, hash, segment, last, open).

    ``last`` marks the root of the tree, ``open`` a node whose sibling is in another block.
    """
    for here in range(level, level + LEVELS + 1):
        width = -(-total >> here)
        if width == 1 or here == level + LEVELS:
            yield here, first, hashes[0], None, width == 1, width > 1
            return
        for k, own in enumerate(hashes):
            other = k ^ 1
            segment = bytes([ALONE]) if other >= len(hashes) else bytes([LEFT if other < k else RIGHT]) + hashes[other]
            yield here, first + k, own, segment, False, False
        hashes = [_parent(hashes[k:k + 2]) for k in range(0, len(hashes), 2)]
        first >>= 1


def _grown(leaves: DataFrame) -> DataFrame:
    """All nodes of the trees over ``leaves`` (``tree``, ``place``, ``total``, ``hash``, ``load``).

    A node has ``tree``, ``level``, ``place``, ``hash``, ``segment``, ``last`` and, if it is a leaf, ``load``.
    """
    most = leaves.agg(F.max("total")).first()[0] or 0
    load = leaves.schema["load"].dataType
    schema = T.StructType([
        T.StructField("tree", T.StringType()), T.StructField("total", T.LongType()), T.StructField("level", T.IntegerType()),
        T.StructField("place", T.LongType()), T.StructField("hash", T.BinaryType()), T.StructField("segment", T.BinaryType()),
        T.StructField("last", T.BooleanType()), T.StructField("open", T.BooleanType()), T.StructField("load", load),
    ])

    def run(level: int):
        def nodes(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    items, tree, total = batch.column("items")[i].values, batch.column("tree")[i].as_py(), batch.column("total")[i].as_py()
                    order = np.argsort(items.field("place").to_numpy())
                    places, hashes = items.field("place").to_numpy()[order], items.field("hash").take(pa.array(order)).to_pylist()
                    found = list(zip(*_block_nodes(level, int(places[0]), hashes, total)))
                    n = len(found[0])
                    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.bool_())
                    columns = [pa.array(c, t) for c, t in zip(found, kinds)]
                    loads = items.field("load").take(pa.array(order)) if level == 0 else pa.nulls(0, items.field("load").type)
                    loads = pa.concat_arrays([loads, pa.nulls(n - len(loads), items.field("load").type)])
                    # The leaves come first, and if the block is a single node it is the only one.
                    yield pa.RecordBatch.from_arrays([pa.array([tree] * n), pa.array([total] * n, pa.int64()), *columns, loads], names=schema.names)

        return nodes

    level, now, rounds = 0, leaves, []
    while True:
        item = F.struct("place", "hash", "load")
        blocks = now.groupBy("tree", "total", F.shiftright("place", LEVELS).alias("block")).agg(F.collect_list(item).alias("items"))
        # With open nodes the block's root belongs to the next round.
        found = materialize(blocks.mapInArrow(run(level), schema), "merkle-nodes")
        rounds.append(found.where("NOT open"))
        now, level = found.where("open"), level + LEVELS
        if most <= 1 << level:
            break
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    return nodes.drop("open", "total")


@dataclass(frozen=True)
class Manifest:
    """Stored trees: ``leaves`` and ``inner`` nodes with a pointer and a segment each, the ``subroots`` of the groups, the ``root``.

    ``depth`` is the largest number of levels between a leaf and the root.
    """

    leaves: DataFrame
    inner: DataFrame
    subroots: DataFrame
    root: bytes | None
    depth: int


_POINTER = ("up_tree", "up_level", "up_place")


# Level that roots point to. Their tree and place stay their own, so that they spread over the tasks of a join.
NOWHERE = -1


def _pointed(nodes: DataFrame) -> DataFrame:
    """Point to the parent; roots point nowhere."""
    return nodes.withColumns({
        "up_tree": F.col("tree"), "up_level": F.when(F.col("last"), NOWHERE).otherwise(F.col("level") + 1),
        "up_place": F.when(F.col("last"), F.col("place")).otherwise(F.shiftright("place", 1)),
    })


def build(rows: DataFrame) -> Manifest:
    """Trees over ``rows`` (``group`` of any type, ``order``, 32 bytes ``hash``, ``load``)."""
    tree = F.when(F.col("group").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("group").cast("string")))
    numbered = _numbered(rows.withColumn("tree", tree).select("tree", "order", "hash", "load"), "order", "hash")
    nodes = _grown(numbered)
    subroots = materialize(nodes.where("last").select("tree", "hash", "level"), "merkle-subroots")
    over = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("load"), "hash")
    top = materialize(_pointed(_grown(_numbered(over, "load"))), "merkle-top")
    # The root of a group takes the way of its leaf in the upper tree.
    above = top.where("level = 0").select(F.col("load").alias("own"), "segment", *_POINTER)
    ends = nodes.where("last").drop("segment").join(above, F.col("tree") == F.col("own")).drop("own")
    linked = _pointed(nodes.where("NOT last")).unionByName(ends)
    keep = ["tree", "level", "place", *_POINTER, F.coalesce("segment", F.lit(b"")).alias("segment")]
    inner = linked.where("level > 0").select(*keep).unionByName(top.where("level > 0").select(*keep))
    ends = top.where("last").select("hash", "level").first()
    height = subroots.agg(F.max("level")).first()[0] or 0
    return Manifest(linked.where("level = 0").select("hash", "load", *keep), inner, subroots, ends and bytes(ends["hash"]), height + (ends["level"] if ends else 0))


def _jumped(left: DataFrame, right: DataFrame) -> DataFrame:
    """One self-join: append the ancestor's segment and take over its pointer."""
    ahead = right.select(
        F.col("tree").alias("r_tree"), F.col("level").alias("r_level"), F.col("place").alias("r_place"),
        *[F.col(c).alias(f"r_{c}") for c in _POINTER], F.col("segment").alias("r_segment"),
    )
    met = (F.col("up_tree") == F.col("r_tree")) & (F.col("up_level") == F.col("r_level")) & (F.col("up_place") == F.col("r_place"))
    return left.join(ahead, met, "left").withColumns({
        "segment": F.concat("segment", F.coalesce("r_segment", F.lit(b""))), **{c: F.coalesce(f"r_{c}", c) for c in _POINTER},
    }).select(*left.columns)


def proofs(manifest: Manifest) -> DataFrame:
    """All leaves with ``segment`` reaching to the root."""
    leaves, inner, step = manifest.leaves, manifest.inner, 1
    while step < manifest.depth:
        upper = F.col("tree") == TOP
        targets = inner.where(upper | (F.col("level") % (2 * step) == step))
        leaves = _jumped(leaves, targets)
        inner = materialize(_jumped(inner.where(upper | (F.col("level") % (2 * step) == 0)), targets), "merkle-jumped")
        step *= 2
    return leaves


def entries(segment: bytes) -> list[tuple[int, bytes]]:
    """Side and sibling, level by level."""
    out, at = [], 0
    while at < len(segment):
        side, at = segment[at], at + 1
        sibling = segment[at:at + 32] if side != ALONE else b""
        out.append((side, sibling))
        at += len(sibling)
    return out


def folded(own: bytes, proof: list[tuple[int, bytes]]) -> bytes:
    """The root that a hash and a proof lead to."""
    for side, sibling in proof:
        own = _parent([own] if side == ALONE else [sibling, own] if side == LEFT else [own, sibling])
    return own


def merkle_manifest(docs: DataFrame, columns: Sequence[str], id_col: str = "doc_id", group_col: str = "lang", current: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``leaf``, ``subroot``, ``root``, ``proof``, ``proof_sha256``, ``folded_root`` and ``verified``.

    A leaf hashes ``columns``; leaves of a group are ordered by id, null first, and
    groups by value, null first. ``current`` is the 32-byte hash of the row as it is
    now, where that differs or may differ (null: unchanged): the proof is folded over it, and
    ``verified`` says whether that gives the root. ``proof`` is the segment from leaf to root.

    Null values hash as ``-``, an empty text as ``0:``; texts of any length are
    hashed whole. Rows with one id are ordered by their hash, and repeated rows are
    leaves of their own with equal hashes. Null ids and null groups are values like others. Other
    columns are ignored. An empty table gives no rows and has no root.
    """
    rows = docs.select(
        F.col(group_col).alias("group"), F.col(id_col).alias("order"), row_hash(columns).alias("hash"),
        F.struct(F.col(id_col).alias("id"), (F.lit(None).cast("binary") if current is None else current).alias("now")).alias("load"),
    )
    manifest = build(rows)
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("leaf", T.StringType()), T.StructField("subroot", T.StringType()),
        T.StructField("root", T.StringType()), T.StructField("proof", T.BinaryType()), T.StructField("proof_sha256", T.StringType()),
        T.StructField("folded_root", T.StringType()), T.StructField("verified", T.BooleanType()),
    ])
    subroots = manifest.subroots.select(F.col("tree").alias("s_tree"), F.col("hash").alias("subroot"))
    proven = proofs(manifest).join(subroots, F.col("tree") == F.col("s_tree"))
    proven = proven.select(F.col("load.id").alias("id"), F.col("hash").alias("leaf"), F.col("load.now").alias("now"), "subroot", F.col("segment").alias("proof"))
    root = manifest.root

    def check(batches):
        for batch in batches:
            rows = []
            for leaf, now, subroot, segment in zip(*(batch.column(c).to_pylist() for c in ("leaf", "now", "subroot", "proof"))):
                proof = entries(segment)
                found = folded(leaf if now is None else now, proof)
                rows.append((leaf.hex(), subroot.hex(), root.hex(), segment, _parent([s for _, s in proof]).hex(), found.hex(), found == root))
            kinds = (pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.bool_())
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=schema.names)

    return proven.mapInArrow(check, schema)


DOCUMENT = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_documents() -> Column:
    """Hash of a document after one was added to ``n_chars``, for every seventh by checksum of its id; else null."""
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return F.when(chosen, row_hash([(F.col(c) + 1) if c == "n_chars" else c for c in DOCUMENT]))


def _sql_leaf(n_chars: str) -> str:
    def value(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"

    return "sha256(" + " || ".join(value(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


QUERY_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
), d AS (
  SELECT row_number() OVER () AS rid, *, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS check_sum FROM documents, crc
), l AS (
  SELECT rid, doc_id, lang, {_sql_leaf("n_chars")} AS leaf, CASE WHEN check_sum % 7 = 0 THEN {_sql_leaf("(n_chars + 1)")} END AS now FROM d
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l
), nodes AS (
  SELECT lang, 0 AS lev, i, leaf AS h, n FROM numbered
  UNION ALL
  SELECT lang, lev + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, lev, i // 2, n
), subs AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lev, i, subroot AS h, n FROM subs
  UNION ALL
  SELECT lev + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY lev, i // 2, n
), low AS (
  SELECT rid, lang, 0 AS lev, i, n, '' AS proof, coalesce(now, leaf) AS own FROM numbered
  UNION ALL
  SELECT p.rid, p.lang, p.lev + 1, p.i // 2, (p.n + 1) // 2, p.proof || coalesce(s.h, ''),
    sha256(CASE WHEN s.h IS NULL THEN p.own WHEN p.i % 2 = 1 THEN s.h || p.own ELSE p.own || s.h END)
  FROM low p LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lev = p.lev AND s.i = xor(p.i, 1) WHERE p.n > 1
), high AS (
  SELECT p.rid, 0 AS lev, s.i, s.n, s.subroot, p.proof, p.own FROM low p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang WHERE p.n = 1
  UNION ALL
  SELECT p.rid, p.lev + 1, p.i // 2, (p.n + 1) // 2, p.subroot, p.proof || coalesce(s.h, ''),
    sha256(CASE WHEN s.h IS NULL THEN p.own WHEN p.i % 2 = 1 THEN s.h || p.own ELSE p.own || s.h END)
  FROM high p LEFT JOIN tops s ON s.lev = p.lev AND s.i = xor(p.i, 1) WHERE p.n > 1
)
SELECT l.doc_id, l.leaf, p.subroot, t.h AS root, sha256(p.proof) AS proof_sha256, p.own AS folded_root, p.own = t.h AS verified
FROM high p JOIN l USING (rid), tops t WHERE p.n = 1 AND t.n = 1
"""
