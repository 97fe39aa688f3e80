"""Near duplicates by SimHash fingerprints, found with BK-trees.

1. A text's fingerprint is the bitwise majority of the hashes of its shingles.
   Rows with equal fingerprints are one node from here on.
2. Fingerprints at most ``radius`` bits apart agree in at least ``agree`` of
   ``radius + agree`` blocks of bits, so they meet in a bucket named by such
   blocks. Buckets are dealt to shards of a bounded number of fingerprints.
3. A shard is a BK-tree. Its own fingerprints are looked up in it; where a bucket
   has several shards, each tree is sent to the fingerprints of the later ones.
   All trees together grow with the table, so a join sends them, tree by tree,
   rather than one broadcast; a tree is a row of bounded size.
4. A shard gives its groups as stars of links, never all pairs. Links are joined to
   components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm import bk_tree
from tidewake.llm.common import slices, text_of, texts_as_bytes
from tidewake.llm.near_dedup import components
from tidewake.session import materialize

SEED = 42

# Fingerprints of a shard, about half of this on average.
SHARD = 4096

# Fingerprints of small shards that are searched together.
TOGETHER = 1 << 16

# Shingles hashed at a time.
_SOME = 1 << 16

# A-Z in lower case, all white space as spaces.
_PLAIN = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, width: int):
    """XXH64 of the shingles of a text, some at a time; one of all words where there are fewer."""
    plain = text.translate(_PLAIN).strip(b" ")
    while b"  " in plain:
        plain = plain.replace(b"  ", b" ")
    if not plain:
        return
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    starts, stops = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(plain)]])
    width = min(width, len(starts))
    starts, stops = starts[:len(starts) - width + 1], stops[width - 1:]
    for i in range(0, len(starts), _SOME):
        cut = zip(starts[i:i + _SOME].tolist(), stops[i:i + _SOME].tolist())
        yield np.array([xxhash.xxh64_intdigest(plain[a:b], SEED) for a, b in cut], np.uint64)


def fingerprint(text: bytes, width: int) -> int:
    """Each bit is 1 if set in over half of the shingles' hashes; 0 without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, width):
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """``id`` and ``fingerprint`` (64 bits as a signed long) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fingerprint", T.LongType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                found = np.array([fingerprint(t, width) for t in texts_as_bytes(batch.column("text"))], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], names=schema.names)

    return rows.mapInArrow(run, schema)


def block_masks(radius: int, agree: int) -> list[int]:
    """Masks, as signed longs, of all choices of ``agree`` out of ``radius + agree`` blocks of bits."""
    borders = [64 * i // (radius + agree) for i in range(radius + agree + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _shards(nodes: DataFrame, radius: int, agree: int, shard_size: int) -> DataFrame:
    """Shards of the buckets with two or more fingerprints: ``choice``, ``key``, ``shards``, ``shard`` and ``members``."""
    keys = F.array(*[F.col("set_id").bitwiseAND(F.lit(m)) for m in block_masks(radius, agree)])
    rows = nodes.select("set_id", F.posexplode(keys).alias("choice", "key"))
    sizes = rows.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that the join can be split where a bucket has many members.
    sizes = materialize(sizes.select("choice", "key", F.ceil(F.col("n") / F.lit(max(shard_size // 2, 1))).alias("shards")), "simhash-sizes")
    dealt = rows.join(sizes, ["choice", "key"]).withColumn("shard", F.pmod(F.xxhash64("set_id"), F.col("shards")))
    return materialize(dealt.groupBy("choice", "key", "shards", "shard").agg(F.collect_list("set_id").alias("members")), "simhash-shards")


_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists of a column, and the size of each list."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), sizes


def _links(values: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """A star for each group."""
    linked = label != np.arange(len(label))
    signed = values.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[label[linked]])], names=_LINK.names)


def _within(shards: DataFrame, radius: int) -> DataFrame:
    """Links between fingerprints of one shard."""
    def run(batches):
        for batch in batches:
            before = np.concatenate([[0], np.cumsum(np.diff(batch.column("members").offsets.to_numpy()))])
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(before, before[start] + TOGETHER, "right")) - 1)
                values, sizes = _lists(batch.column("members").slice(start, stop - start))
                forest = bk_tree.build(values, sizes)
                found = bk_tree.search(forest, values, np.repeat(np.arange(len(sizes)), sizes), radius)
                yield _links(values, bk_tree.groups(len(values), found))
                start = stop

    return shards.select("members").mapInArrow(run, _LINK)


def _between(shards: DataFrame, radius: int) -> DataFrame:
    """Links between fingerprints of different shards of a bucket: each shard's tree meets the members of all later shards."""
    several = shards.where("shards > 1")
    schema = T.StructType([*[several.schema[c] for c in ("choice", "key", "shards", "shard")], T.StructField("tree", T.BinaryType())])

    def plant(batches):
        for batch in batches:
            trees = []
            for i in range(batch.num_rows):
                values, sizes = _lists(batch.column("members").slice(i, 1))
                trees.append(bk_tree.build(values, sizes).to_bytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in schema.names[:-1]], pa.array(trees, pa.binary())], names=schema.names)

    trees = materialize(several.mapInArrow(plant, schema), "simhash-trees")
    later = F.explode(F.sequence(F.col("shard") + 1, F.col("shards") - 1)).alias("shard")
    sent = trees.where(F.col("shard") + 1 < F.col("shards")).select("choice", "key", later, "tree")
    asked = sent.join(several.select("choice", "key", "shard", "members"), ["choice", "key", "shard"]).select("tree", "members")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                forest = bk_tree.from_bytes(batch.column("tree")[i].as_py())
                queries, _ = _lists(batch.column("members").slice(i, 1))
                found = bk_tree.search(forest, queries, np.zeros(len(queries), np.int64), radius)
                n = len(forest.values)
                label = bk_tree.groups(n + len(queries), ((node, n + query) for query, node in found))
                yield _links(np.concatenate([forest.values, queries]), label)

    return asked.mapInArrow(run, _LINK)


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, agree: int = 2, shard_size: int = SHARD,
) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Fingerprints of ``width``-word shingles (A-Z in lower case, repeats counted)
    are linked if at most ``radius`` bits differ; ``component_id`` is the smallest
    id that links reach. A text with fewer words is one shingle; one without words,
    or null, has fingerprint zero and is linked like any other. Repeated rows
    have one component. A row with a null id is linked too; a component of such
    rows alone has a null ``component_id``. Ties cannot change the result, since it is a
    function of the set of fingerprints. Other columns are ignored; an empty table gives no rows.

    ``agree`` sets how finely buckets are cut: 15 keys a fingerprint of about 21
    bits by default. A larger one makes more and smaller buckets; the result is the same.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, width), "simhash-rows")
    nodes = materialize(rows.groupBy(F.col("fingerprint").alias("set_id")).agg(F.min("id").alias("rep")), "simhash-nodes")
    shards = _shards(nodes, radius, agree, shard_size)
    links = materialize(_within(shards, radius).unionByName(_between(shards, radius)).distinct(), "simhash-links")
    roots = components(links, nodes)
    known = nodes.join(roots, "set_id", "left").select("set_id", F.coalesce("root.id", "rep").alias("component"))
    # Stored, so that the join can be split where many rows have one fingerprint.
    known = materialize(known, "simhash-components")
    return rows.join(known, rows["fingerprint"] == known["set_id"]).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"),
    )


def drop_simhash_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, with all columns; rows with a null id go only if a component has another."""
    decided = simhash_dedup(docs, id_col, text_col, **options)
    kept = decided.where(F.col("component_id").eqNullSafe(F.col(id_col))).select(F.col(id_col).alias("_kept_id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept_id")), "left_semi")
