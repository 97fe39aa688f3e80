"""Near duplicates by SetSketch registers.

A document is the set of its word shingles. Every shingle throws points on a
line, at exponentially distributed distances, each into a random register; a
register keeps the nearest point. Stored is only the logarithm of that minimum
to the base ``BASE``, cut to one byte: registers of a union are the maxima of the
registers, and registers of similar sets are often equal.

1. Documents with equal sets form a class; from here on a class is one node.
2. Bands of registers are bucket keys. The members of a bucket are compared with
   its hub, the member that shares the most buckets with others: in a group of
   copies that is the text they come from. So a bucket makes a star, not pairs.
3. Pairs are scored by the joint likelihood of their registers and the set sizes,
   and those that may reach the threshold are confirmed on their full sets.
4. Links are joined to components. Pairs of a bucket in different components
   are then looked at in blocks, so no link between components is lost to the
   stars. Members close to a common hub are compared exactly by what sets them
   apart from it, a small part of their sets; for the others registers tell which
   pairs are worth confirming. Only links or such pairs become rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm.common import keep_rows, slices, text_of, text_tag, texts_as_bytes
from tidewake.llm.words import mixed, shingle_sets
from tidewake.session import materialize

REGISTERS = 256

# Base of the logarithm and offset of the stored registers: minima from 1e-8 to 10 fit into a byte.
BASE = 1.085
OFFSET = 28

# Likelihood estimates this far below the threshold are still confirmed, about 4.5 standard errors.
MARGIN = 0.10

# Members of a bucket that one block holds when a bucket's components are compared.
BLOCK = 512


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers [set, register] of sets of 64-bit hashes; empty sets have zeros.

    The points of an element form a Poisson process of rate ``REGISTERS``, dealt
    to the registers at random. An element stops once its next point lies
    beyond every register's minimum, so large sets take few points per element.
    """
    n = len(sets)
    nearest = np.full(n * REGISTERS, np.inf)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    state = np.concatenate(sets) if n else np.empty(0, np.uint64)
    at = np.zeros(len(state))
    while len(state):
        state = state + np.uint64(0x9E3779B97F4A7C15)
        drawn = mixed(state)
        at -= np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / REGISTERS
        register = (drawn & np.uint64(REGISTERS - 1)).astype(np.int64)
        np.minimum.at(nearest, owner * REGISTERS + register, at)
        furthest = nearest.reshape(n, REGISTERS).max(axis=1)
        going = at < furthest[owner]
        state, at, owner = state[going], at[going], owner[going]
    nearest = nearest.reshape(n, REGISTERS)
    with np.errstate(divide="ignore"):
        levels = np.floor(OFFSET - np.log(nearest) / np.log(BASE))
    return np.where(np.isfinite(nearest), np.clip(levels, 0, 255), 0).astype(np.uint8)


def joint_estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Similarity of sets from their registers [pair, register] and sizes: the most likely of a grid of values."""
    above = (a > b).sum(axis=1)[:, None]
    below = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - above - below
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    grid = np.linspace(0.0, 1.0, 201)[None, :]
    scale = (BASE - 1) / BASE

    def odds(x: np.ndarray) -> np.ndarray:
        return -np.log(1 - np.clip(x, 0, 1) * scale) / np.log(BASE)

    more, less = odds(u - v * grid), odds(v - u * grid)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(n > 0, n * np.log(np.maximum(p, 1e-300)), 0.0) for n, p in ((above, more), (below, less), (same, 1 - more - less))]
    likely = np.where(grid <= np.minimum(u / v, v / u) + 1e-9, sum(parts), -np.inf)
    return grid[0, likely.argmax(axis=1)]


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketched(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), text_tag(text_col).alias("tag"), text_of(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("tag", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("set_id", T.BinaryType()), T.StructField("registers", T.BinaryType()),
    ])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                sets = shingle_sets([t.lower() for t in texts_as_bytes(batch.column("text"))], width)
                registers = sketch(sets)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id"), batch.column("tag"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([r.tobytes() if len(s) else None for s, r in zip(sets, registers)], pa.binary()),
                ], names=schema.names)

    return materialize(rows.mapInArrow(run, schema), "near-sketches")


def _buckets(classes: DataFrame, rows_per_band: int) -> DataFrame:
    """Members of buckets with two or more: ``set_id``, ``band``, ``key``, ``members``."""
    bands = REGISTERS // rows_per_band
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.substring("registers", i * rows_per_band + 1, F.lit(rows_per_band)))
    rows = classes.select("set_id", F.posexplode(keys).alias("band", "key"))
    shared = materialize(rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "near-shared")
    return materialize(rows.join(shared, ["band", "key"]), "near-buckets")


def _with_hubs(members: DataFrame) -> DataFrame:
    """Add the hub of each bucket."""
    shares = members.groupBy("set_id").agg(F.sum("members").alias("shares"))
    ranked = members.join(shares, "set_id")
    hubs = ranked.groupBy("band", "key").agg(F.max_by("set_id", F.struct("shares", "set_id")).alias("hub"))
    # Stored, so that the join can be split where a bucket has many members.
    hubs = materialize(hubs, "near-bucket-hubs")
    return materialize(members.join(hubs, ["band", "key"]), "near-hubs")


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (``a``, ``b``) whose most likely similarity is not far below the threshold, with the ids of both."""
    side = {x: classes.select(F.col("set_id").alias(x), F.col("rep").alias(f"id_{x}"), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}")) for x in "ab"}
    both = pairs.join(side["a"], "a").join(side["b"], "b")
    schema = T.StructType([both.schema[c] for c in ("a", "b", "id_a", "id_b")])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            keep = np.concatenate([
                joint_estimate(a[i:i + 2000], b[i:i + 2000], n_a[i:i + 2000], n_b[i:i + 2000]) for i in range(0, len(a), 2000)
            ]) >= threshold - MARGIN
            yield batch.select(schema.names).filter(pa.array(keep))

    return both.mapInArrow(run, schema)


def _confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """Pairs compared on their full shingle sets: ``a``, ``b``, ``n_a``, ``n_b``, ``apart`` and ``linked``.

    ``apart`` has the shingles that only one of the two sets has. Texts are
    fetched by id; a row of that id with another set is passed over.
    """
    texts = docs.select(F.col(id_col).alias("t_id"), text_of(text_col).alias("text"))
    a, b = texts.toDF("t_a", "text_a"), texts.toDF("t_b", "text_b")
    both = pairs.join(a, F.col("id_a") == F.col("t_a")).join(b, F.col("id_b") == F.col("t_b")).select("a", "b", "text_a", "text_b")
    schema = T.StructType([
        T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()), T.StructField("apart", T.BinaryType()), T.StructField("linked", T.BooleanType()),
    ])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text_a", 1 << 20):
                ids_a, ids_b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                lows = [[t.lower() for t in texts_as_bytes(batch.column(c))] for c in ("text_a", "text_b")]
                rows = []
                for i, (x, y) in enumerate(zip(*(shingle_sets(t, width) for t in lows))):
                    if _digest(x) == ids_a[i] and _digest(y) == ids_b[i]:
                        apart = np.setxor1d(x, y, assume_unique=True)
                        rows.append((ids_a[i], ids_b[i], len(x), len(y), apart.tobytes(), bool(_alike(len(x), len(y), len(apart), percent))))
                columns = list(zip(*rows)) or [()] * len(schema)
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=schema.names)

    return materialize(both.mapInArrow(run, schema), "near-compared")


def _alike(n_a, n_b, apart, percent: int):
    """Whether sets of these sizes that differ in ``apart`` elements reach the threshold."""
    shared = (n_a + n_b - apart) // 2
    return 100 * shared >= percent * (shared + apart)


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Component of every linked node: ``set_id`` and ``root``, its least (id, set).

    Each round takes the least root among the neighbours and then the root of
    that root, so paths get shorter by half; it ends when nothing changes.
    """
    both = links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y")))
    own = nodes.select("set_id", F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), F.col("set_id").alias("set")).alias("root"))
    linked = both.select(F.col("x").alias("set_id")).distinct()
    state = materialize(own.join(linked, "set_id"), "near-roots")
    while True:
        near = both.join(state.select(F.col("set_id").alias("y"), F.col("root").alias("r")), "y").groupBy("x").agg(F.min("r").alias("r"))
        step = materialize(
            state.join(near, F.col("set_id") == F.col("x")).select("set_id", F.least("root", "r").alias("root"), F.col("root").alias("was")), "near-steps")
        jump = step.select(F.col("set_id").alias("at"), F.col("root").alias("far"))
        state = materialize(
            step.join(jump, F.col("root.set") == F.col("at")).select("set_id", F.least("root", "far").alias("root"), "was"), "near-roots")
        if state.where("root != was").isEmpty():
            return state.select("set_id", "root")
        state = state.drop("was")


def _beside_hubs(stars: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links between members of one star that are in different components, one for each member and component.

    With ``x`` and ``y`` both compared with hub ``h``, the elements that set them
    apart are those of ``x`` against ``h`` or ``y`` against ``h`` but not both.
    """
    rooted = stars.select(F.col("a").alias("set_id"), F.col("b").alias("hub"), F.col("n_a").alias("n"), "apart").join(
        roots.select("set_id", F.col("root.set").alias("root")), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    hub_roots = roots.select(F.col("set_id").alias("hub"), F.col("root.set").alias("hub_root"))
    marked = rooted.join(hub_roots, "hub", "left").withColumn("outside", F.col("root") != F.coalesce("hub_root", "hub"))
    # Stored step by step: joins that end in a file can be split where a hub has many members.
    marked = materialize(marked, "near-marked")
    sizes = marked.groupBy("hub").agg(F.count(F.lit(1)).alias("members"), F.max("outside").alias("open")).where("open AND members > 1")
    rows = materialize(marked.join(sizes, "hub"), "near-sized")
    item = F.struct("set_id", "root", "n", "apart")
    laid = rows.withColumn("block", _block("members")).groupBy("hub", "outside", "block").agg(F.collect_list(item).alias("items"))
    laid = materialize(laid, "near-stars")
    left = laid.where("outside").select("hub", F.col("block").alias("p"), F.col("items").alias("left"))
    right = laid.select("hub", F.col("outside").alias("both_out"), F.col("block").alias("q"), F.col("items").alias("right"))
    joined = left.join(right, "hub").where(~F.col("both_out") | (F.col("p") <= F.col("q"))).select("left", "right")

    def compare(left: pa.StructArray, right: pa.StructArray) -> list:
        mine, other = _Items(left), _Items(right)
        parts = [np.frombuffer(x, np.uint64) for x in other.values("apart")]
        flat, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        sizes, found = np.array([len(x) for x in parts]), []
        for k, raw in enumerate(mine.values("apart")):
            own = np.frombuffer(raw, np.uint64)
            at = np.minimum(np.searchsorted(own, flat), max(len(own) - 1, 0))
            same = np.bincount(owner[own[at] == flat], minlength=len(parts)) if len(own) else 0
            hit = _alike(mine.n[k], other.n, len(own) + sizes - 2 * same, percent) & (other.root != mine.root[k])
            firsts = np.unique(other.root[hit], return_index=True)[1]
            found += [(mine.ids[k], other.ids[j]) for j in np.flatnonzero(hit)[firsts].tolist()]
        return found

    return joined.mapInArrow(_by_blocks(compare), _PAIR)


def _apart(members: DataFrame, stars: DataFrame, roots: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs of one bucket in different components that may be similar, unless both are close to the bucket's hub.

    One of such a pair is far from the hub. Members are laid into blocks; a task
    compares two blocks by their registers.
    """
    rooted = members.where("set_id != hub AND members > 2").join(
        roots.select("set_id", F.col("root.set").alias("root")), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    close = stars.select(F.col("a").alias("set_id"), F.col("b").alias("hub"), F.lit(True).alias("close")).distinct()
    marked = rooted.join(close, ["set_id", "hub"], "left").withColumn("far", F.col("close").isNull())
    open_ = marked.groupBy("band", "key").agg(F.max("far").alias("open"), F.min("root").alias("r1"), F.max("root").alias("r2")).where("open AND r1 != r2")
    rows = marked.join(open_.select("band", "key"), ["band", "key"]).join(classes.select("set_id", "n", "registers"), "set_id")
    item = F.struct("set_id", "root", "n", "registers")
    laid = rows.withColumn("block", _block("members")).groupBy("band", "key", "far", "block").agg(F.collect_list(item).alias("items"))
    laid = materialize(laid, "near-blocks")
    left = laid.where("far").select("band", "key", F.col("block").alias("p"), F.col("items").alias("left"))
    right = laid.select("band", "key", F.col("far").alias("both_far"), F.col("block").alias("q"), F.col("items").alias("right"))
    joined = left.join(right, ["band", "key"]).where(~F.col("both_far") | (F.col("p") <= F.col("q"))).select("left", "right")

    def compare(left: pa.StructArray, right: pa.StructArray) -> list:
        mine, other = _Items(left), _Items(right)
        a, b = (np.frombuffer(b"".join(x.values("registers")), np.uint8).reshape(-1, REGISTERS) for x in (mine, other))
        found = []
        for k, own in enumerate(mine.ids):
            # Equal registers alone give a cheap bound before the likelihood is worked out.
            rest = np.flatnonzero((other.root != mine.root[k]) & ((b == a[k]).mean(axis=1) >= threshold - MARGIN - 0.1))
            if len(rest):
                one = np.full(len(rest), float(mine.n[k]))
                near = joint_estimate(np.repeat(a[k:k + 1], len(rest), axis=0), b[rest], one, other.n[rest].astype(float)) >= threshold - MARGIN
                found += [(min(own, other.ids[j]), max(own, other.ids[j])) for j in rest[near].tolist()]
        return found

    return joined.mapInArrow(_by_blocks(compare), _PAIR).distinct()


_PAIR = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _block(members: str):
    """Block of a member, by a hash of its set: about half of ``BLOCK`` in each, without a window over the group."""
    return F.pmod(F.xxhash64("set_id"), F.ceil(F.col(members) / F.lit(BLOCK // 2)))


class _Items:
    """Members of a block."""

    def __init__(self, items: pa.StructArray):
        self.items = items
        self.ids, self.n = self.values("set_id"), items.field("n").to_numpy()
        self.root = np.array(self.values("root"), dtype="S16")

    def values(self, name: str) -> list:
        return self.items.field(name).to_pylist()


def _by_blocks(compare):
    """Rows of two lists of members to the pairs that ``compare`` finds between them."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = compare(batch.column("left")[i].values, batch.column("right")[i].values)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], names=_PAIR.names)

    return run


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, rows_per_band: int = 6,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept`` and ``tag``.

    Sets of ``width``-word shingles (A-Z in lower case) are linked if their
    intersection is at least ``percent`` percent of their union. A text with
    fewer words is one shingle; one without words, or null, is linked with
    nothing. ``component_id`` is the smallest id that links reach, ``kept`` says
    that it is the row's own, so of repeated rows with one id all are kept.
    Rows with a null id are linked to their exact equals only. Other columns are
    ignored; an empty table gives no rows.
    """
    threshold = percent / 100
    rows = _sketched(docs, id_col, text_col, width)
    first = F.min_by(F.struct("n", "registers"), F.struct(F.col("id").isNull(), F.col("id")))
    classes = rows.where("n > 0").groupBy("set_id").agg(F.min("id").alias("rep"), first.alias("f")).select("set_id", "rep", "f.*")
    classes = materialize(classes, "near-classes")
    members = _with_hubs(_buckets(classes, rows_per_band))
    tried = members.where("set_id != hub").select(F.col("set_id").alias("a"), F.col("hub").alias("b")).distinct()
    stars = _confirmed(_estimated(tried, classes, threshold), docs, id_col, text_col, width, percent)
    links = stars.where("linked").select("a", "b")
    roots = components(links, classes)
    more = materialize(_beside_hubs(stars, roots, percent), "near-beside")
    open_ = materialize(_estimated(_apart(members, stars, roots, classes, threshold), classes, threshold), "near-apart")
    if not open_.isEmpty():
        apart = _confirmed(open_, docs, id_col, text_col, width, percent)
        more = more.unionByName(apart.where("linked").select("a", "b"))
    if not more.isEmpty():
        roots = components(links.unionByName(more), classes)
    known = classes.join(roots, "set_id", "left").select("set_id", F.coalesce("root.id", "rep").alias("component"))
    # Stored, so that the join below has nothing but shuffles under it and large classes can be split.
    known = materialize(known, "near-components")
    joined = rows.select("id", "tag", "n", "set_id").join(known, "set_id", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"), "tag",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component, with all columns; texts without words all stay."""
    decided = near_dedup(docs, id_col, text_col, **options)
    return keep_rows(docs, decided.where("kept"), id_col, text_col)
